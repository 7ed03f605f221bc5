"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

A logistic regression on hashed words and word shapes gives every document its own evidence. Sites are then
judged by grouped aggregation: a host's posterior mean shrinks towards the global mean and a path's
towards its host's, each with a strength estimated from how much the groups differ
(one-way analysis of variance), so that sparse sites say little. A document's log odds are its
own evidence plus what its path says beyond the global prior; those below one half are rejected.

The regression is fitted on at most ``SAMPLE`` labelled documents, chosen by hash of their
identifier. Everything else, posteriors and strengths included, covers all documents. Documents are read twice, to train
and to score, and only (path, sums) rows are shuffled; posteriors come back by a join whose
table is one row per path.

The host is ``source`` and the path (``source``, ``lang``) unless other columns are
named; null is a site of its own. Null and empty texts have no evidence of words and are judged by length and site.
Repeated rows are judged alike and count each. Labels that are null are ignored, several labels of a
document are averaged; without labels of both kinds there is no evidence and all is kept. Extra columns pass through.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strikelens.llm.common import small_batches, whole_text
from strikelens.runtime import stage

#: Labelled documents to learn from, at most.
SAMPLE = 10_000
DIMENSIONS = 1 << 14
WHOLE = 5
#: How much the shares of words weigh against the numbers of the whole; steps, their size and the penalty of the fit.
SCALE = 10.0
STEPS = 150
RATE = 0.1
PENALTY = 1e-4
#: Words a worker remembers; affects time only.
REMEMBERED = 100_000
#: Bounds of the strength of a prior, in documents, and of what a site may add to log odds.
STRENGTHS = (2.0, 10_000.0)
MOST_FROM_SITE = 2.0


def places_of(word: bytes) -> tuple[int, int]:
    """Where a word and its shape (runs of capitals, small letters and digits as one each) are counted."""
    text = word.decode()
    kinds = ("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in text)
    shape = "".join(c for c, _ in groupby(kinds))
    return zlib.crc32(text.lower().encode()) % DIMENSIONS, DIMENSIONS + zlib.crc32(shape.encode()) % DIMENSIONS


class Features:
    """Features of texts: shares of hashed words and of hashed word shapes, and numbers of the whole."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, int]] = {}

    def places(self, word: bytes) -> tuple[int, int]:
        found = self.known.get(word)
        if found is None:
            found = places_of(word)
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self.known[word] = found
        return found

    @staticmethod
    def whole(text: bytes, words: list[bytes]) -> list[float]:
        """Length, share of different words, of different lines and of words like the one before, and 1."""
        lines = [line for line in text.split(b"\n") if line]
        n, m = max(1, len(words)), max(1, len(lines))
        return [math.log1p(len(words)) / 5, len(set(words)) / n, len(set(lines)) / m, 5 * sum(map(eq, words, words[1:])) / n, 1.0]

    def vector(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places and values that are not zero."""
        words = text.split()
        counted = np.array([p for w in words for p in self.places(w)], np.int64)
        places, counts = np.unique(counted, return_counts=True)
        values = [*(SCALE * counts / max(1, len(words))), *self.whole(text, words)]
        return np.concatenate([places, 2 * DIMENSIONS + np.arange(WHOLE)]), np.array(values)


class Scorer:
    """Log odds of texts under weights; a word's weight is looked up once."""

    def __init__(self, weights: np.ndarray):
        self.weights, self.known = weights, {}

    def __call__(self, text: bytes) -> float:
        words = text.split()
        known, weights = self.known, self.weights
        if len(known) > REMEMBERED:
            known.clear()
        for word in {w for w in words if w not in known}:
            a, b = places_of(word)
            known[word] = float(weights[a] + weights[b])
        total = sum(map(known.__getitem__, words)) * SCALE / max(1, len(words))
        return total + float(np.dot(weights[2 * DIMENSIONS :], Features.whole(text, words)))


def fit(places: np.ndarray, values: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a small penalty, by gradient steps of adapted size.

    ``values`` stand at ``places`` of the vectors of the texts ``owner``.
    """
    size = 2 * DIMENSIONS + WHOLE
    weights, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, STEPS + 1):
        odds = np.bincount(owner, values * weights[places], len(labels))
        wrong = (1 / (1 + np.exp(-odds)) - labels) / len(labels)
        slope = np.bincount(places, values * wrong[owner], size) + PENALTY * weights
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray | None:
    """Weights, or None when there are not both kinds of labels. The sample's features, of bounded number, are fitted on the driver."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_q_id"))
    chosen = known.agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("_q_id"), "_q_id").limit(sample)
    # at most SAMPLE rows of two numbers
    text = docs.select(F.col("doc_id").cast("long").alias("_q_id"), whole_text().cast("binary").alias("text"))
    text = text.join(F.broadcast(chosen), "_q_id").dropDuplicates(["_q_id"]).select("text", "label")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            vectors = [features.vector(x.as_py()) for x in batch.column("text")]
            columns = [pa.array([v[k] for v in vectors], kind) for k, kind in enumerate((pa.list_(pa.int64()), pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("label")], names=["places", "values", "label"])

    with small_batches(docs.sparkSession):
        found = text.mapInArrow(extract, "places array<long>, values array<double>, label double").toArrow()
    truth = found.column("label").to_numpy()
    if len(np.unique(truth)) < 2:
        return None
    places, values = (found.column(c).combine_chunks() for c in ("places", "values"))
    owner = np.repeat(np.arange(len(truth)), np.diff(places.offsets.to_numpy()))
    return fit(places.flatten().to_numpy(), values.flatten().to_numpy(), owner, truth)


def evidence(docs: DataFrame, weights: np.ndarray | None, *kept: str) -> DataFrame:
    """The columns ``kept`` and the log odds of good quality, ``evidence``, from each text alone; written."""
    if weights is None:
        return stage(docs.select(*kept, F.lit(0.0).alias("evidence")), "evidence")
    rows = docs.select(*kept, whole_text().cast("binary").alias("_q_text"))
    fields = [*rows.schema.fields[:-1], T.StructField("evidence", T.DoubleType())]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights)
        for batch in batches:
            odds = pa.array([scorer(x.as_py()) for x in batch.column(len(kept))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], odds], names=[*kept, "evidence"])

    with small_batches(docs.sparkSession):
        return stage(rows.mapInArrow(score, T.StructType(fields)), "evidence")


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _logit(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(held / (1 - held))


def strength(groups: DataFrame, within: list[str]) -> float:
    """How many documents the prior counts for, from (n, good, squares) per group and the groups above, ``within``.

    The variance between group means, less what chance within groups explains.
    """
    above = groups.groupBy(*within) if within else groups.groupBy()
    per_parent = above.agg(
        F.sum("n").alias("n"),
        F.sum("good").alias("good"),
        F.count("*").alias("groups"),
        F.sum(F.col("squares") - F.col("good") ** 2 / F.col("n")).alias("inside"),
        F.sum(F.col("good") ** 2 / F.col("n")).alias("means"),
        F.sum(F.col("n") ** 2).alias("n_squares"),
    )
    row = per_parent.agg(
        F.sum("n"), F.sum("groups"), F.count("*"), F.sum("inside"),
        F.sum(F.col("means") - F.col("good") ** 2 / F.col("n")), F.sum(F.col("n") - F.col("n_squares") / F.col("n")),
    ).first()
    low, high = STRENGTHS
    if not row[0] or row[0] <= row[1] or not row[5]:
        return high
    n, groups_, parents, inside, between, spread = map(float, row)
    noise = inside / (n - groups_)
    variance = (between - (groups_ - parents) * noise) / spread
    return high if variance <= 0 else min(high, max(low, noise / variance))


def site_posteriors(scored: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """host, path, host_quality, path_quality, prior: one row per path, from documents with their ``evidence``."""
    p = _sigmoid(F.col("evidence"))
    paths = scored.groupBy(host, path).agg(F.count("*").alias("n"), F.sum(p).alias("good"), F.sum(p * p).alias("squares"))
    paths = stage(paths, "paths")
    hosts = paths.groupBy(host).agg(*[F.sum(c).alias(c) for c in ("n", "good", "squares")])
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    prior = total["good"] / total["n"] if total["n"] else 0.5
    by_host, by_path = strength(hosts, []), strength(paths, [host])
    shrunk = hosts.select(
        F.col(host).alias("_q_host"), ((F.col("good") + by_host * prior) / (F.col("n") + by_host)).alias("host_quality")
    )
    joined = paths.join(shrunk, F.col(host).eqNullSafe(F.col("_q_host")))
    return joined.select(
        F.col(host).alias("_q_host"),
        F.col(path).alias("_q_path"),
        "host_quality",
        ((F.col("good") + by_path * F.col("host_quality")) / (F.col("n") + by_path)).alias("path_quality"),
        F.lit(prior).alias("prior"),
    )


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """doc_id, evidence, host_quality, path_quality, quality (the posterior probability) and kept of every row of ``docs``."""
    model = train(docs, labels, sample)
    scored = evidence(docs, model, "doc_id", host, path)
    return judge(scored, stage(site_posteriors(scored, host, path), "sites"), host, path)


def judge(scored: DataFrame, sites: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """``scored`` with the posteriors of its site and the verdict."""
    same = F.col(host).eqNullSafe(F.col("_q_host")) & F.col(path).eqNullSafe(F.col("_q_path"))
    beyond = _logit(F.col("path_quality")) - _logit(F.col("prior"))
    bound = F.lit(MOST_FROM_SITE)
    odds = F.col("evidence") + F.least(F.greatest(beyond, -bound), bound)
    judged = scored.join(sites, same).withColumn("quality", _sigmoid(odds))
    return judged.withColumn("kept", F.col("quality") >= 0.5).drop("_q_host", "_q_path", "prior")


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``. Each is scored once and written with its score."""
    rows = docs.select(F.struct("*").alias("_q_row"), host, path, "text")
    scored = evidence(rows, train(docs, labels, sample), "_q_row", host, path)
    sites = stage(site_posteriors(scored, host, path), "sites")
    return judge(scored, sites, host, path).filter("kept").select("_q_row.*")
