"""Near duplicates by one-permutation MinHash, banded buckets and stars.

Documents with equal shingle sets are one class, named by a 128-bit hash. One hash of every shingle puts it in one of
``BINS`` bins, and a bin keeps its smallest hash. An empty bin takes the value of the first filled bin in a random order of all bins,
which is its own and the same for all documents (optimal densification), so that each bin agrees with the chance of the similarity.
``ROWS`` bins are a band, and classes with equal bands share a bucket. With the defaults a pair of
exactly the similarity shares no bucket with a chance of (1 - 0.85^8)^48, 2 in ten million, and a more similar one less.

Buckets give stars and not pairs: each class is paired with the bucket's centre, the class that shares most buckets, which in a group
of near copies is the one that the others were made from. Pairs are confirmed on full sets, and links make components. A bucket whose
classes are in one component is done. In the others, classes of different components are compared by outlines of their sets, which bound
from above what two sets can share, so that no link is lost, and only pairs that the bound lets pass are confirmed. Each class first has its
best partners confirmed, since these join most components, then more, at last all; so no link between classes that share a bucket is
lost, and no bucket has a limit. A bucket is cut into blocks, and a task compares two blocks at a time and gives out
nothing but pairs that passed, so its memory has a bound whatever the bucket.

Sets are not written: what travels for a pair is one text, and the texts of centres once for each of ``salts`` parts of
their pairs, so that a centre of very many classes is spread over tasks. Centres and sizes of buckets are
aggregated before they are shuffled, and only buckets of two and more classes are joined back.

Null and empty texts, and texts of white space, have an empty set and are linked with nothing. A null identifier is a row
like others that no component is named by, unless no row of it has one. Rows that share an identifier with other texts are documents of their
own; repeated rows are copies. Python works on slices of a few megabytes of text at a time. An empty table gives an
empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strikelens.llm.blocks import BLOCK, PARTNERS, lowest_groups, measured, outlines, possible
from strikelens.llm.common import row_key, slices, small_batches
from strikelens.llm.components import components
from strikelens.llm.shingles import Shingler
from strikelens.runtime import stage

#: Words of a shingle and similarity in percent.
WORDS = 3
SIMILAR = 85
#: Bands, and bins in each.
BANDS = 48
ROWS = 8
SEED = 20_240_607

_ODD = np.uint64(0xD6E8FEB86659FD93)


class Sketcher:
    """Bands of sets of 64-bit hashes."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = SEED):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        rnd = np.random.Generator(np.random.PCG64(seed))
        # turn[i, j]: when an empty bin i comes to bin j
        self.turn = np.argsort(rnd.random((self.bins, self.bins)), axis=1).astype(np.uint16)
        self.mix = rnd.integers(1 << 63, size=(bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = rnd.integers(1 << 63, size=bands, dtype=np.uint64)

    def bins_of(self, shingles: np.ndarray) -> np.ndarray:
        """The value of each bin for a set that is not empty."""
        h = shingles.view(np.uint64) * _ODD
        h ^= h >> np.uint64(32)
        h *= _ODD
        h.sort()
        # the upper half of a hash chooses the bin, so a bin's hashes stand together and the smallest first
        of = (h >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        values = np.zeros(self.bins, np.uint64)
        filled = of[first].astype(np.int64)
        values[filled] = h[first]
        if len(filled) < self.bins:
            empty = np.setdiff1d(np.arange(self.bins), filled, assume_unique=True)
            values[empty] = values[filled[self.turn[np.ix_(empty, filled)].argmin(axis=1)]]
        return values

    def bands_of(self, shingles: np.ndarray) -> np.ndarray:
        """One 64-bit hash for each band; equal bins and band give equal hashes."""
        values = self.bins_of(shingles).reshape(self.bands, self.rows)
        h = (values ^ (values >> np.uint64(29))) * self.mix
        h ^= h >> np.uint64(32)
        h = h.sum(axis=1, dtype=np.uint64) * _ODD ^ self.salt
        return (h ^ (h >> np.uint64(31))).view(np.int64)


def _texts(docs: DataFrame, *columns: Column | str) -> DataFrame:
    return docs.select(*columns, F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def sketches(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, key of the row, n_shingles, class and bands of every row, the last two null for an empty set; written."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sketcher = Shingler(words), Sketcher(bands, rows)
        for batch in slices(batches):
            sizes, classes, banded = [], [], []
            for s in shingler.sets(batch.column("text").to_pylist()):
                sizes.append(len(s))
                classes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                banded.append(sketcher.bands_of(s) if len(s) else None)
            made = [pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(banded, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), *made], names=["doc_id", "key", "n_shingles", "class", "bands"]
            )

    schema = "doc_id long, key binary, n_shingles long, class binary, bands array<long>"
    with small_batches(docs.sparkSession):
        return stage(_texts(docs, F.col("doc_id").cast("long").alias("doc_id"), row_key()).mapInArrow(sketch, schema), "sketches")


def buckets(classes: DataFrame) -> DataFrame:
    """bucket, members, class, n, centre and n_centre for all classes of buckets of two and more; written."""
    each = classes.select(F.explode("bands").alias("bucket"), "class", "n")
    shared = each.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    members = stage(each.join(shared, "bucket"), "members")
    score = members.groupBy("class").agg(F.count("*").alias("score"))
    best = F.max(F.struct("score", F.xxhash64("class", "bucket"), "class", "n")).alias("best")
    centres = members.join(score, "class").groupBy("bucket").agg(best)
    centres = centres.select("bucket", F.col("best.class").alias("centre"), F.col("best.n").alias("n_centre"))
    return stage(members.join(centres, "bucket"), "buckets")


def _comparable(similar: int) -> Column:
    """Sizes that allow the similarity."""
    return 100 * F.least("n", "n_centre") >= similar * F.greatest("n", "n_centre")


class _Confirmed:
    """Links confirmed on full sets, and the components that they make."""

    def __init__(self, texts: DataFrame, words: int, similar: int):
        self.texts, self.words, self.similar = texts, words, similar
        self.links: DataFrame | None = None
        self.roots: DataFrame | None = None

    def add(self, pairs: DataFrame) -> None:
        """Confirms ``pairs`` (centre, class), which are distinct."""
        found = measured(pairs.toDF("a", "b"), self.texts, self.words)
        links = found.filter(100 * F.col("shared") >= self.similar * F.col("joined")).select("a", "b")
        if links.isEmpty():
            return
        self.links = links if self.links is None else self.links.union(links)
        self.roots = components(self.links)

    def rooted(self, rows: DataFrame, column: str, name: str) -> DataFrame:
        if self.roots is None:
            return rows.withColumn(name, F.col(column))
        roots = self.roots.select(F.col("node").alias(column), F.col("root").alias(name))
        return rows.join(roots, column, "left").withColumn(name, F.coalesce(name, column))


def class_roots(
    rows: DataFrame, docs: DataFrame, words: int = WORDS, similar: int = SIMILAR, partners: Sequence[int | None] = PARTNERS, block: int = BLOCK
) -> DataFrame | None:
    """node, root of the components of classes with links; None without links. ``rows`` are the sketches of ``docs``."""
    named = rows.filter("class IS NOT NULL").groupBy("class")
    members = buckets(named.agg(F.min("n_shingles").alias("n"), F.min("bands").alias("bands")))
    # one text of each class that shares a bucket
    keys = named.agg(F.min("key").alias("key")).join(members.select("class").distinct(), "class", "left_semi")
    found = _texts(docs, row_key()).join(keys, "key").select("class", "text")
    # rows that repeat have one key
    texts = stage(found.groupBy("class").agg(F.min("text").alias("text")), "texts")
    confirmed = _Confirmed(texts, words, similar)
    others = F.col("class") != F.col("centre")
    stars = stage(members.filter(others & _comparable(similar)).select("centre", "class").distinct(), "stars")
    confirmed.add(stars)
    # all pairs of the centre are known
    rest, outlined = members.filter(others).select("bucket", "members", "class", "n"), None
    done = stars.select(F.least("centre", "class").alias("centre"), F.greatest("centre", "class").alias("class"))
    for most in partners:
        rest = confirmed.rooted(rest.drop("root"), "class", "root")
        ends = rest.groupBy("bucket").agg(F.min("root").alias("lowest"), F.max("root").alias("highest"))
        rest = stage(rest.join(ends.filter("lowest <> highest"), "bucket", "left_semi"), "mixed")
        if rest.isEmpty():
            break
        if outlined is None:
            outlined = outlines(texts.join(rest.select("class").distinct(), "class", "left_semi"), words)
            met = lowest_groups(members.select(F.col("bucket").alias("group"), "class"))
            outlined = stage(outlined.select("class", "planes", "beyond").join(met, "class"), "outlines")
        found = possible(rest.withColumnRenamed("bucket", "group"), outlined, similar, most, block)
        pairs = found.select(F.col("a").alias("centre"), F.col("b").alias("class")).distinct()
        fresh = stage(pairs.join(done, ["centre", "class"], "left_anti"), "fresh")
        confirmed.add(fresh)
        done = done.union(fresh)
        rest = rest.join(found.select(F.col("open").alias("bucket")).distinct(), "bucket", "left_semi")
    return confirmed.roots


def join(
    docs: DataFrame, words: int = WORDS, similar: int = SIMILAR, bands: int = BANDS, rows: int = ROWS,
    partners: Sequence[int | None] = PARTNERS, block: int = BLOCK,
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest identifier that links reach) and kept, whether it is the row's own."""
    found = sketches(docs, words, bands, rows)
    roots = class_roots(found, docs, words, similar, partners, block)
    some = found.filter("class IS NOT NULL").select("doc_id", "n_shingles", "class")
    classes = some.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    if roots is not None:
        rooted = classes.join(roots.withColumnRenamed("node", "class"), "class", "left")
        rooted = stage(rooted.withColumn("root", F.coalesce("root", "class")), "rooted")
        lowest = rooted.groupBy("root").agg(F.min("component_id").alias("component_id"))
        classes = rooted.select("class", "root").join(lowest, "root").select("class", "component_id")
    joined = some.join(classes, "class").select("doc_id", "n_shingles", "component_id")
    none = found.filter("class IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
