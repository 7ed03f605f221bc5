"""How filters interact: what each removes in every order, after what others have removed before.

Every filter has a posting list: the ids of the rows that fail it, ascending, kept for each part of the corpus and range of ids.
A row's id is its number in the written table of answers, so that rows count as rows whatever their identifiers, and a range is
``RANGE`` consecutive ids, so that no list is longer and a part with a third of all rows is spread over many tasks. For
every set of filters the lists of a range are united by a galloping k-way merge, and a further filter's list is taken
apart against that union, galloping, too. The sizes add up over ranges; orders of filters only look up the sizes
of the set that came before, so all orders cost no more than all sets.

A galloping merge copies runs: it takes the list with the smallest head and looks for the smallest head of the others in it with steps
that double, then by bisection, so its work follows the number of runs and not of ids.

Null text is empty; it has no words, so it fails a least number of words and no share of them. Null parts are the part "". Repeated
texts are known by their SHA-256, and a row repeats when a smaller identifier has its text: rows without identifier neither
repeat nor are repeated, and rows of the same identifier do not repeat each other. Labels are joined by identifier; one is good (or toxic)
if any of its labels says so. An empty table gives an empty result. Columns but those named are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strikelens.llm.common import slices, small_batches, whole_text
from strikelens.runtime import stage

#: Filters of texts.
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 3
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"
#: Bits of an id within its range.
RANGE_BITS = 14
#: Labels whose losses are counted, as (name, column) with 1 for yes.
LABELS = (("good", "quality"), ("toxic", "toxic"))


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether texts fail the filters A to D, and their digests."""
    for batch in slices(batches):
        columns: list[list] = [[] for _ in range(4)]
        digests = []
        for text in batch.column("text"):
            data = text.as_py()
            words = data.split()
            capitals = len(data) - len(data.translate(None, CAPITALS))
            points = len(data) - len(data.translate(None, _STARTS))
            answers = (
                len(words) < MIN_WORDS,
                100 * len(set(words)) < DISTINCT_PERCENT * len(words),
                100 * capitals > CAPITALS_PERCENT * points,
                len(data.translate(None, SYMBOLS)) < len(data),
            )
            for column, answer in zip(columns, answers):
                column.append(answer)
            digests.append(hashlib.sha256(data).digest())
        kept = [batch.column("doc_id"), batch.column("part")]
        arrays = [*kept, *[pa.array(c, pa.bool_()) for c in columns], pa.array(digests, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "part", *FILTERS[:4], "digest"])


#: The bytes that begin a code point in UTF-8: all but those that go one on.
_STARTS = bytes(b for b in range(256) if not 0x80 <= b < 0xC0)


def answers(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """id, part, whether the row fails each filter, and whether its labels say good and toxic; written."""
    named = F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), named, whole_text().cast("binary").alias("text"))
    fails = ", ".join(f"{f} boolean" for f in FILTERS[:4])
    with small_batches(docs.sparkSession):
        rows = stage(texts.mapInArrow(_answers, f"doc_id long, part string, {fails}, digest binary"), "answers")
    # the first row of a text finds itself under both keys, so copies of one text are dealt out
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    repeats = F.col("first").isNull() & F.col("doc_id").isNotNull()
    said = [F.max(F.col(column) == 1).alias(name) for name, column in LABELS]
    judged = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*said)
    joined = rows.join(firsts, ["digest", "doc_id"], "left").join(judged, "doc_id", "left")
    found = [F.coalesce(name, F.lit(False)).alias(name) for name, _ in LABELS]
    marked = joined.select("part", *FILTERS[:4], repeats.alias(FILTERS[4]), *found)
    return stage(marked.withColumn("id", F.monotonically_increasing_id()), "marked")


def postings(marked: DataFrame, filters: Sequence[str] = FILTERS, bits: int = RANGE_BITS) -> DataFrame:
    """part, range, n_rows and for every filter and label the sorted ids with it: one row for each part and range of ids."""
    lists = [F.sort_array(F.collect_list(F.when(F.col(c), F.col("id")))).alias(c) for c in (*filters, *[n for n, _ in LABELS])]
    return marked.groupBy("part", F.shiftright("id", bits).alias("range")).agg(F.count("*").alias("n_rows"), *lists)


def gallop(ids: Sequence[int], start: int, target: int) -> int:
    """Where the first id of at least ``target`` is in ``ids``, from ``start`` on."""
    step, low = 1, start
    while low + step < len(ids) and ids[low + step] < target:
        low += step
        step *= 2
    return bisect_left(ids, target, low, min(len(ids), low + step + 1))


def united(lists: Sequence[Sequence[int]]) -> list[int]:
    """The ids of all sorted ``lists``, each once, by a k-way merge that copies runs."""
    heads = [[ids, 0] for ids in lists if len(ids)]
    out: list[int] = []
    while heads:
        low = min(heads, key=lambda h: h[0][h[1]])
        ids, at = low
        others = [h[0][h[1]] for h in heads if h is not low]
        end = gallop(ids, at, min(others)) if others else len(ids)
        if end > at:
            out += ids[at:end]
            low[1] = end
        else:
            # the smallest id is a head of several lists and goes in with the others' turn
            low[1] = at + 1
        if low[1] == len(ids):
            heads = [h for h in heads if h is not low]
    return out


def without(ids: Sequence[int], gone: Sequence[int]) -> list[int]:
    """The sorted ``ids`` that are not in the sorted ``gone``."""
    out: list[int] = []
    at = other = 0
    while at < len(ids):
        other = gallop(gone, other, ids[at]) if other < len(gone) else other
        if other == len(gone):
            return out + list(ids[at:])
        end = gallop(ids, at, gone[other])
        out += ids[at:end]
        at = end + 1 if end < len(ids) and ids[end] == gone[other] else end
        other += 1
    return out


def _sizes(filters: Sequence[str]):
    labels = [name for name, _ in LABELS]

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "before", "filter", "kept", "removed", "redundant", *[f"{n}_lost" for n in labels]]
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                for n in range(len(filters)):
                    for before in itertools.combinations(filters, n):
                        gone = united([row[f] for f in before])
                        for f in filters:
                            if f in before:
                                continue
                            removed = without(row[f], gone)
                            kept = row["n_rows"] - len(gone) - len(removed)
                            lost = [len(removed) - len(without(removed, row[name])) for name in labels]
                            rows.append((row["part"], "".join(before), f, kept, len(removed), len(row[f]) - len(removed), *lost))
            columns = list(zip(*rows)) or [()] * len(names)
            kinds = [pa.string()] * 3 + [pa.int64()] * (len(names) - 3)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    counted = ", ".join(f"{n}_lost long" for n in labels)
    return sizes, f"part string, before string, filter string, kept long, removed long, redundant long, {counted}"


def set_sizes(lists: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """For every part, set of filters ``before`` (in their order) and further filter: kept, removed, redundant and labels lost; written."""
    function, schema = _sizes(filters)
    with small_batches(lists.sparkSession):
        ranges = lists.mapInArrow(function, schema)
        sums = [F.sum(c).alias(c) for c in ranges.columns[3:]]
        return stage(ranges.groupBy("part", "before", "filter").agg(*sums), "set-sizes")


def audit(sizes: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, filter_order and step: ``sizes`` of the set before, unique_fails, and shapley, the filter's removals over all orders."""
    steps = [
        ("".join(order), k + 1, "".join(sorted(order[:k], key=filters.index)), order[k])
        for order in itertools.permutations(filters)
        for k in range(len(filters))
    ]
    orders = sizes.sparkSession.createDataFrame(steps, "filter_order string, step int, before string, filter string")
    alone = F.length("before") == len(filters) - 1
    # as many orders come to a set and then a filter as the set and the rest have orders
    ways = orders.groupBy("before", "filter").agg(F.count("*").alias("ways"))
    weighed = sizes.join(ways, ["before", "filter"]).groupBy("part", "filter")
    whole = weighed.agg(F.sum(F.when(alone, F.col("removed"))).alias("unique_fails"), F.sum(F.col("ways") * F.col("removed")).alias("shapley"))
    named = [f"{name}_lost" for name, _ in LABELS]
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *named, "shapley"]
    return sizes.join(orders, ["before", "filter"]).join(whole, ["part", "filter"]).select(columns)
