"""Pairs of sets that may be similar, within groups of any size.

Sets are compared by outlines, which bound from above what two of them can share, so a pair that is similar always passes. A
group is cut into blocks by a hash, and a task compares two blocks at a time, in numpy, and gives out nothing but
pairs of different components that passed: its memory has a bound whatever the group, and no pairs of a group are made as rows
beyond those. The work in a group that holds very many unlike components is quadratic, spread over the pairs of its blocks.

Two sets may meet in very many groups, but are given out by the smallest one alone. Each set brings its smallest groups along, so that a
task sees whether two have met before. Only ``LOWEST`` are brought, by which a pair may come twice, but is never lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikelens.llm.common import slices, small_batches
from strikelens.llm.shingles import Shingler
from strikelens.runtime import stage

#: Bits of an outline, classes in a block of a group, and partners that a class has confirmed in each round; None is all.
BITS = 1024
BLOCK = 2048
PARTNERS = (4, 64, None)
#: Groups that a class brings along, and pairs that are looked at together.
LOWEST = 32
TOGETHER = 1 << 15


def _places(shingles: np.ndarray, bits: int) -> np.ndarray:
    """How many shingles of a set are at each place."""
    return np.bincount((shingles.view(np.uint64) >> np.uint64(13)).astype(np.int64) & (bits - 1), minlength=bits)


def count_batch(sets: list[np.ndarray], bits: int = BITS) -> list[pa.Array]:
    """counts and over of each set: how many shingles are at each place, up to 255 as bytes, and what is over."""
    placed = [_places(s, bits) for s in sets]
    over = [int(np.maximum(x - 255, 0).sum()) for x in placed]
    return [pa.array([np.minimum(x, 255).astype(np.uint8).tobytes() for x in placed], pa.binary()), pa.array(over, pa.int32())]


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    """Binary values of one length as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def plane_batch(counts: pa.Array, over: pa.Array) -> list[pa.Array]:
    """planes and beyond of each set: which places have one shingle at least, and which two, as bytes; and how many shingles are beyond two.

    Two sets share no more shingles than they share bits in the first half and in the second, and the lesser number beyond.
    """
    if not len(counts):
        return [pa.array([], pa.binary()), pa.array([], pa.int32())]
    placed = _rows(counts, np.uint8)
    planes = np.concatenate([np.packbits(placed > 0, axis=1), np.packbits(placed > 1, axis=1)], axis=1)
    beyond = (placed - np.minimum(placed, 2)).sum(axis=1, dtype=np.int64) + over.to_numpy()
    return [pa.array([x.tobytes() for x in planes], pa.binary()), pa.array(beyond, pa.int32())]


COUNTS = "counts binary, over int"
PLANES = "planes binary, beyond int"


def outline_batch(classes: pa.Array, sets: list[np.ndarray], bits: int = BITS) -> pa.RecordBatch:
    """class, planes and beyond of each set, and for a closer look its counts and what is over."""
    counted = count_batch(sets, bits)
    return pa.RecordBatch.from_arrays([classes, *plane_batch(*counted), *counted], names=["class", "planes", "beyond", "counts", "over"])


def planes(counted: DataFrame) -> DataFrame:
    """class, planes and beyond from class, counts and over."""
    kind = counted.schema["class"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = plane_batch(batch.column("counts"), batch.column("over"))
            yield pa.RecordBatch.from_arrays([batch.column("class"), *made], names=["class", "planes", "beyond"])

    return counted.select("class", "counts", "over").mapInArrow(make, f"class {kind}, {PLANES}")


def lowest_groups(members: DataFrame) -> DataFrame:
    """class and the smallest of its groups as lowest, from all rows (group, class)."""
    return members.groupBy("class").agg(F.slice(F.array_sort(F.collect_set("group")), 1, LOWEST).alias("lowest"))


def outlines(texts: DataFrame, words: int) -> DataFrame:
    """The outline of every class with its text, as bytes; written."""
    kind = texts.schema["class"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in slices(batches):
            yield outline_batch(batch.column("class"), shingler.sets(batch.column("text").to_pylist()))

    with small_batches(texts.sparkSession):
        return stage(texts.select("class", "text").mapInArrow(make, f"class {kind}, {PLANES}, {COUNTS}"), "outlines")


def screened(pairs: DataFrame, outlined: DataFrame, similar: int) -> DataFrame:
    """Those ``pairs`` (a, b) that may be similar by the counts of all places, which tell long sets apart; written. None that is similar is lost."""
    ends = [outlined.select(F.col("class").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("counts", "over")]) for x in "ab"]
    kind = pairs.schema["a"].dataType.simpleString()

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            counts = [_rows(batch.column(f"counts_{x}"), np.uint8) for x in "ab"]
            over = [batch.column(f"over_{x}").to_numpy() for x in "ab"]
            shared = np.minimum(*counts).sum(axis=1, dtype=np.int64) + np.minimum(*over)
            joined = sum(c.sum(axis=1, dtype=np.int64) + o for c, o in zip(counts, over)) - shared
            yield batch.select(["a", "b"]).filter(pa.array(100 * shared >= similar * joined))

    with small_batches(pairs.sparkSession):
        return stage(pairs.join(ends[0], "a").join(ends[1], "b").mapInArrow(screen, f"a {kind}, b {kind}"), "screened")


def measured(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Distinct ``pairs`` (a, b) of classes with the sizes of intersection and union of their whole sets, shared and joined; written.

    The text of b travels once for each pair, that of a once for each part of its pairs, so a class with very many pairs as a is
    spread over tasks.
    """
    salts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)))
    of_a, of_b = (texts.select(F.col("class").alias(end), F.col("text").alias(f"text_{end}")) for end in "ab")
    sent = salted.select("a", "salt").distinct().join(of_a, "a")
    both = salted.join(of_b, "b").join(sent, ["a", "salt"]).select("a", "b", "text_a", "text_b")
    kind = pairs.schema["a"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        known: dict = {}
        for batch in slices(slices(batches, "text_a"), "text_b"):
            shared, joined = [], []
            ends = batch.column("a").to_pylist()
            first = {a: k for k, a in reversed([*enumerate(ends)]) if a not in known}
            made = shingler.sets([batch.column("text_a")[k].as_py() for k in first.values()])
            known |= zip(first, made)
            for a, s in zip(ends, shingler.sets(batch.column("text_b").to_pylist())):
                own = known[a]
                shared.append(len(np.intersect1d(own, s, assume_unique=True)))
                joined.append(len(own) + len(s) - shared[-1])
            # rows of one a stand together, or nearly so
            known = {a: known[a] for a in ends[-1:]}
            columns = [batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(joined, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "shared", "joined"])

    with small_batches(pairs.sparkSession):
        return stage(both.mapInArrow(compare, f"a {kind}, b {kind}, shared long, joined long"), "measured")


def _range_of_partners(group: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows in the order of group, low, high and own: where the partners of a row begin and end, so that each pair is there once.

    In a block with itself they are the rows after it, in two blocks those of the higher one, for a row of the lower.
    """
    starts = np.flatnonzero(_is_start(group, low, high))
    sizes = np.diff(np.append(starts, len(group)))
    ends = np.repeat(starts + sizes, sizes)
    highs = np.repeat(starts + np.add.reduceat((own == low).astype(np.int64), starts), sizes)
    begins = np.where(low == high, np.arange(len(group)) + 1, np.where(own == low, highs, ends))
    return begins, ends


def _is_start(*columns: np.ndarray) -> np.ndarray:
    """Whether a row is the first one with its values."""
    found = np.ones(len(columns[0]), bool)
    found[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return found


def _lowest_rows(column: pa.Array) -> np.ndarray:
    """Lists as rows, filled up with the largest number."""
    lengths = pc.list_value_length(column).to_numpy()
    rows = np.full((len(lengths), max(1, lengths.max())), np.iinfo(np.int64).max)
    rows[np.arange(rows.shape[1]) < lengths[:, None]] = column.flatten().to_numpy()
    return rows


def _met_before(lowest: np.ndarray, group: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows ``a`` and ``b`` share a group smaller than theirs."""
    found = np.zeros(len(a), bool)
    step = max(1, (1 << 22) // lowest.shape[1] ** 2)
    for start in range(0, len(a), step):
        part = slice(start, start + step)
        of_a, of_b = lowest[a[part]], lowest[b[part]]
        smaller = of_a < group[a[part], None]
        found[part] = ((of_a[:, :, None] == of_b[:, None, :]) & smaller[:, :, None]).any(axis=(1, 2))
    return found


def _partners(table: pa.Table, similar: int, most: int | None) -> pa.Table:
    """first, second: the pairs of whole groups in different components that may be similar; of each class the ``most`` best.

    ``open`` is the group, if it has further ones.
    """
    n, beyond, group, own, low, high = (table.column(c).to_numpy() for c in ("n", "beyond", "group", "block", "low", "high"))
    classes = table.column("class").combine_chunks()
    root = table.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
    bits = _rows(table.column("planes"), np.uint64)
    lowest = _lowest_rows(table.column("lowest").combine_chunks())
    begins, ends = _range_of_partners(group, own, low, high)
    before = np.concatenate(([0], np.cumsum(ends - begins)))
    cuts = np.unique(np.append(np.searchsorted(before, np.arange(0, before[-1], TOGETHER), "right") - 1, len(n)))
    passed = []
    for start, end in zip(cuts[:-1], cuts[1:]):
        count = ends[start:end] - begins[start:end]
        a = np.repeat(np.arange(start, end), count)
        b = np.arange(len(a)) + np.repeat(begins[start:end] - (before[start:end] - before[start]), count)
        apart = (root[a] != root[b]) & (100 * np.minimum(n[a], n[b]) >= similar * np.maximum(n[a], n[b]))
        a, b = a[apart], b[apart]
        shared = np.bitwise_count(bits[a] & bits[b]).sum(axis=1, dtype=np.int64) + np.minimum(beyond[a], beyond[b])
        shared = np.minimum(shared, np.minimum(n[a], n[b]))
        alike = 100 * shared >= similar * (n[a] + n[b] - shared)
        a, b, shared = a[alike], b[alike], shared[alike]
        fresh = ~_met_before(lowest, group, a, b)
        passed.append((a[fresh], b[fresh], shared[fresh] / (n[a[fresh]] + n[b[fresh]])))
    a, b, likeness = (np.concatenate(x) for x in zip(*passed)) if passed else (np.empty(0, np.int64),) * 3
    is_open = np.zeros(len(n), bool)
    if most is not None and len(a):
        row, pair = np.concatenate([a, b]), np.tile(np.arange(len(a)), 2)
        order = np.lexsort([-likeness[pair], row])
        first = _is_start(row[order])
        rank = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        chosen = np.zeros(len(a), bool)
        chosen[pair[order][rank < most]] = True
        is_open = np.isin(group, group[a[~chosen]])
        a, b = a[chosen], b[chosen]
    pairs = [classes.take(pa.array(x, pa.int64())) for x in (a, b)]
    return pa.table([*pairs, pa.array(group[a], pa.int64(), mask=~is_open[a])], names=["first", "second", "open"])


def possible(rest: DataFrame, outlined: DataFrame, similar: int, most: int | None, block: int = BLOCK) -> DataFrame:
    """(a, b, open), a < b: pairs of ``rest`` (group, members, class, n, root) that share a group and may be similar; written.

    ``members`` is about the size of the group, a long, ``n`` that of the set, ``root`` the component; ``outlined`` has the classes' planes,
    beyond and lowest. ``open`` names a group that has further pairs beyond the ``most`` best of a class; all other groups are done.
    """
    blocks = F.ceil(F.col("members") / block).cast("int")
    dealt = rest.withColumn("block", F.pmod(F.xxhash64("class"), blocks).cast("int"))
    # a row goes to the pairs of its block with every block
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    named = dealt.join(outlined.select("class", "planes", "beyond", "lowest"), "class").select(
        "group", "class", F.col("n").cast("long"), "root", "block", "low", "high", "planes", "beyond", "lowest"
    )
    kind = rest.schema["class"].dataType.simpleString()

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            last = int(np.flatnonzero(_is_start(*(held.column(c).to_numpy() for c in ("group", "low", "high"))))[-1])
            if last:
                yield from _partners(held.slice(0, last), similar, most).to_batches()
                held = held.slice(last)
        if held is not None:
            yield from _partners(held, similar, most).to_batches()

    keys = ["group", "low", "high"]
    # many groups are small, and a call of Python for each would cost more than the work on it
    together = named.repartition(*keys).sortWithinPartitions(*keys, "block")
    with small_batches(rest.sparkSession):
        found = together.mapInArrow(pairs, f"first {kind}, second {kind}, open long")
        return stage(found.select(F.least("first", "second").alias("a"), F.greatest("first", "second").alias("b"), "open"), "possible")
