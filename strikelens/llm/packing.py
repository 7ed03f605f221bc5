"""Sum-of-squares packing of token pieces into sequences.

A piece goes into the open sequence for which the sum over all residual gaps of the
squared number of open sequences with that gap becomes smallest; a new one is opened where
none fits. Keeping the gaps' counts even keeps a fitting gap at hand for whatever comes.
The state is one count per gap, however many pieces have been placed, and the pieces
come in descending length, which leaves the short ones for the last gaps.

Pieces are dealt by hash into shards that are packed independently, each piece as it
passes. A shard leaves at most one sequence that is no more than half full; these are
packed once more across shards, so that the waste does not grow with their number.

Only lengths travel: a shard holds its lengths, identifiers and open gaps, never texts.

Null and empty texts are one end token. Repeated rows are pieces of their own; null
identifiers are kept. An empty table packs into nothing. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikelens.llm.encoding import crc32, encoder
from strikelens.runtime import stage

CAPACITY = 1024
END = 2
#: Pieces in a shard, on average.
SHARD = 100_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """Documents cut into pieces of at most ``capacity`` ids; a longer document's first piece takes the remainder."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).all
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            texts = (x.as_py() for x in batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(texts)):
                ids = np.append(ids, np.uint32(end))
                n = len(ids)
                cuts = [0, *range(n % capacity or capacity, n, capacity), n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    row = (doc_id, k, a, b - a, crc32(ids[a:b]), ids[a:b].astype(np.int32) if with_ids else None)
                    for column, value in zip(columns, row):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
            made = {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds) if with_ids or n != "ids"}
            yield pa.RecordBatch.from_pydict(made)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


class Bins:
    """Open sequences by gap. ``place`` puts one length and says where: (sequence, offset)."""

    def __init__(self, capacity: int):
        self.capacity, self.made = capacity, 0
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        # twice the count of each gap; a full sequence is in no gap, which counts as adding nothing
        self.twice = np.zeros(capacity + 1, dtype=np.int64)
        self.twice[0] = -1
        self.fits = np.zeros(capacity + 1, dtype=bool)

    def place(self, length: int) -> tuple[int, int]:
        capacity, twice = self.capacity, self.twice
        # moving a sequence from gap g to g - length; the last entry stands for a new sequence, taken where none fits
        change = twice[: capacity + 1 - length] + 2 - twice[length:]
        change[:-1][~self.fits[length:-1]] = 1 << 40
        change[-1] = 1 << 39
        g = length + int(change.argmin())
        if g == capacity:
            sequence = self.made
            self.made += 1
        else:
            sequence = self.open[g].pop()
            twice[g] -= 2
            self.fits[g] = bool(self.open[g])
        rest = g - length
        if rest:
            self.open[rest].append(sequence)
            twice[rest] += 2
            self.fits[rest] = True
        return sequence, capacity - g


def _place(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """Adds sequence_id and offset to pieces as they pass; ids of sequences are made unique by the shard's number."""
    bins, first = Bins(capacity), TaskContext.get().partitionId() << 40
    for batch in batches:
        placed = [bins.place(n) for n in batch.column("length").to_pylist()]
        sequences = pa.array([first + s for s, _ in placed], pa.int64())
        offsets = pa.array([o for _, o in placed], pa.int64())
        arrays = [*batch.columns, sequences, offsets]
        yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "sequence_id", "offset"])


def pack(cut: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``cut``, as ``pieces`` returns it, with sequence_id and offset, the place in the sequence, gapless from 0."""
    cut = stage(cut, "pieces")
    shards = max(1, round(cut.count() / shard))
    dealt = cut.repartition(shards, F.xxhash64("doc_id", "piece", "length", "ids_crc32")).sortWithinPartitions(
        F.desc("length"), "doc_id", "piece", "ids_crc32"
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    placed = dealt.mapInArrow(lambda batches: _place(batches, capacity), f"{schema}, sequence_id long, offset long")
    placed = stage(placed, "placed")
    # at most one row of each shard
    rest = placed.groupBy("sequence_id").agg(F.sum("length").alias("length")).filter(F.col("length") <= capacity // 2)
    again = rest.withColumnRenamed("sequence_id", "part").repartition(1).sortWithinPartitions(F.desc("length"), "part")
    moved = again.mapInArrow(
        lambda batches: _place(batches, capacity), "part long, length long, sequence_id long, offset long"
    ).select("part", (F.lit(-1) - F.col("sequence_id")).alias("into"), F.col("offset").alias("shift"))
    joined = placed.join(moved, F.col("sequence_id") == F.col("part"), "left")
    return joined.select(
        *cut.columns,
        F.coalesce("into", "sequence_id").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )


def assemble(packed: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids and starts of the pieces, from pieces packed with their ids; no row exceeds the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    gathered = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return gathered.select(
        "sequence_id",
        F.flatten("parts.ids").alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.offset").alias("starts"),
    )


def place_all(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every length; equal results for equal lengths in equal order."""
    bins = Bins(capacity)
    sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        sequences[i], offsets[i] = bins.place(length)
    return sequences, offsets
