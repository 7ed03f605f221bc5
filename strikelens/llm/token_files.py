"""Token ids as Parquet files.

A file holds documents in ascending order of their identifier, and the files are in
that order too. Its columns are doc_id, local_start (ids of the documents before it in
the file), n_tokens and the ids as a list of integers. Ids are dictionary-encoded, which
packs each into the bits that the vocabulary needs; the counting columns are delta-encoded. Row
groups and pages are small and have a page index, so that a reader who wants some documents
or the counts alone skips the rest.

Where a document starts in the whole output follows from the totals of the files, one
row each, which ``index`` sums up; documents are not numbered in one task.

Null text is empty, and an empty document is its end token alone. Null identifiers come
first. Rows that repeat an identifier stand side by side. An empty table gives an empty output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strikelens.llm.encoding import crc32, encoder

END = 2
#: Settings of the files. The second writer version delta-encodes what has no dictionary.
FORMAT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#local_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}
SCHEMA = "file int, doc_id long, local_start long, n_tokens long, ids array<int>"
#: Ids in a batch, at most, unless one document has more.
BATCH = 1 << 20


def tokenised(docs: DataFrame, vocabulary: str, end: int = END) -> DataFrame:
    """The rows of the files, in order; ``file`` is the number of the task that wrote them."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, before = TaskContext.get().partitionId(), 0

        def made(held: list) -> pa.RecordBatch:
            nonlocal before
            lengths = np.array([len(ids) for _, ids in held], dtype=np.int64)
            offsets = np.concatenate(([0], np.cumsum(lengths)))
            values = np.concatenate([ids for _, ids in held]).astype(np.int32)
            starts = before + offsets[:-1]
            before += int(offsets[-1])
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))
            columns = [pa.array(np.full(len(held), file, np.int32)), pa.array([i for i, _ in held], pa.int64())]
            columns += [pa.array(starts), pa.array(lengths), lists]
            return pa.RecordBatch.from_arrays(columns, names=["file", "doc_id", "local_start", "n_tokens", "ids"])

        held: list = []
        size = 0
        for batch in batches:
            texts = (x.as_py() for x in batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(vocabulary).all(texts)):
                held.append((doc_id, np.append(ids, np.uint32(end))))
                size += len(held[-1][1])
                if size >= BATCH:
                    yield made(held)
                    held, size = [], 0
        if held:
            yield made(held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(encode, SCHEMA)


def write(docs: DataFrame, folder: str, vocabulary: str, end: int = END) -> None:
    tokenised(docs, vocabulary, end).write.options(**FORMAT).parquet(folder)


def index(spark: SparkSession, folder: str) -> DataFrame:
    """file, tokens, start: one row for each file, from the counting columns alone."""
    rows = read(spark, folder, "file", "local_start", "n_tokens")
    totals = rows.groupBy("file").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("tokens"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The files' rows with the columns asked for, all by default."""
    rows = spark.read.schema(SCHEMA).parquet(folder)
    return rows.select(*columns) if columns else rows


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            sums = [crc32(values[a:b]) for a, b in zip(offsets, offsets[1:])]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("file", "doc_id", "local_start")]
            counted = pa.array(np.diff(offsets).astype(np.int64))
            names = ["file", "doc_id", "local_start", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*kept, counted, pa.array(sums, pa.int64())], names=names)

    schema = "file int, doc_id long, local_start long, n_tokens long, ids_crc32 long"
    rows = read(spark, folder, "file", "doc_id", "local_start", "ids").mapInArrow(check, schema)
    placed = rows.join(index(spark, folder).select("file", F.col("start").alias("file_start")), "file")
    return placed.select("doc_id", (F.col("file_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
