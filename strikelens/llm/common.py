"""What several corpus operators share: the tables, the word pattern, numbering."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space is these six bytes and nothing else, so that every engine cuts words alike.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null taken as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` alone: the first 52 bits of an MD5."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def vocabulary(name: str) -> str:
    """Where the installed package of public vocabularies has a file; every machine of a cluster has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the work folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def row_key() -> Column:
    """What tells rows apart: 16 bytes of identifier and whole text; rows that repeat both share it."""
    identifier = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(identifier, F.lit(":"), whole_text()))).alias("key")


#: Bits of a map for each key that it holds, and parts of 32768 bits that a map may have: 4 MB.
BITS_OF_KEY = 16
MAP_PARTS = 1024


def probably_in(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Those of ``rows`` whose ``key`` is one of ``keys``, a written table, and few others; without a shuffle, so that what no join needs is not moved.

    The keys are marked in a map of bits of bounded size, which is broadcast. With more keys than it has bits more other rows stay.
    """
    parts = min(MAP_PARTS, keys.count() * BITS_OF_KEY // 32768 + 1)
    place = F.pmod(F.xxhash64("key"), F.lit(parts * 32768))
    placed = keys.select(F.floor(place / 32768).cast("int").alias("_part"), (place % 32768).alias("_bit"))
    bitmap = placed.groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    marked = rows.withColumns({"_part": F.floor(place / 32768).cast("int"), "_bit": (place % 32768).cast("int")}).join(F.broadcast(bitmap), "_part")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, F.col("_bit") % 8) == 1
    return marked.filter(is_set).select(rows.columns)


#: Bytes of text that Python works on at a time, and bytes and rows of a batch sent to it.
SLICE = 4 << 20
BATCH_BYTES = 8 << 20
BATCH_ROWS = 4_000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts, jobs send rows to Python in small batches, so that a worker's memory does not follow the length of texts."""
    wanted = {
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``size`` bytes of ``column``; a longer one has a slice of its own."""
    for batch in batches:
        start = held = 0
        for k, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            if k > start and held + (n or 0) > size:
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += n or 0
        if batch.num_rows > start:
            yield batch.slice(start)
