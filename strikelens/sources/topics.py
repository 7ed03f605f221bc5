"""Keyed JSON records, as kept in the topics of a message log.

A topic is a folder of Parquet files with the columns of ``ENVELOPE``; with
the Kafka connector on the class path ``format="kafka"`` reads and writes the
same columns.

Every record has a time: that of its event where the writer names a column, else
when it was written. It is the event time of whoever reads the topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter

from ..functions.codec import decode, decode_list, encode, encode_list
from ..schemas import ENVELOPE, GROUPED, KEY, RANKED, SUMMARY


# The header that says which micro-batch wrote a record.
BATCH = "Batch"


def to_envelopes(
    rows: DataFrame, key: T.StructType = KEY, value: T.StructType | str = SUMMARY, at: str | None = None, batch_id: int | None = None
) -> DataFrame:
    """JSON key, value, a random header and the time of each row; ``value`` may name a bare column instead of a schema.

    ``at`` names the column with the time of the record, the current time by default.
    """
    body = F.col(value).cast("string") if isinstance(value, str) else encode(value)
    return rows.select(encode(key).alias("key"), body.alias("value"), _headers(batch_id), _time(at))


def _headers(batch_id: int | None = None) -> Column:
    headers = [F.struct(F.lit("Key").alias("key"), F.uuid().alias("value"))]
    if batch_id is not None:
        headers.append(F.struct(F.lit(BATCH).alias("key"), F.lit(str(batch_id)).alias("value")))
    return F.array(*headers).alias("headers")


def _time(at: str | None) -> Column:
    return (F.current_timestamp() if at is None else F.col(at)).cast("timestamp").alias("timestamp")


def from_envelopes(
    envelopes: DataFrame, key: T.StructType = KEY, value: T.StructType | T.DataType = SUMMARY
) -> DataFrame:
    """(key, value, timestamp) of each record: structs, or a plain value where ``value`` is not a struct."""
    body = decode("value", value) if isinstance(value, T.StructType) else F.col("value").cast(value)
    return _texts(envelopes).select(decode("key", key).alias("key"), body.alias("value"), "timestamp")


def _texts(envelopes: DataFrame) -> DataFrame:
    # a broker delivers bytes
    return envelopes.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})


def summaries(envelopes: DataFrame, time: str | None = None) -> DataFrame:
    """The summary rows of the raw or the clean topic, with the time of their records as ``time``, if wanted."""
    times = [F.col("timestamp").alias(time)] if time else []
    return _texts(envelopes).select(_fields(decode("value", SUMMARY)), *times)


def _fields(struct: Column) -> Column:
    """The fields of a decoded text as columns. As a generator it is worked out once for a row; else Spark puts the decoding in place of each use of a field."""
    return F.inline(F.array(struct))


def grouped_counts(envelopes: DataFrame, key: T.StructType = KEY, time: str | None = None) -> DataFrame:
    """Key columns and ``amount`` of a grouped topic, whose values are bare numbers, and the time of the records, if wanted.

    Further columns, such as the ``id`` of the batch that wrote a record, are kept.
    """
    decoded = _texts(envelopes).withColumn("amount", F.col("value").cast("bigint"))
    others = [c for c in decoded.columns if c not in ENVELOPE.fieldNames()]
    times = [F.col("timestamp").alias(time)] if time else []
    return decoded.select(_fields(decode("key", key)), *others, *times)


def batch_of(headers: str = "headers") -> Column:
    """The micro-batch that wrote a record, from its headers; null for others."""
    return F.filter(headers, lambda h: h["key"] == BATCH)[0]["value"].cast("bigint")


def once(envelopes: DataFrame) -> DataFrame:
    """A stream of records with a watermark on their time, in which each is only taken the first time.

    For topics on file systems where a batch may appear twice: a record is known by its key and
    the batch that wrote it, and forgotten when the watermark has passed it.
    """
    named = envelopes.withColumn("_batch", batch_of())
    return named.dropDuplicatesWithinWatermark(["key", "_batch"]).drop("_batch")


def yearly_counts(envelopes: DataFrame) -> DataFrame:
    return from_envelopes(envelopes, GROUPED, T.LongType()).select("key.*", F.col("value").alias("amount"))


def ranked_to_envelopes(nested: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Year -> its ranked rows as one JSON array."""
    return nested.select(
        F.col("year").cast("string").alias("key"), encode_list("ranked", RANKED).alias("value"), _headers(batch_id), _time(None)
    )


def ranked_from_envelopes(envelopes: DataFrame) -> DataFrame:
    """Year and ranked rows of the top-N topic; further columns, such as the ``id`` of the batch, are kept."""
    others = [c for c in envelopes.columns if c not in ENVELOPE.fieldNames()]
    return _texts(envelopes).select(F.col("key").cast("int").alias("year"), decode_list("value", RANKED).alias("ranked"), *others)


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).parquet(path)


def topic_source(
    spark: SparkSession, path: str | None = None, format: str = "parquet", per_trigger: int | None = None, **options: str
) -> DataFrame:
    """A topic as a stream from its start.

    ``per_trigger`` paces the replay: files of a folder, records of a broker.
    """
    reader: DataStreamReader = spark.readStream.format(format)
    if format == "kafka":
        reader = reader.option("startingOffsets", "earliest").option("includeHeaders", True)
        limit = "maxOffsetsPerTrigger"
    else:
        reader = reader.schema(ENVELOPE)
        limit = "maxFilesPerTrigger"
    if per_trigger:
        reader = reader.option(limit, per_trigger)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(path) if path else reader.load()


def topic_sink(
    envelopes: DataFrame, checkpoint: str, path: str | None = None, format: str = "parquet", **options: str
) -> DataStreamWriter:
    """Append envelopes to a topic, each exactly once for folders."""
    if format == "kafka":  # a broker takes header values as bytes and sets the time itself
        envelopes = envelopes.withColumn("headers", F.col("headers").cast("array<struct<key:string,value:binary>>")).drop("timestamp")
    writer = envelopes.writeStream.format(format).outputMode("append").option("checkpointLocation", checkpoint)
    if path:
        writer = writer.option("path", path)
    for name, value in options.items():
        writer = writer.option(name, value)
    return writer


def console_sink(stream: DataFrame, mode: str = "append") -> DataStreamWriter:
    """Print a stream, for debugging."""
    return stream.writeStream.format("console").outputMode(mode).option("truncate", False)
