"""The streaming jobs; each takes rows and returns a writer, so that the caller chooses the trigger.

Rules and code repairs come from a batch preparation and are frozen before a
stream starts. State lives under the checkpoint folder of a query: a new
folder is a fresh run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators import rank, route, totals
from ..runtime import adaptive
from ..schemas import GROUPED, KEY
from ..sources import csv_files, topics
from ..settings import REWRITE_TICK, TOP_N, WINDOW
from .changelog import Changelog
from .upserts import UpsertLog

KEY_COUNTS = ["incidents", "creatures"]


def counts_log(path: str, **options: int) -> UpsertLog:
    """Log of the counts per key, with a folder per year."""
    return UpsertLog(path, KEY.fieldNames(), KEY_COUNTS, partition="year", **options)


def totals_log(path: str, **options: int) -> UpsertLog:
    """Log of the totals per species and year, with a folder per year."""
    return UpsertLog(path, GROUPED.fieldNames(), ["amount"], partition="year", **options)


def ranking_log(path: str, **options: int) -> UpsertLog:
    """Log of the ranked rows per year."""
    return UpsertLog(path, ["year"], ["ranked"], **options)


def append_rows(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append rows to a folder, each exactly once."""
    return rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)


def quarantine(validated: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Invalid rows, in one sub-folder per topic."""
    return append_rows(route.fan_out(validated), path, checkpoint).partitionBy("topic")


def clean_topic(validated: DataFrame, path: str, checkpoint: str, at: str | None = None) -> DataStreamWriter:
    """Clean rows as keyed JSON records; ``at`` names the column with their time, the current time by default."""
    return topics.topic_sink(topics.to_envelopes(route.clean(validated), at=at), checkpoint, path)


def count_keys(clean: DataFrame, log: UpsertLog, checkpoint: str) -> DataStreamWriter:
    """Counts per key, upserted as they change."""
    return each_batch(totals.grouped(clean), log.write, checkpoint)


def publisher(topics_of: dict[str, str], key: T.StructType = KEY, time: str | None = None):
    """A ``foreachBatch`` function that writes the rows of a batch to a changelog topic for each column: ``{column: path}``.

    ``time`` names the column with the time of the records. Each topic has each batch once, also after a failure anywhere in between.
    A batch has as many files as its size asks for, whatever the number of tasks, because readers take so many files at a time.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        # evaluated once for all topics, and by the stateful plan only once
        batch.persist()
        try:
            written = [
                Changelog(path).publish(topics.to_envelopes(batch.hint("rebalance"), key, column, time, batch_id), batch_id) for column, path in topics_of.items()
            ]
            if not any(written):
                # a batch that runs again has to update its state all the same
                batch.write.format("noop").mode("overwrite").save()
        finally:
            batch.unpersist()

    return publish


def publish_counts(clean: DataFrame, incidents: str, creatures: str, checkpoint: str, time: str | None = None) -> DataStreamWriter:
    """Both counts per key as changelog topics: a record for every key that changed in a batch, with the latest ``time`` counted."""
    return each_batch(totals.grouped(clean, time), publisher({"incidents": incidents, "creatures": creatures}, time=time), checkpoint)


def rank_years(
    clean: DataFrame, counts: UpsertLog, ranking: UpsertLog, checkpoint: str, n: int = TOP_N
) -> DataStreamWriter:
    """Top ``n`` per year from the latest count of every key; only years with changes are read and ranked again.

    Totals are taken from the latest counts and never added up over time, so
    the ranking equals the batch ranking after every batch.
    """

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counts.write(batch, batch_id)
        current = counts.latest(spark, batch_id, only=counts.touched(spark, batch_id))
        ranking.write(rank.nested_by_year(rank.top_n_per_year(totals.yearly_totals(current), n)), batch_id)

    return each_batch(totals.grouped(clean), update, checkpoint)


def sum_windows(
    counts: DataFrame, keys: Sequence[str], group: Sequence[str], time: str, path: str, checkpoint: str,
    value: str = "amount", width: str = WINDOW, lateness: str = "0 seconds",
) -> DataStreamWriter:
    """From a grouped topic as a stream: of each window that closes, the last counts of its keys summed per group, as a topic.

    Both aggregations are in one query that only appends; the time of the records is the end of their window.
    """
    sums = totals.windowed_last_sums(counts.withWatermark(time, lateness), keys, group, value, time, width=width)
    publish = publisher({"total": path}, T.StructType([sums.schema[c] for c in group]), "window_end")
    return each_batch(sums, publish, checkpoint, mode="append")


def add_windows(sums: DataFrame, group: Sequence[str], log: UpsertLog, checkpoint: str) -> DataStreamWriter:
    """The windows' sums added up per group, upserted as they change."""
    return each_batch(sums.groupBy(*group).agg(F.sum("amount").alias("amount")), log.write, checkpoint)


def rank_windows(sums: DataFrame, log: UpsertLog, topic: str, checkpoint: str, n: int = TOP_N) -> DataStreamWriter:
    """The windows' sums added up per species and year, and a record in the top-N topic for each year that they change."""

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log.write(batch, batch_id)
        ranked = rank.top_n_per_year(log.latest(spark, batch_id, only=log.touched(spark, batch_id)), n)
        Changelog(topic).publish(topics.ranked_to_envelopes(rank.nested_by_year(ranked), batch_id), batch_id)

    summed = sums.groupBy(*GROUPED.fieldNames()).agg(F.sum("amount").alias("amount"))
    return each_batch(summed, update, checkpoint)


def write_snapshot(counts: UpsertLog, ranking: UpsertLog, outputs: tuple[str, str], spark: SparkSession, n: int = TOP_N) -> None:
    """Both outputs anew as of now: ranked from the counts, and as kept by the stream. Readers see the former output or this one, whole."""
    from_counts, from_ranking = outputs
    ranked = rank.top_n_per_year(totals.yearly_totals(counts.latest(spark)), n)
    csv_files.publish_ranked(rank.in_output_order(ranked), from_counts)
    kept = rank.exploded_by_year(ranking.latest(spark))
    csv_files.publish_ranked(rank.in_output_order(kept), from_ranking)


def rewrite_outputs(
    counts: UpsertLog, ranking: UpsertLog, outputs: tuple[str, str], spark: SparkSession, n: int = TOP_N, tick: str = REWRITE_TICK
) -> DataStreamWriter:
    """``write_snapshot`` on a clock of its own, whatever the pace of the stream that fills the logs; stopped like any other query.

    The clock is a source of one row a second, of which nothing is used. A tick before the first batch writes nothing, nor does one
    that finds both logs as they were at the last rewrite. The source never ends, so ``run.ticked`` waits for a rewrite.
    """
    rewritten = None

    def update(_: DataFrame, batch_id: int) -> None:
        nonlocal rewritten
        # looked at before they are read: what is logged meanwhile is left to the next tick
        found = counts.last(spark), ranking.last(spark)
        if None in found or found == rewritten:
            return
        write_snapshot(counts, ranking, outputs, spark, n)
        rewritten = found

    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return clock.writeStream.foreachBatch(update).trigger(processingTime=tick)


def close_windows(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    ts: str,
    path: str,
    checkpoint: str,
    order: Sequence[str] = (),
    width: str = WINDOW,
    lateness: str = "0 seconds",
) -> DataStreamWriter:
    """The last value per key and tumbling window, emitted once, when the window closes.

    Without lateness a window closes as soon as time has passed its end; rows
    that come after that are dropped. Windows still open when the input ends
    are not emitted.
    """
    closed = totals.tumbling_last(rows.withWatermark(ts, lateness), keys, value, ts, order, width)
    return append_rows(closed, path, checkpoint)


def each_batch(counts: DataFrame, function, checkpoint: str, mode: str = "update") -> DataStreamWriter:
    """What ``function`` does with a batch is planned by its size; the state keeps its partitions."""

    def adapted(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            function(batch, batch_id)

    return counts.writeStream.outputMode(mode).foreachBatch(adapted).option("checkpointLocation", checkpoint)
