"""Aggregations per key, per window and per year."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantity import mean_quantity
from ..runtime import stage
from ..schemas import GROUPED, KEY
from ..settings import WINDOW


def grouped(clean: DataFrame, time: str | None = None) -> DataFrame:
    """Incidents and creatures per key, both from one shuffle of map-side combined rows; and the latest ``time`` counted, if wanted."""
    creatures = mean_quantity(F.col("species_quantity_min"), F.col("species_quantity_max"))
    return clean.groupBy(*KEY.fieldNames()).agg(
        F.count(F.lit(1)).alias("incidents"),
        F.coalesce(F.sum(creatures), F.lit(0)).alias("creatures"),
        *([F.max(time).alias(time)] if time else []),
    )


def yearly_totals(per_key: DataFrame, amount: str = "incidents") -> DataFrame:
    """Total per (year, species id, species name)."""
    return per_key.groupBy(*GROUPED.fieldNames()).agg(F.sum(amount).alias("amount"))


def yearly_incidents(clean: DataFrame) -> DataFrame:
    """``yearly_totals`` of the incidents straight from the rows: counts add up, so one shuffle is enough."""
    return clean.groupBy(*GROUPED.fieldNames()).agg(F.count(F.lit(1)).alias("amount"))


def latest_by_key(rows: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """The value of each key at its greatest ``order``."""
    return rows.groupBy(*keys).agg(F.max_by(value, _rank(order)).alias(value))


def tumbling_last(
    rows: DataFrame, keys: Sequence[str], value: str, ts: str, order: Sequence[str] = (), width: str = WINDOW
) -> DataFrame:
    """The last value of each key within each tumbling window."""
    last = F.max_by(value, _rank([ts, *order])).alias(value)
    return (
        rows.groupBy(F.window(ts, width).alias("w"), *keys)
        .agg(last)
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, value)
    )


def running_count(rows: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str] = ()) -> DataFrame:
    """How many rows of its key came up to and including each row.

    Counting a key in one window partition would put all its rows into one task. Rows are dealt by range of key and time
    instead, so that a hot key is spread however close its rows are in time; a row's number in its range is
    known without a shuffle, and the counts of the key's earlier ranges are added.
    """
    by = [*keys, ts, *order]
    # this number goes up by one along a sorted range
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    dealt = stage(dealt.withColumn("_part", F.shiftright("_at", 33)), "running")
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = dealt.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    shifts = runs.select(
        *[F.col(k).alias(f"_of_{k}") for k in (*keys, "_part")],
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    # null keys are keys, too
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in (*keys, "_part")])
    return dealt.join(shifts, same).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("running_count"))


def windowed_running_count(rows: DataFrame, keys: Sequence[str], ts: str, width: str = WINDOW) -> DataFrame:
    """``tumbling_last`` of ``running_count`` without numbering rows.

    The last running count of a window is the number of rows up to its end,
    so the rows are counted per window map-side and only the counts are summed.
    """
    up_to = Window.partitionBy(*keys).orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    per_window = (
        rows.groupBy(F.window(ts, width).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")
    )
    return per_window.withColumn("running_count", F.sum("n").over(up_to)).drop("n")


def windowed_last_sums(
    rows: DataFrame, keys: Sequence[str], group: Sequence[str], value: str, ts: str, order: Sequence[str] = (), width: str = WINDOW
) -> DataFrame:
    """window_start, window_end, ``group``, total: the last values of all keys in a window, summed per group, which is part of the keys.

    Two aggregations, of which the second takes the windows of the first as its time, so that a stream with a watermark
    can run both in one query and append each sum once. ``windowed_last_sum`` is the sum of these over all windows.
    """
    last = rows.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.max_by(value, _rank([ts, *order])).alias(value))
    sums = last.groupBy(F.window("w", width).alias("w"), *group).agg(F.sum(value).alias("total"))
    return sums.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *group, "total")


def windowed_last_sum(last_values: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Sum of the last values of all windows per group.

    A key that changes in several windows is added once per window. That is
    what this total means, and why it is never the default: ``yearly_totals``
    of the latest counts is exact.
    """
    return last_values.groupBy(*group).agg(F.sum(value).alias("total"))


def _rank(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)
