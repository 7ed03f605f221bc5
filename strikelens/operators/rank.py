"""Ranking within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import RANKED
from ..settings import TOP_N


def _by_amount() -> list[Column]:
    """Largest first; equal amounts in the order of their codes, so that ranks are reproducible."""
    return [F.desc("amount"), F.asc("species_id"), F.asc("species_name")]


def top_n_per_year(totals: DataFrame, n: int = TOP_N) -> DataFrame:
    """The ``n`` largest totals of each year with a 0-based index.

    The filter on the row number lets Spark cut each year to ``n`` rows per
    task before the shuffle.
    """
    position = F.row_number().over(Window.partitionBy("year").orderBy(*_by_amount()))
    ranked = totals.withColumn("position", position).filter(F.col("position") <= n)
    fields = {"index": F.col("position") - 1}
    return ranked.select([fields.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RANKED])


def in_output_order(ranked: DataFrame) -> DataFrame:
    return ranked.orderBy("year", "index")


def nested_by_year(ranked: DataFrame) -> DataFrame:
    """One row per year with its ranked rows in order; at most ``n`` per year, as ranked before."""
    row = F.struct(*RANKED.fieldNames())
    return ranked.groupBy("year").agg(F.sort_array(F.collect_list(row)).alias("ranked"))


def exploded_by_year(nested: DataFrame) -> DataFrame:
    return nested.select(F.explode("ranked").alias("r")).select("r.*")


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_position", position).filter("_position = 1").drop("_position")


def merge_top_n(ranked: DataFrame, updates: DataFrame, n: int = TOP_N) -> DataFrame:
    """Ranked rows after growing totals (year, species_id, species_name, amount) arrived.

    Right only for totals that never shrink: what fell out of the ranking is
    gone, and comes back with its next, larger total.
    """
    columns = ["year", "species_id", "species_name", "amount"]
    candidates = ranked.select(columns).unionByName(updates.select(columns))
    largest = first_per_key(candidates, ["year", "species_id"], [F.desc("amount"), F.asc("species_name")])
    return top_n_per_year(largest, n)
