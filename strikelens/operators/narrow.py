"""Narrowing of raw records to the columns of interest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantity import mean_quantity, parse_quantity
from ..schemas import KEY, SUMMARY


def upper_ids(rows: DataFrame, column: str = "species_id") -> DataFrame:
    return rows.withColumn(column, F.upper(column))


def to_summary(details: DataFrame) -> DataFrame:
    """Raw record -> summary: the quantity text becomes two bounds, the other columns are kept as they are."""
    low, high = parse_quantity(F.col("species_quantity"))
    bounds = {"species_quantity_min": low, "species_quantity_max": high}
    return details.select(
        [bounds.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SUMMARY]
    )


def with_mean_quantity(rows: DataFrame, name: str = "mean_quantity") -> DataFrame:
    return rows.withColumn(
        name, mean_quantity(F.col("species_quantity_min"), F.col("species_quantity_max"))
    )


def key_columns() -> list[str]:
    return KEY.fieldNames()
