"""Routing of validated rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import RuleSet
from ..settings import INVALID_OTHER, INVALID_QUANTITY, INVALID_SPECIES
from .validate import OTHER, QUANTITY, SPECIES, invalid_topics

TOPIC_NAMES: Mapping[str, str] = {
    SPECIES: INVALID_SPECIES,
    QUANTITY: INVALID_QUANTITY,
    OTHER: INVALID_OTHER,
}


def with_topics(summary: DataFrame, rules: RuleSet) -> DataFrame:
    return summary.withColumn("topics", invalid_topics(rules))


def fan_out(validated: DataFrame, names: Mapping[str, str] = TOPIC_NAMES) -> DataFrame:
    """Every invalid row once per class it fails, with the ``topic`` it is sent to. No shuffle."""
    topic_of = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    columns = [c for c in validated.columns if c != "topics"]
    exploded = validated.select(*columns, F.explode("topics").alias("topic"))
    return exploded.withColumn("topic", topic_of[F.col("topic")])


def clean(validated: DataFrame) -> DataFrame:
    """Valid rows that damaged the aircraft. A row whose damage flag is null is not clean."""
    return validated.filter((F.size("topics") == 0) & F.col("aircraft_damage")).drop("topics")
