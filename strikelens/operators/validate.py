"""Data-quality profile, choice of rules, and row validation."""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import FIELD_RULES, PARSED_QUANTITY_RULES, RuleSet, all_valid, checks
from ..settings import STRICT_THRESHOLD

SPECIES, QUANTITY, OTHER = "species", "quantity", "other"
TOPIC_CLASSES = (SPECIES, QUANTITY, OTHER)


def topic_class(field: str) -> str:
    """Where rows failing on ``field`` go; quantity fields also carry "species" in their name, hence the order."""
    lowered = field.lower()
    for name in (QUANTITY, SPECIES):
        if name in lowered:
            return name
    return OTHER


def failures(field: str, rules: RuleSet = FIELD_RULES) -> Column:
    """Number of rules of ``field`` that a row fails."""
    return reduce(add, [F.when(check, 0).otherwise(1) for check in checks(field, rules[field])])


def profile(details: DataFrame, rules: RuleSet = FIELD_RULES) -> DataFrame:
    """One row: ``total`` and, per field, how often one of its rules failed. One pass, no shuffle of rows."""
    counts = [F.coalesce(F.sum(failures(field, rules)), F.lit(0)).alias(field) for field in rules]
    return details.agg(F.count(F.lit(1)).alias("total"), *counts)


def profile_rows(profiled: DataFrame) -> DataFrame:
    """The one-row profile as (field, failures, total) rows."""
    fields = [c for c in profiled.columns if c != "total"]
    return profiled.unpivot(["total"], fields, "field", "failures").select("field", "failures", "total")


def kept_fields(profiled: DataFrame, threshold: float = STRICT_THRESHOLD, keep_zero_failure: bool = False) -> DataFrame:
    """Fields worth validating: some rows fail, but fewer than ``threshold`` of all.

    A field without any failure is left out unless ``keep_zero_failure``.
    """
    kept = profile_rows(profiled).filter(F.col("failures") < F.col("total") * F.lit(threshold))
    return kept if keep_zero_failure else kept.filter("failures > 0")


def summary_fields(kept: DataFrame) -> DataFrame:
    """Kept fields by their names in a summary row, where the quantity text has become two columns."""
    bounds = F.array(*[F.lit(name) for name in PARSED_QUANTITY_RULES])
    names = F.when(F.col("field") == "species_quantity", bounds).otherwise(F.array("field"))
    return kept.select(F.explode(names).alias("field"))


def select_rules(
    profiled: DataFrame,
    threshold: float = STRICT_THRESHOLD,
    rules: RuleSet = FIELD_RULES,
    keep_zero_failure: bool = False,
) -> RuleSet:
    """Rules to apply to summary rows. Brings one row per field to the driver, never data rows."""
    chosen = summary_fields(kept_fields(profiled, threshold, keep_zero_failure))
    available = {**rules, **PARSED_QUANTITY_RULES}
    names = {row.field for row in chosen.collect()}
    return {name: available[name] for name in available if name in names}


def invalid_topics(rules: RuleSet) -> Column:
    """Classes a summary row fails, as an array in the order species, quantity, other; empty when valid."""
    flags = []
    for name in TOPIC_CLASSES:
        checks = [all_valid(field, rules[field]) for field in rules if topic_class(field) == name]
        if checks:
            valid = reduce(lambda a, b: a & b, checks)
            flags.append(F.when(~valid, F.lit(name)))
    return F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")


def failing_by_field(rows: DataFrame, rules: RuleSet) -> DataFrame:
    """Distinct rows that fail, once for each field that they fail, in ``field``.

    Repeats are removed before rows are multiplied, so one shuffle of the failing rows, combined in each task, serves all fields.
    """
    failed = F.array_compact(F.array(*[F.when(~all_valid(field, rules[field]), F.lit(field)) for field in rules]))
    invalid = rows.filter(~reduce(and_, [all_valid(field, rules[field]) for field in rules])) if rules else rows.limit(0)
    return invalid.dropDuplicates().select("*", F.explode(failed if rules else F.array().cast("array<string>")).alias("field"))


def failing_rows(details: DataFrame, field: str, rules: RuleSet = FIELD_RULES) -> DataFrame:
    """Distinct rows that fail a rule of ``field``."""
    return details.filter(~all_valid(field, rules[field])).dropDuplicates()
