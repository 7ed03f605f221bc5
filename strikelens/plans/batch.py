"""The batch dataflow: one preparing scan, then a lazy plan from raw records to ranked rows."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import FIELD_RULES, RuleSet, from_specification, to_specification
from ..operators import codes, rank, route, totals, validate
from ..operators.narrow import to_summary
from ..runtime import one_job_if_small, shuffles_end, stage
from ..settings import STREAM_SALTS, STRICT_THRESHOLD, TOP_N
from ..sources.files import Files, Versions


def scan_codes_and_profile(details: DataFrame, rules: RuleSet = FIELD_RULES) -> DataFrame:
    """Pairs and rule failures in one pass over the raw records.

    The failure counts are summed per pair, so the result has as many rows as
    there are distinct pairs, and the counts over one kind are those of all rows.
    """
    failures = [validate.failures(field, rules).alias(f"failed_{field}") for field in rules]
    columns = [c for pair in codes.CODE_COLUMNS.values() for c in pair]
    counted = details.select(*columns, F.lit(1).alias("total"), *failures)
    return codes.code_counts(counted, ["total", *[f"failed_{field}" for field in rules]])


@dataclass(frozen=True)
class Preparation:
    """What the raw records decide before rows flow: small staged tables and the chosen rules."""

    pairs: DataFrame
    repairs: DataFrame
    lookups: set[tuple[str, str]]
    profile: DataFrame
    rules: RuleSet


def prepare(
    details: DataFrame,
    threshold: float = STRICT_THRESHOLD,
    rules: RuleSet = FIELD_RULES,
    keep_zero_failure: bool = False,
) -> Preparation:
    """Scan the raw records once, and stage what the row plan needs.

    The rules are chosen on unrepaired rows and later applied to repaired ones.
    """
    with shuffles_end(details.sparkSession):
        scanned = stage(scan_codes_and_profile(details, rules), "codes")
    sums = {"total": "total", **{field: f"failed_{field}" for field in rules}}
    profiled = scanned.filter(F.col("kind") == codes.SPECIES).agg(
        *[F.coalesce(F.sum(column), F.lit(0)).alias(name) for name, column in sums.items()]
    )
    pairs = codes.known_pairs(scanned)
    with one_job_if_small(scanned):
        repairs = stage(codes.code_repairs(pairs), "repairs")
        chosen = validate.select_rules(profiled, threshold, rules, keep_zero_failure)
    with one_job_if_small(repairs):
        lookups = codes.needed_lookups(repairs)
    return Preparation(pairs=pairs, repairs=repairs, lookups=lookups, profile=profiled, rules=chosen)


#: The tables of a preparation and the file of what is no table, as stored.
_TABLES = ("pairs", "repairs", "profile")
_CHOICES = "choices.json"


def store(prepared: Preparation, folder: str) -> None:
    """Keeps a preparation as a new version in ``folder``, beside the checkpoints of the streams that use it."""
    spark = prepared.pairs.sparkSession

    def write(version: str) -> None:
        for name in _TABLES:
            getattr(prepared, name).write.parquet(f"{version}/{name}")
        choices = {"rules": to_specification(prepared.rules), "lookups": sorted(prepared.lookups)}
        Files(spark).write(f"{version}/{_CHOICES}", json.dumps(choices))

    Versions(spark, folder).publish(write)


def stored(spark: SparkSession, folder: str) -> Preparation | None:
    """The preparation last stored in ``folder``, None if there is none. The raw records are not looked at."""
    version = Versions(spark, folder).current()
    if version is None:
        return None
    choices = json.loads(Files(spark).read(f"{version}/{_CHOICES}"))
    tables = {name: spark.read.parquet(f"{version}/{name}") for name in _TABLES}
    lookups = {tuple(lookup) for lookup in choices["lookups"]}
    return Preparation(rules=from_specification(choices["rules"]), lookups=lookups, **tables)


def prepared_once(details: DataFrame, folder: str, **options) -> Preparation:
    """The preparation stored in ``folder``, made from ``details`` when there is none: a restart goes on with the rules it had."""
    spark = details.sparkSession
    if Versions(spark, folder).current() is None:
        store(prepare(details, **options), folder)
    return stored(spark, folder)


def repaired_summary(details: DataFrame, prepared: Preparation) -> DataFrame:
    return codes.apply_repairs(to_summary(details), prepared.repairs, prepared.lookups)


def validated(details: DataFrame, prepared: Preparation) -> DataFrame:
    return route.with_topics(repaired_summary(details, prepared), prepared.rules)


def clean_summaries(summary: DataFrame, prepared: Preparation, salts: int = STREAM_SALTS) -> DataFrame:
    """Clean incidents from rows that are summaries already, as topics hold them; repairs leave further columns alone.

    The lookups are salted, because what follows in a stream has state, so Spark splits no hot code by itself.
    """
    repaired = codes.apply_repairs(summary, prepared.repairs, prepared.lookups, salts=salts)
    return route.clean(route.with_topics(repaired, prepared.rules))


def clean_incidents(details: DataFrame, prepared: Preparation) -> DataFrame:
    return route.clean(validated(details, prepared))


def grouped_incidents(details: DataFrame, prepared: Preparation) -> DataFrame:
    return totals.grouped(clean_incidents(details, prepared))


def top_n_per_year(details: DataFrame, threshold: float = STRICT_THRESHOLD, n: int = TOP_N) -> DataFrame:
    """Raw records -> the ``n`` species with most damaging incidents per year."""
    per_year = totals.yearly_incidents(clean_incidents(details, prepare(details, threshold)))
    return rank.in_output_order(rank.top_n_per_year(per_year, n))
