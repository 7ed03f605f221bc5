"""Mixing sources to target weights.

Tokens are summed per source, a target is derived for each source from its weight,
and a document is emitted ``floor(rate)`` times plus once more with the probability
of the fraction, ``rate`` being target over size of its source. The coin is a hash
of the seed and the identifier, so reruns and retried tasks agree.

Only one row per source is shuffled and joined back; documents stay where they are
unless the table of sources is too large to broadcast, in which case adaptive
execution splits the join's hot sources.

Null text has size 0, a null source is a source of its own, rows with one
identifier share their coin, repeated rows count each on their own. Sources of size 0 and empty tables have
target 0. Extra columns pass through; ``plan`` replaces those named as its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strikelens.llm.common import unit_hash, whole_text, word_count

WEIGHTS = (3, 1, 2)
#: The mix takes 3/2 of all words and no source more than twice.
SHARE = (3, 2)
MOST = 2
SEED = "mix-1"


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST
) -> DataFrame:
    """Targets of sources, given (source, source_size): ``min(most * size, level * weight)``.

    The level is what is left when the excess of full sources is dealt out again
    by weight until none is above its limit. Sources in ascending order of size
    by weight fill up one after the other; a source is full if the level at which it
    fills does not yet need more than there is. The frame has one row per source, so its windows see
    no documents.
    """
    up, down = share
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    deep = "decimal(38,0)"
    return (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("total", F.sum("source_size").over(everything).cast(deep))
        .withColumn("filled", F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0)).cast(deep))
        .withColumn("open_weight", F.sum("weight").over(onwards))
        .withColumn(
            "full",
            down * (F.col("weight") * F.col("filled") + most * F.col("source_size") * F.col("open_weight").cast(deep))
            <= up * F.col("weight") * F.col("total"),
        )
        .withColumn("left", (up * F.col("total") - down * F.sum(F.when(F.col("full"), most * F.col("source_size")).otherwise(0)).over(everything)).cast("double") / down)
        .withColumn("left_weight", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything))
        .select(
            "source",
            "source_size",
            F.when(F.col("full"), (most * F.col("source_size")).cast("double"))
            .otherwise(F.col("left") * F.col("weight") / F.col("left_weight"))
            .alias("target"),
        )
    )


def plan(docs: DataFrame, seed: str = SEED, **targets) -> DataFrame:
    """``docs`` with size, source_size, target and copies, the number of times each row is emitted."""
    sized = docs.withColumn("size", word_count(whole_text()))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    of_source = source_targets(totals, **targets).withColumnRenamed("source", "_mix_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        sized.drop("source_size", "target", "copies")
        .join(of_source, F.col("source").eqNullSafe(F.col("_mix_source")))
        .withColumn("_mix_rate", rate)
        .withColumn(
            "copies",
            (
                F.floor("_mix_rate")
                + F.when(unit_hash(F.lit(seed), F.col("doc_id")) < F.col("_mix_rate") - F.floor("_mix_rate"), 1).otherwise(0)
            ).cast("int"),
        )
        .drop("_mix_source", "_mix_rate")
    )


def mix(docs: DataFrame, seed: str = SEED, **targets) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the columns of ``docs``."""
    counted = plan(docs.select("*", F.struct("*").alias("_mix_row")), seed, **targets)
    return counted.select(F.explode(F.array_repeat("_mix_row", F.col("copies"))).alias("_mix_row")).select("_mix_row.*")
