"""Connected components of links by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikelens.runtime import stage


def components(links: DataFrame) -> DataFrame:
    """node, root for every end of ``links`` (a, b); the root is the smallest node that links reach.

    Every round gives a node the smallest label around it and then that label's
    own label, so that chains shorten by half. A round is written, which cuts its lineage.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    edges = stage(both.toDF("node", "other"), "edges")
    labels = stage(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "labels")
    while True:
        around = edges.join(labels.toDF("other", "root"), "other").groupBy("node").agg(F.min("root").alias("near"))
        lower = labels.join(around, "node", "left").select(
            "node", "root", F.least("root", F.coalesce("near", "root")).alias("now")
        )
        jumps = labels.toDF("now", "further")
        moved = lower.join(jumps, "now", "left").select(
            "node", F.col("root").alias("was"), F.least("now", F.coalesce("further", "now")).alias("root")
        )
        moved = stage(moved, "labels")
        labels = moved.select("node", "root")
        if moved.filter("was <> root").isEmpty():
            return labels
