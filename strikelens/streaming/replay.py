"""Rows offered to a topic a bounded number at a time, in order, the remainder kept for later."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import new_folder, shuffles_end, stage, unsorted
from ..settings import BATCH_ROWS
from ..sources.files import Files

#: Waiting records are long texts that are much alike. Small row groups, because a task has a file open for every tick it has records of.
_FILES = {"compression": "zstd", "parquet.block.size": 8 << 20}


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``place``, from 0 in ``order``; written.

    Rows are dealt by range, and the sizes of the ranges before are added to a row's place in its own: one
    number for each range is all that comes together in one task.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt = stage(dealt.withColumn("_part", F.shiftright("_at", 33)), "numbered")
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return dealt.join(shifts, "_part").withColumn("place", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


class Replay:
    """Records waiting to be offered, one file for each tick, or a few if it is very large or not gathered.

    ``by_rows`` and ``by_time`` write the files ahead; ``offer`` moves the next one into the topic and is no
    Spark job. A file gets the time of its offer, by which streams order files, so a reader that takes one file
    per micro-batch has the ticks as its batches. What was offered is seen from what is left, so a replay goes on
    after a restart with the next tick.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.files = spark, folder, Files(spark)

    @classmethod
    def by_rows(cls, envelopes: DataFrame, order: list[Column], rows: int = BATCH_ROWS) -> Replay:
        """At most ``rows`` records per tick. ``order`` must be of columns of ``envelopes``."""
        placed = numbered(envelopes, order)
        return cls._written(placed.withColumn("tick", F.floor(F.col("place") / rows)).drop("place"))

    @classmethod
    def by_time(cls, envelopes: DataFrame, width: str, gathered: bool = True) -> Replay:
        """The records of one window of their time per tick; windows without records have none.

        Unless they are ``gathered``, which shuffles every record, a tick has a file from each task that has records of it;
        ``run.drain_ticks`` takes a tick of however many files.
        """
        start = F.unix_seconds(F.window("timestamp", width)["start"])
        return cls._written(envelopes.withColumn("tick", start), gathered)

    @classmethod
    def _written(cls, ticked: DataFrame, gathered: bool = True) -> Replay:
        spark = ticked.sparkSession
        folder = new_folder(spark, "replay")
        if gathered:
            # a tick is brought together, and cut again where it is too much for one task
            ticked = ticked.hint("rebalance", "tick")
        with shuffles_end(spark), unsorted(spark):
            ticked.write.options(**_FILES).partitionBy("tick").parquet(folder)
        return cls(spark, folder)

    def waiting(self) -> list[int]:
        """The ticks not yet offered, in order; names only."""
        return sorted(int(name.removeprefix("tick=")) for name in self.files.names(f"{self.folder}/tick=*"))

    def size(self) -> int:
        """Bytes of what is not yet offered."""
        return self.files.size(self.folder)

    def offer(self, topic: str, ticks: int = 1) -> int:
        """Moves the next ``ticks`` into the topic, in order, and says how many there were."""
        chosen = self.waiting()[:ticks]
        for tick in chosen:
            source = f"{self.folder}/tick={tick}"
            for name in sorted(self.files.names(f"{source}/part-*")):
                self.files.stamp(f"{source}/{name}")
                self.files.move(f"{source}/{name}", f"{topic}/{tick:020d}-{name}")
            self.files.delete(source)
        return len(chosen)

    def offer_paced(self, topic: str, seconds: float = 0.7) -> int:
        """Offers a tick every so many seconds until none is left; for feeds that imitate a live one."""
        n = 0
        while self.offer(topic):
            n += 1
            time.sleep(seconds)
        return n
