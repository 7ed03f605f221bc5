"""Latest value per key of an update-mode stream, kept as Parquet files."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import Files


class UpsertLog:
    """One folder of upserts per micro-batch; the latest batch of a key holds its value.

    A batch that runs again overwrites its own folder, so replays change
    nothing. Every ``fold_every`` batches the latest values are written out as
    a new base, and readers start from there: what they read is bounded by the
    number of keys and not by the age of the stream. What a base replaces is deleted
    when the next one is complete, so that running readers have a whole generation to end.

    With ``partition``, a key of few values, batches and bases have a folder per value, and who wants some
    values reads those folders only.
    """

    def __init__(self, path: str, keys: Sequence[str], values: Sequence[str], fold_every: int = 20, partition: str | None = None):
        self.path = path
        self.keys = list(keys)
        self.values = list(values)
        self.fold_every = fold_every
        self.partition = partition
        self._layout: T.StructType | None = None

    def _read(self, spark: SparkSession, *folders: str, kind: str) -> DataFrame:
        """Folders of batches or bases; their layout is stored, because a partitioned one without rows has no file."""
        if self._layout is None:
            self._layout = T.StructType.fromJson(json.loads(Files(spark).read(f"{self.path}/_layout")))
        return spark.read.schema(_with_id(self._layout)).option("basePath", f"{self.path}/{kind}").parquet(*folders)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function of this log."""
        if self._layout is None:
            self._layout = batch.select(*self.keys, *self.values).schema
            Files(batch.sparkSession).write(f"{self.path}/_layout", self._layout.json())
        self._write(batch.select(*self.keys, *self.values), self._batch(batch_id))
        if (batch_id + 1) % self.fold_every == 0:
            self._write(self.latest(batch.sparkSession, batch_id), self._base(batch_id))
            self._forget(batch.sparkSession, batch_id)

    def _write(self, rows: DataFrame, path: str) -> None:
        writer = rows.write.mode("overwrite")
        if self.partition:
            # one file per value and not one per task; Spark splits values that are too large
            rows = rows.hint("rebalance", self.partition)
            writer = rows.write.mode("overwrite").partitionBy(self.partition)
        writer.parquet(path)

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        """Deletes what the base before that of ``batch_id`` has replaced."""
        bases = _written(spark, f"{self.path}/bases")
        former = max((b for b in bases if b < batch_id), default=-1)
        old = [self._base(b) for b in bases if b < former]
        old += [self._batch(b) for b in _written(spark, f"{self.path}/batches") if b <= former]
        for folder in old:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self._read(spark, self._batch(batch_id), kind="batches")

    def last(self, spark: SparkSession) -> int | None:
        """The last batch that was written, None before the first."""
        return max(_written(spark, f"{self.path}/batches"), default=None)

    def touched(self, spark: SparkSession, batch_id: int) -> list:
        """The values of ``partition`` that a batch wrote; read from the names of its folders by Spark."""
        return [row[0] for row in self.batch(spark, batch_id).select(self.partition).distinct().collect()]

    def latest(self, spark: SparkSession, upto: int | None = None, only: Sequence | None = None) -> DataFrame:
        """Latest values after batch ``upto``, or after the last one; of ``only`` these values of ``partition``, if given."""
        batches = [b for b in _written(spark, f"{self.path}/batches") if upto is None or b <= upto]
        if not batches:
            raise ValueError(f"no batch was written to {self.path}")
        bases = [b for b in _written(spark, f"{self.path}/bases") if upto is None or b < upto]
        base = max(bases, default=-1)
        folders = [self._batch(b) for b in batches if b > base]
        if folders:
            rows = self._read(spark, *folders, kind="batches")
        if base >= 0:
            kept = self._read(spark, self._base(base), kind="bases")
            rows = rows.unionByName(kept) if folders else kept
        if only is not None:
            chosen = F.col(self.partition).isin([v for v in only if v is not None])
            rows = rows.filter(chosen | F.col(self.partition).isNull() if None in only else chosen)
        newest = [F.max_by(value, "id").alias(value) for value in self.values]
        return rows.groupBy(*self.keys).agg(*newest)

    def _batch(self, batch_id: int) -> str:
        return f"{self.path}/batches/id={batch_id}"

    def _base(self, batch_id: int) -> str:
        return f"{self.path}/bases/id={batch_id}"


def _with_id(layout: T.StructType) -> T.StructType:
    return T.StructType([*layout.fields, T.StructField("id", T.LongType())])


def _written(spark: SparkSession, folder: str) -> list[int]:
    """Ids of the completely written folders, ascending; lists names only."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/id=*/_SUCCESS")
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jvm_path)
    return sorted(int(f.getPath().getParent().getName().removeprefix("id=")) for f in files or [])
