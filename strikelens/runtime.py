"""Session construction and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_fallback: str | None = None


def build_session(app: str = "strikelens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library is tuned for.

    On a cluster leave ``master`` unset and pass ``spark.checkpoint.dir``; the
    number of shuffle partitions is then an upper bound which adaptive
    execution coalesces.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # streaming state of many keys lives on disk and is saved as changes
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    global _local_fallback
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_fallback is None:
        _local_fallback = tempfile.mkdtemp(prefix="strikelens-")
    return _local_fallback


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the work folder; no run ever sees another run's files."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Staged tables up to this size are worked on in one task.
ONE_TASK_BYTES = 16 << 20


@contextmanager
def one_job_if_small(staged: DataFrame) -> Iterator[None]:
    """While it lasts, an action on a staged table whose files are small is one job with one task a stage.

    Adaptive execution makes a job of every exchange, which costs more than the work on a small table. Above
    ``ONE_TASK_BYTES`` nothing is changed.
    """
    if int(str(staged._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > ONE_TASK_BYTES:
        yield
        return
    wanted = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    conf = staged.sparkSession.conf
    before = {key: conf.get(key) for key in wanted}
    for key, value in wanted.items():
        conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            conf.set(key, value)


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """While it lasts, plans of this session adapt to the size of their rows, and what is rebalanced has files of the advised size.

    For ``foreachBatch``: a stream with state turns adaptive execution off, also for what is done with its batches, which would then have
    a task and a file for each shuffle partition, however few their rows are.
    """
    with _set(spark, {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}):
        yield


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """While it lasts, what a write has shuffled is deleted when the write ends.

    Otherwise it stays on the disks until the driver happens to collect its plan, beside what the next steps shuffle and write.
    """
    with _set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


#: Files of a partitioned table that a task has open at a time before it sorts the rest of its rows.
OPEN_FILES = 32


@contextmanager
def unsorted(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a task writes its rows to the folders of a partitioned table as they come.

    Otherwise it sorts them first, on its disk if they are many.
    """
    with _set(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
        yield


@contextmanager
def _set(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


#: Of the records that a stream starts with, so many bytes are left to a partition of its state.
STATE_BYTES = 32 << 20


@contextmanager
def state_for(spark: SparkSession, size: int) -> Iterator[None]:
    """Streams that start while it lasts have partitions of their state for an input of ``size`` bytes.

    A partition of the state costs its files in every micro-batch, whatever it holds. There is one for each core at least,
    and ``spark.sql.shuffle.partitions`` is an upper bound, as in batch. A stream that starts again keeps those of its checkpoint.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    wanted = max(spark.sparkContext.defaultParallelism, -(-size // STATE_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", min(int(before), wanted))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the work folder and read it back.

    Cuts the lineage in a way that outlives lost executors. The scan of the
    written files also carries their true size, so a later join broadcasts
    the table only while it is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
