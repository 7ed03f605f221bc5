"""Topics that a stream writes from ``foreachBatch``, each batch once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import Files


class Changelog:
    """A topic with one folder of records per micro-batch.

    Records are written aside and moved into the topic in one step, and a batch
    that is there already is not written again: after a failure between the write and the commit
    of a batch its files keep their names, so a stream that reads the topic takes them in once.
    A replayed batch has the same records, because sources and state are replayed from the checkpoint. On file systems that
    move a folder file by file, readers pass the records through ``topics.once``.
    """

    def __init__(self, path: str):
        self.path = path

    def publish(self, records: DataFrame, batch_id: int) -> bool:
        """Writes the records of a batch; false if they were there."""
        files = Files(records.sparkSession)
        target = f"{self.path}/id={batch_id}"
        if files.exists(f"{target}/_SUCCESS"):
            return False
        # names that begin with an underscore are not seen by readers
        aside = f"{self.path}/_aside/{batch_id}-{uuid.uuid4().hex}"
        records.write.parquet(aside)
        files.delete(target)
        files.move(aside, target)
        return True

    def batches(self, spark: SparkSession) -> list[int]:
        return sorted(int(name.removeprefix("id=")) for name in Files(spark).names(f"{self.path}/id=*"))
