"""Files and folders of whatever file system a path names; names and small texts only, never rows."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


class Files:
    """The file system calls that the library needs, through Hadoop."""

    #: The time last given to a file, in milliseconds; the next one is later.
    _stamped = 0

    def __init__(self, spark: SparkSession):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.conf = spark._jsc.hadoopConfiguration()

    def _of(self, path: str):
        found = self.path(path)
        return found, found.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        found, system = self._of(path)
        return system.exists(found)

    def make(self, path: str) -> None:
        """Makes a folder."""
        found, system = self._of(path)
        system.mkdirs(found)

    def delete(self, path: str) -> None:
        found, system = self._of(path)
        system.delete(found, True)

    def move(self, source: str, target: str) -> None:
        """Moves a file or a folder to a place where there is none."""
        found, system = self._of(source)
        system.mkdirs(self.path(target).getParent())
        if not system.rename(found, self.path(target)):
            raise OSError(f"could not move {source} to {target}")

    def size(self, path: str) -> int:
        """Bytes of all files in a folder."""
        found, system = self._of(path)
        return system.getContentSummary(found).getLength()

    def names(self, pattern: str) -> list[str]:
        found, system = self._of(pattern)
        return [status.getPath().getName() for status in system.globStatus(found) or []]

    def stamp(self, path: str) -> None:
        """Gives a file a time later than that of all files stamped before."""
        Files._stamped = max(Files._stamped + 1, int(time.time() * 1000))
        found, system = self._of(path)
        system.setTimes(found, Files._stamped, -1)

    def write(self, path: str, text: str) -> None:
        found, system = self._of(path)
        stream = system.create(found, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read(self, path: str) -> str:
        found, system = self._of(path)
        stream = system.open(found)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace(self, source: str, target: str) -> None:
        """Moves a file over another one in one step."""
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        old, new = self.path(source), self.path(target)
        uri = new.getFileSystem(self.conf).getUri()
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, self.conf).rename(old, new, how)


class Versions:
    """A folder of numbered versions, of which one small file names the current one.

    A version is written whole before it becomes the current one in a single step. ``former`` versions
    stay for readers that have begun, all by default, and older ones are deleted. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, former: int | None = None):
        self.path, self.former, self.files = path, former, Files(spark)
        self.pointer = f"{path}/_current"

    def _current_name(self) -> str | None:
        return self.files.read(self.pointer) if self.files.exists(self.pointer) else None

    def current(self) -> str | None:
        """The folder of the current version, None before the first."""
        name = self._current_name()
        return name and f"{self.path}/{name}"

    def publish(self, write: Callable[[str], None]) -> str:
        """Has ``write`` fill the folder of a new version, and makes it the current one."""
        last = self._current_name()
        number = int(last.split("-")[0]) + 1 if last else 0
        name = f"{number:09d}-{uuid.uuid4().hex}"
        write(f"{self.path}/{name}")
        self.files.write(f"{self.pointer}.{name}", name)
        self.files.replace(f"{self.pointer}.{name}", self.pointer)
        # what a writer left that did not come to its end is older than the current one, too
        older = [old for old in self.files.names(f"{self.path}/[0-9]*") if old < name]
        for old in sorted(older)[: -self.former] if self.former else older if self.former == 0 else []:
            self.files.delete(f"{self.path}/{old}")
        return f"{self.path}/{name}"
