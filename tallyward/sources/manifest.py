"""A chain of numbered manifests: the small state that a table, a log or a job agrees on.

``<folder>/<number>.json`` holds a whole state; the highest number is current. A state is
replaced by creating the next number *if it is absent*, so of two writers one succeeds and
the other reads what it wrote and decides again. A manifest is complete as soon as its name
exists: it is written beside and then linked (local) or renamed (any file system whose rename does
not replace a file, as HDFS's).
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

#: Manifests that stay for readers that listed them before the last ones came.
KEPT = 20


class FileSystem:
    """The cluster's file system (Hadoop ``FileSystem`` of a path), for metadata
    operations only: listing, looking up, removing and small text files. No data is read."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    @property
    def scheme(self) -> str:
        return self._fs.getScheme()

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self._path(path)))

    def _names(self, path: str, folders: bool) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(st.getPath().getName() for st in self._fs.listStatus(self._path(path)) if st.isDirectory() == folders)

    def folders(self, path: str) -> list[str]:
        """Names of the folders in a folder, in order; none if it is missing."""
        return self._names(path, True)

    def files(self, path: str) -> list[str]:
        """Names of the files in a folder, in order; none if it is missing."""
        return self._names(path, False)

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def scratch(self, path: str) -> None:
        """Make a folder that goes when the JVM ends (one that exists stays registered)."""
        if not self.exists(path):
            self._fs.mkdirs(self._path(path))
            self._fs.deleteOnExit(self._path(path))

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """A new file with all of ``text``; False, and nothing done, if the name exists."""
        target = self._path(path)
        beside = self._path(f"{target.getParent()}/.{target.getName()}.{uuid.uuid4().hex}")
        stream = self._fs.create(beside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            if self.scheme == "file":  # a local rename would replace the file
                os.link(beside.toUri().getPath(), target.toUri().getPath())
                return True
            return not self._fs.exists(target) and bool(self._fs.rename(beside, target))
        except FileExistsError:
            return False
        finally:
            self._fs.delete(beside, False)


class Chain:
    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self.fs = FileSystem(spark, self.folder)

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.fs.files(self.folder) if n.endswith(".json") and n[0] != ".")

    def latest(self) -> tuple[int, dict]:
        """Number and state of the current manifest; (0, {}) if there is none."""
        numbers = self._numbers()
        if not numbers:
            return 0, {}
        return numbers[-1], json.loads(self.fs.read_text(f"{self.folder}/{numbers[-1]:012d}.json"))

    def commit(self, number: int, state: dict) -> bool:
        """Make ``state`` manifest ``number``; False if another writer was first."""
        if not self.fs.create(f"{self.folder}/{number:012d}.json", json.dumps(state)):
            return False
        for old in self._numbers():
            if old <= number - KEPT:
                self.fs.remove(f"{self.folder}/{old:012d}.json")
        return True

    def update(self, change: Callable[[dict], dict], first: Callable[[], dict] = dict) -> dict:
        """Replace the state by ``change`` of it, however many writers there are; ``first`` gives
        the state before any manifest. Returns the new state."""
        while True:
            number, state = self.latest()
            new = change(state if number else first())
            if number and new == state:
                return state
            if self.commit(number + 1, new):
                return new
