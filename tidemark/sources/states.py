"""Small states of tables and jobs: numbered JSON files, the highest number is current.

A state is metadata (months, counts, instants), read and written by the driver without a
Spark job.  A new number appears by one rename, so a reader finds the old state or the new
one, never half of it.  Only the newest states are kept, so a folder does not grow with the
number of runs.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import SparkSession

_SUFFIX = ".json"


class StateFolder:
    """The states below one folder, for one writer and any number of readers."""

    def __init__(self, spark: SparkSession, path: str, kept: int = 2) -> None:
        self.spark, self.path, self.kept = spark, path, kept

    def _place(self, name: str = ""):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def numbers(self) -> list[int]:
        files, folder = self._place()
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(n.removesuffix(_SUFFIX)) for n in names if n.endswith(_SUFFIX) and not n.startswith("."))

    def read(self, number: int) -> dict:
        files, place = self._place(f"{number:012d}{_SUFFIX}")
        stream = files.open(place)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """Number and content of the current state; (0, {}) before the first."""
        found = self.numbers()
        return (found[-1], self.read(found[-1])) if found else (0, {})

    def commit(self, number: int, state: dict) -> None:
        """Make ``state`` current under a number not used before, then forget the oldest."""
        files, draft = self._place(f".{uuid4().hex}")
        stream = files.create(draft)
        try:
            stream.write(bytearray(json.dumps(state), "utf-8"))
        finally:
            stream.close()
        _, place = self._place(f"{number:012d}{_SUFFIX}")
        if files.exists(place) or not files.rename(draft, place):
            raise FileExistsError(f"{self.path}: state {number} is there already")
        for old in self.numbers()[: -self.kept]:
            files.delete(self._place(f"{old:012d}{_SUFFIX}")[1], False)
