"""Versions of a folder of tables: written beside the old ones, then committed by one small file."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Commits:
    """Numbered commit records below ``path/_commits``, each naming a folder below ``path``.

    A record appears by renaming a finished file, so a reader sees it whole or not at all,
    and a number is given once.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.place = self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/_commits")
        self.files = self.place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def numbers(self) -> list[int]:
        if not self.files.exists(self.place):
            return []
        names = [found.getPath().getName() for found in self.files.listStatus(self.place)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0] != ".")

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.place, name)

    def read(self, number: int) -> dict:
        stream = self.files.open(self._path(f"{number:012d}.json"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def last(self) -> dict | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def add(self, record: dict) -> int:
        """Commit a record under the next number."""
        number = (self.numbers() or [-1])[-1] + 1
        hidden = self._path(f".{uuid.uuid4().hex}")
        stream = self.files.create(hidden)
        try:
            stream.write(bytearray(json.dumps(record).encode()))
        finally:
            stream.close()
        if not self.files.rename(hidden, self._path(f"{number:012d}.json")):
            raise OSError(f"commit {number} of {self.path} is taken")
        return number

    def forget(self, keep: int) -> None:
        """Remove all but the last ``keep`` versions, the record first."""
        for number in self.numbers()[:-keep]:
            folder = self.read(number)["folder"]
            self.files.delete(self._path(f"{number:012d}.json"), False)
            self.files.delete(self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}"), True)
