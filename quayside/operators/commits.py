"""Numbered commits in a folder: each is a file that is put in place only if no one else has, so of two writers that start
from one base the first wins and the other sees that it has not."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Others have committed first, again and again."""


class Commits:
    """The log under ``path``. Files are renamed into place without overwriting, which HDFS does atomically; a store
    in which renaming is no atomic step needs one writer at a time."""

    RETRIES = 20

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._at = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self._at("").getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), conf)

    def names(self) -> list[str]:
        """The names of what is committed, in no order."""
        if not self.files.exists(self._at("")):
            return []
        found = (f.getPath().getName() for f in self.files.listStatus(self._at("")))
        return [n.removesuffix(".json") for n in found if n.endswith(".json")]

    def read(self, name: str) -> dict:
        stream = self.files.open(self._at(f"{name}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def has(self, name: str) -> bool:
        return self.files.exists(self._at(f"{name}.json"))

    def create(self, name: str, body: dict) -> bool:
        """Whether this commit was first of its name."""
        if self.has(name):
            return False
        draft = self._at(f"{uuid.uuid4().hex}.new")
        stream = self.files.create(draft, True)
        stream.write(bytearray(json.dumps(body).encode()))
        stream.close()
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._context.rename(draft, self._at(f"{name}.json"), none)
        except Exception:
            self.files.delete(draft, False)
            if self.has(name):
                return False
            raise
        return True

    def latest(self) -> tuple[int, dict]:
        """(number, body) of the last numbered commit, (0, {}) before any."""
        numbers = [int(n) for n in self.names() if n.isdigit()]
        return (n, self.read(f"{n:012}")) if (n := max(numbers, default=0)) else (0, {})

    def advance(self, step) -> dict:
        """Commit ``step(number, body)`` of the latest commit as the next one; if others were first, anew from theirs."""
        for _ in range(self.RETRIES):
            number, body = self.latest()
            made = step(number, body)
            if self.create(f"{number + 1:012}", made):
                return made
        raise Conflict(f"{self.path}: others committed first {self.RETRIES} times")

    def remove(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
