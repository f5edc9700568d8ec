"""A commit log: numbered JSON states in one folder of the shared store.

A state is written aside and then renamed to its number; the rename never overwrites, so of two
writers that read state n only one publishes n + 1 and the other is refused. Readers take the
greatest number and see whole states only.
"""
from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """A few calls on the file system that holds ``path`` (any that Hadoop knows)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, path.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self.path("").getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str = "") -> list[str]:
        at = self.path(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Publish a whole file under a name that is not taken, or return False."""
        aside = f".{uuid.uuid4().hex}"
        out = self._fs.create(self.path(aside), False)
        out.write(bytearray(text.encode()))
        out.close()
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            context.rename(self.path(aside), self.path(name), self.spark.sparkContext._gateway.new_array(kind, 0))
            return True
        except Py4JJavaError as e:
            self.delete(aside)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


class CommitLog:
    """The numbered states in ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.files = Files(spark, path)

    def latest(self) -> tuple[int, dict]:
        """Number and content of the last published state; 0 and nothing before the first."""
        numbers = [int(m[1]) for n in self.files.names() if (m := re.fullmatch(r"(\d{12})\.json", n))]
        return (max(numbers), json.loads(self.files.read(f"{max(numbers):012d}.json"))) if numbers else (0, {})

    def publish(self, number: int, state: dict) -> bool:
        """Make ``state`` the one of ``number``; False if that is taken."""
        return self.files.create(f"{number:012d}.json", json.dumps(state))
