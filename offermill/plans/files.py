"""Folder listings through the cluster's file system API."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folders:
    """The few file system calls that publication needs."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def create(self, path: str) -> bool:
        """Create an empty file; false if there is one already. Of several callers at once one gets true."""
        try:
            self._fs.create(self._path(path), False).close()
        except Py4JJavaError as refused:
            if self.exists(path):
                return False
            raise refused
        return True

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
