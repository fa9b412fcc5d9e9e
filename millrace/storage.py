"""Paths and small files through the cluster's file system, and the shared working folder."""

from __future__ import annotations

import gc
import re
import time
import uuid

from pyspark.sql import SparkSession


class FileSystem:
    """The Hadoop file system that owns ``root`` (local, HDFS or object store)."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._io = jvm.org.apache.commons.io.IOUtils

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(path)]

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        """Delete a file, or a folder with all it holds."""
        self._fs.delete(self._path(path), True)

    def age(self, path: str) -> float:
        """Seconds since a file or folder was last changed."""
        return time.time() - self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, path: str, text: str, overwrite: bool = False) -> None:
        """Write a new file; fails when it exists, which is what makes it a commit point."""
        stream = self._fs.create(self._path(path), overwrite)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished jobs now, not at the next long pause."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    A local master without that setting takes the session's warehouse folder instead.
    """
    return f"{_work_base(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def sweep_work(spark: SparkSession, older_than: float) -> list[str]:
    """Delete work folders not changed for so many seconds; returns their names.

    Choose a time no job lasts: a running job's tables lie in such folders.
    """
    base = _work_base(spark)
    fs = FileSystem(spark, base)
    old = [n for n in fs.names(base) if re.fullmatch(r".+-[0-9a-f]{12}", n) and fs.age(f"{base}/{n}") > older_than]
    for name in old:
        fs.delete(f"{base}/{name}")
    return old


def _work_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return base.rstrip("/")
