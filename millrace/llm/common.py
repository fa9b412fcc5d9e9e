"""What the operators of this package share: stage tables, words, and shipping of task code."""

from __future__ import annotations

import ctypes
import gc
import importlib
import time

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import FileSystem, work_folder

# Task code travels with its job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(importlib.import_module(__package__))

#: White space between words: these six characters and no others.
WHITE = " \t\n\x0b\x0c\r"
#: A word, for Spark, DuckDB and Python alike. ``bytes.split()`` finds the same words.
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: ``bytes.split`` parts at exactly the six characters of WHITE."""
    return text.split() if text else []


def shared_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a stage's rows into the cluster's shared folder and read them back.

    Cuts the lineage: a lost executor costs at most the stage that was running.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    release(spark)
    return out


def release(spark: SparkSession, pause: float = 0.0) -> None:
    """Let Spark's cleaner drop shuffle files of finished stages now, not at the next long pause.

    Listeners may hold a query for a moment after its end; a second collection after ``pause``
    seconds finds what the first one could not. It is worth the wait after a large shuffle.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    if pause:
        time.sleep(pause)
        spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return the memory a task has freed to the machine: its Python worker stays for the next task,
    and for a minute after the last one, beside whatever else the executor does then."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU C library has it
    if trim:
        trim(0)


def drop_table(table: DataFrame) -> None:
    """Delete the files of a stage table that nothing reads any more."""
    spark = table.sparkSession
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        FileSystem(spark, folder).delete(folder)


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` set to the length of the text, where the table has that column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))
