"""Writes raw inputs as staged files, so that loads have something to read. Runs on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_FILE = 500

# Line breaks and separators that no value contains: a whole line is written as one CSV field.
_LINE_SEP = "\x01"


def stage_csv(df: DataFrame, path: str, mode: str = "append", by: str | None = None, compression: str | None = None) -> str:
    """Comma-separated files with a header; ``by`` puts each of its values into one file."""
    out = df if by is None else df.repartition(by)
    writer = out.write.mode(mode).options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer = writer if compression is None else writer.option("compression", compression)
    (writer if by is None else writer.partitionBy(by)).csv(path)
    return path


def stage_lines(df: DataFrame, line, path: str) -> str:
    """Files of ready-made lines below a header line."""
    df.select(line.alias("line")).write.mode("append").options(header=True, sep=_LINE_SEP, quote="").csv(path)
    return path


def stage_json_lines(df: DataFrame, path: str, compression: str | None = None) -> str:
    """``.json`` or ``.json.gz`` files with a record per line."""
    writer = df.write.mode("append")
    (writer.option("compression", compression) if compression else writer).json(path)
    return path


def stage_json_arrays(df: DataFrame, path: str) -> str:
    """Files that hold one JSON array of about ``ROWS_PER_FILE`` records each."""
    files = df.count() // ROWS_PER_FILE + 1
    record = F.to_json(F.struct(*df.columns))
    arrays = (
        df.groupBy(F.pmod(F.xxhash64(*df.columns), F.lit(files)).alias("file"))
        .agg(F.collect_list(record).alias("records"))
        .select(F.concat(F.lit("[\n"), F.array_join("records", ",\n"), F.lit("\n]")).alias("value"))
    )
    arrays.write.mode("append").option("maxRecordsPerFile", 1).text(path)
    return path
