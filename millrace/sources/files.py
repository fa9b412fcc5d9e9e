"""Readers for staged files: every CSV and JSON field arrives as text, with its file's path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that mean NULL in a CSV file.
NULL_TOKENS = (r"\N", "NULL", "")

FILE = "_file"
MALFORMED = "_malformed"


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _csv_options(header: bool, multi_line: bool) -> dict[str, str]:
    return {
        "sep": ",",
        "header": str(header).lower(),
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
        "mode": "PERMISSIVE",
        "multiLine": str(multi_line).lower(),
        "recursiveFileLookup": "true",
    }


def _json_options(multi_line: bool) -> dict[str, str]:
    return {
        "mode": "PERMISSIVE",
        "multiLine": str(multi_line).lower(),
        "primitivesAsString": "true",
        "columnNameOfCorruptRecord": MALFORMED,
        "recursiveFileLookup": "true",
    }


def _json_columns(raw: DataFrame, fields: Sequence[str], pattern: str | None, malformed: bool) -> DataFrame:
    # Spark refuses a JSON scan of nothing but the malformed text, which a plan that needs no
    # field would ask for; the empty prefix of a field keeps one in the scan.
    text = F.nullif(F.greatest(F.col(MALFORMED), F.left(F.col(fields[0]), F.lit(0))), F.lit(""))
    df = _with_file(raw, pattern)
    if malformed:
        return df.select(*fields, text.alias(MALFORMED), FILE)
    return df.filter(text.isNull()).select(*fields, FILE)


def _with_file(df: DataFrame, pattern: str | None) -> DataFrame:
    df = df.select("*", F.col("_metadata.file_path").alias(FILE))
    # The pattern has to match the whole path.
    return df if pattern is None else df.filter(F.col(FILE).rlike(f"^(?:{pattern})$"))


def _clean_tokens(df: DataFrame, columns: Sequence[str], null_tokens: Sequence[str]) -> DataFrame:
    tidy = [
        F.when(~F.trim(F.col(c)).isin(*null_tokens), F.trim(F.col(c))).alias(c) for c in columns
    ]
    return df.select(*tidy, FILE)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    null_tokens: Sequence[str] = NULL_TOKENS,
    header: bool = True,
    pattern: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Positional text columns of comma-separated files.

    Short rows are padded with NULL, surplus fields dropped, fields trimmed, and the
    ``null_tokens`` read as NULL. Files split into many tasks unless ``multi_line`` allows line
    breaks inside quotes.
    """
    raw = spark.read.schema(_text_schema(columns)).options(**_csv_options(header, multi_line)).csv(path)
    return _clean_tokens(_with_file(raw, pattern), columns, null_tokens)


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[str],
    pattern: str | None = None,
    multi_line: bool = True,
    malformed: bool = False,
) -> DataFrame:
    """Text columns from JSON records, one row per element of a file's outer array.

    Fields a record lacks are NULL, further ones are ignored. Text that is no JSON is left out;
    with ``malformed`` it comes as a row of its own in the ``_malformed`` column.
    ``multi_line=False`` reads files with a record (or an array) per line; only those split into
    several tasks.
    """
    raw = spark.read.schema(_text_schema([*fields, MALFORMED])).options(**_json_options(multi_line)).json(path)
    return _json_columns(raw, fields, pattern, malformed)


def read_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet files; only the named columns are scanned."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def stream_csv(spark: SparkSession, path: str, columns: Sequence[str], null_tokens=NULL_TOKENS, pattern=None, **options) -> DataFrame:
    """:func:`read_csv` over files as they arrive."""
    settings = {**_csv_options(True, False), **options}
    raw = spark.readStream.schema(_text_schema(columns)).options(**settings).csv(path)
    return _clean_tokens(_with_file(raw, pattern), columns, null_tokens)


def stream_json(spark: SparkSession, path: str, fields: Sequence[str], pattern=None, multi_line: bool = True, **options) -> DataFrame:
    """:func:`read_json` over files as they arrive, with the ``_malformed`` column."""
    settings = {**_json_options(multi_line), **options}
    raw = spark.readStream.schema(_text_schema([*fields, MALFORMED])).options(**settings).json(path)
    return _json_columns(raw, fields, pattern, True)


def list_stage(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``(path, size, modified, file)`` of the files below a folder; no content is read.

    ``file`` is the path in the spelling that loads record.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.select(
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
        F.col("_metadata.file_path").alias("file"),
    )
    return files if pattern is None else files.filter(F.col("path").rlike(f"^(?:{pattern})$"))
