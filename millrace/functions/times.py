"""Timestamps without time zone."""

from __future__ import annotations

from pyspark.sql import Column

from ._cols import ColumnOrName, as_col


def cast_timestamp_ntz(c: ColumnOrName) -> Column:
    """Strict: a value that is not a timestamp fails the query."""
    return as_col(c).cast("timestamp_ntz")


def try_timestamp_ntz(c: ColumnOrName) -> Column:
    """Tolerant: a value that is not a timestamp gives NULL."""
    return as_col(c).try_cast("timestamp_ntz")
