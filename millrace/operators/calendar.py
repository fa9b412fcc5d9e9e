"""Calendar rows between two dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_bounds(df: DataFrame, moment: str) -> DataFrame:
    """One row with the first and last day of a timestamp column."""
    return df.agg(F.min(moment).cast("date").alias("min_d"), F.max(moment).cast("date").alias("max_d"))


def date_series(bounds: DataFrame, name: str = "date") -> DataFrame:
    """One row per day of each row of bounds, with its other columns; none for NULL bounds.

    A series is as long as its bounds say: the date type has fewer than four million days.
    """
    first, last = F.col("min_d"), F.col("max_d")
    others = [F.col(f"`{c}`") for c in bounds.columns if c not in ("min_d", "max_d")]
    return bounds.filter(first <= last).select(*others, F.explode(F.sequence(first, last)).alias(name))
