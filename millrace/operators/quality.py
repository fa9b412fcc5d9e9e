"""Data-quality checks: each returns its failures as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; NULLs are ignored."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is not in the list; NULL passes."""
    return df.filter(~F.col(column).isin(*values))


def check_max_length(df: DataFrame, column: str, length: int) -> DataFrame:
    return df.filter(F.length(column) > length)


@dataclass(frozen=True)
class Unique:
    column: str
    name: str = "unique"


@dataclass(frozen=True)
class NotNull:
    column: str
    name: str = "not_null"

    def failing(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:
    column: str
    values: tuple[str, ...]
    name: str = "accepted_values"

    def failing(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class MaxLength:
    column: str
    length: int
    name: str = "max_length"

    def failing(self) -> Column:
        return F.length(self.column) > self.length


def run_checks(df: DataFrame, checks: Sequence[Unique | NotNull | AcceptedValues | MaxLength]) -> DataFrame:
    """``(test, column, failures)`` per check.

    All row-local checks share one pass; each uniqueness check is one grouped pass that counts
    per key before it shuffles.
    """
    parts = []
    local = [c for c in checks if not isinstance(c, Unique)]
    if local:
        counts = df.agg(*[F.count_if(c.failing()).alias(f"_{i}") for i, c in enumerate(local)])
        rows = F.array(
            *[
                F.struct(F.lit(c.name).alias("test"), F.lit(c.column).alias("column"), F.col(f"_{i}").alias("failures"))
                for i, c in enumerate(local)
            ]
        )
        parts.append(counts.select(F.inline(rows)))
    for c in checks:
        if isinstance(c, Unique):
            parts.append(
                check_unique(df, c.column)
                .agg(F.count(F.lit(1)).alias("failures"))
                .select(F.lit(c.name).alias("test"), F.lit(c.column).alias("column"), "failures")
            )
    return reduce(DataFrame.unionByName, parts)
