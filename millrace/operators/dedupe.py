"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    order_by: Sequence[Column],
    tie_break: Sequence[Column] | None = None,
) -> DataFrame:
    """Keep the first row of every key; NULL keys form one group.

    Ties after ``order_by`` are settled by ``tie_break`` (default: every other column, ascending,
    NULLs last), so the result does not depend on input order. The ``= 1`` filter lets Spark keep only
    the best row per key and map task before the shuffle, so a key holding a large share of the
    input reaches its reducer as one row per task.
    """
    if tie_break is None:
        named = [k for k in keys if isinstance(k, str)]
        tie_break = [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in named]
    ranked = Window.partitionBy(*keys).orderBy(*order_by, *tie_break)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") == 1).drop("_rank")
