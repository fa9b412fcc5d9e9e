"""Change capture between two versions of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ, with ``_change`` insert, update or delete.

    Inserts and updates carry the new values, deletes the old ones. Keys are unique and compared
    null-safe.
    """
    values = [c for c in new.columns if c not in keys]
    left = old.select(*[F.col(c).alias("_o_" + c) for c in old.columns], F.lit(True).alias("_old"))
    right = new.withColumn("_new", F.lit(True))
    both = left.join(right, reduce(and_, [F.col("_o_" + k).eqNullSafe(F.col(k)) for k in keys]), "full")
    differs = reduce(or_, [~F.col("_o_" + c).eqNullSafe(F.col(c)) for c in values], F.lit(False))
    change = (
        F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").when(differs, "update")
    )
    gone = F.col("_change") == "delete"
    return (
        both.withColumn("_change", change)
        .filter(F.col("_change").isNotNull())
        .select(*[F.when(gone, F.col("_o_" + c)).otherwise(F.col(c)).alias(c) for c in new.columns], "_change")
    )


def has_changes(delta: DataFrame) -> bool:
    """Gate for a run: true when there is at least one changed row."""
    return not delta.isEmpty()
