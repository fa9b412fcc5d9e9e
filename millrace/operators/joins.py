"""Dimension lookups that stay safe when a key is hot or the dimension is large."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_KEYS = 1024
SALTS = 64
_ROW_OVERHEAD = 16


def _row_bytes(df: DataFrame):
    """Size of one row as a Column: fixed widths plus the actual length of variable-width values."""
    sizes = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(col), F.lit(0)) + F.lit(8))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            sizes.append(F.coalesce(F.length(F.to_json(F.struct(col))), F.lit(0)) + F.lit(8))
        else:
            sizes.append(F.lit(16))
    return reduce(add, sizes, F.lit(_ROW_OVERHEAD)).cast("long")


def table_bytes(df: DataFrame):
    """Size of a whole DataFrame as an aggregate, as ``fits_broadcast`` measures it; None for nested columns,
    whose size is dear to take."""
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in df.schema.fields):
        return None
    return F.sum(_row_bytes(df))


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when the measured size of ``df`` (one distributed sum) is within the limit."""
    measured = df.agg(F.sum(_row_bytes(df)).alias("n")).first()["n"]
    return (measured or 0) <= max_bytes


def lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    take: Sequence[str],
    how: str = "left",
    max_broadcast_bytes: int = BROADCAST_BYTES,
    bound: DataFrame | None = None,
    right_bytes: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add the ``take`` columns of ``right`` to ``left`` where the keys are equal.

    ``how`` is ``left`` (no match gives NULLs) or ``inner``. A right side whose measured size is
    within the limit is broadcast, so ``left`` is not shuffled. Beyond it, one join on the key and
    a salt: left rows of the most frequent keys and of the NULL key are spread by their salt, and
    the right rows of those keys are repeated for each salt. Every row is kept on either way, and
    ``left`` stands in the plan once.

    ``bound`` is a DataFrame that ``right`` is a part of and that is cheaper to measure, such as
    the rows it was deduplicated from; when it fits, ``right`` fits. ``right_bytes`` is a bound of
    its size that the caller knows, as stored tables do: nothing is measured then. ``counted`` is a
    DataFrame with about the keys of ``left`` that is cheaper to count, such as the stored rows that
    ``left`` is made from: which of its keys are frequent decides the spread, not the result.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    side = right.filter(F.col(right_key).isNotNull()).select(
        F.col(right_key).alias("_key"), *[F.col(c) for c in take]
    )
    out = [F.col(f"`{c}`") for c in left.columns] + [F.col(f"`{c}`") for c in take]
    if right_bytes is not None:
        small = right_bytes <= max_broadcast_bytes
    else:
        small = bound is not None and fits_broadcast(bound, max_broadcast_bytes)
        small = small or fits_broadcast(side, max_broadcast_bytes)
    if small:
        return left.join(F.broadcast(side), left[left_key] == side["_key"], how).select(*out)
    return _salted_lookup(left, side, left_key, how, left if counted is None else counted).select(*out)


def _salted_lookup(left: DataFrame, side: DataFrame, left_key: str, how: str, counted: DataFrame) -> DataFrame:
    # The most frequent keys, at most HOT_KEYS values: one counting pass, which combines per task.
    frequent = (
        counted.filter(F.col(left_key).isNotNull())
        .groupBy(F.col(left_key).alias("_hot"))
        .count()
        .orderBy(F.col("count").desc(), "_hot")
        .limit(HOT_KEYS)
        .select("_hot")
    )
    hot = F.broadcast(left.sparkSession.createDataFrame(frequent.collect(), frequent.schema))
    row_salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")
    spread = left.join(hot, left[left_key] == F.col("_hot"), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull() | F.col(left_key).isNull(), row_salt).otherwise(F.lit(0))
    )
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    repeated = side.join(hot, F.col("_key") == F.col("_hot"), "left").withColumn(
        "_side_salt", F.explode(F.when(F.col("_hot").isNotNull(), every).otherwise(F.array(F.lit(0))))
    ).drop("_hot")
    return spread.drop("_hot").join(repeated.hint("merge"), (spread[left_key] == F.col("_key")) & (F.col("_salt") == F.col("_side_salt")), how)
