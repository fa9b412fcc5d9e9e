"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 3  # 16**3 buckets of the digest space
COPIES_PER_TASK_ROW = 100_000
_SEPARATOR = "\x1f"


def max_key(table: DataFrame, key: str) -> Column:
    """Highest key in use, 0 for an empty table, as a scalar sub-query."""
    return table.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("m")).scalar()


def assign_keys(
    rows: DataFrame,
    key: str,
    order_by: Sequence[str] | None = None,
    start: Column | int = 0,
    key_type: str = "bigint",
) -> DataFrame:
    """Number rows ``start + 1 ..`` without gaps, in the order of a digest of ``order_by``.

    Rows are ordered by ``(md5(values), values)``, remaining columns breaking ties; the default
    is every column. Values that many different rows share belong in no short ``order_by``, as
    equal digests share a bucket. Leading digest digits split them into even
    buckets: each bucket is numbered on its own, and the bucket sizes (a table of fixed length)
    give every bucket its offset. Equal rows are counted first, so a row with very many copies is
    one row in its bucket, and its copies are made again in parallel chunks.
    """
    columns = rows.columns
    hashed = list(order_by or columns)
    order = hashed + [c for c in columns if c not in hashed]
    digest = F.md5(F.concat_ws(_SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in hashed]))
    counted = (
        rows.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_digest", digest)
        .withColumn("_bucket", F.left("_digest", F.lit(BUCKET_DIGITS)))
    )
    sizes = counted.groupBy("_bucket").agg(F.sum("_copies").alias("_size"))
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select("_bucket", (F.sum("_size").over(upto) - F.col("_size")).alias("_offset"))
    inside = (
        Window.partitionBy("_bucket")
        .orderBy("_digest", *[F.col(c).asc_nulls_first() for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    first = (
        counted.withColumn("_before", F.sum("_copies").over(inside) - F.col("_copies"))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("_from", F.col("_offset") + F.col("_before") + F.lit(1))
    )
    chunks = first.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(COPIES_PER_TASK_ROW).cast("long")))
    ).repartition("_digest", "_chunk")
    last = F.least(F.col("_chunk") + F.lit(COPIES_PER_TASK_ROW), F.col("_copies"))
    numbered = chunks.withColumn(
        "_number", F.explode(F.sequence(F.col("_from") + F.col("_chunk"), F.col("_from") + last - 1))
    )
    base = start if isinstance(start, Column) else F.lit(start).cast("long")
    return numbered.select((base + F.col("_number")).cast(key_type).alias(key), *columns)
