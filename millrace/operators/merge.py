"""Keyed upsert of one DataFrame into another.

The result carries ``_action``: ``I`` inserted, ``U`` updated, ``K`` kept. It is meant to be
written as a new table version; counts are then read from the written column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import BROADCAST_BYTES, fits_broadcast
from .keys import assign_keys, max_key

ACTION = "_action"
_S = "_s_"


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    update: Sequence[str],
    insert: Sequence[str] | None = None,
    when: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    null_keys: str = "insert",
    surrogate: str | None = None,
    unique_source: bool = False,
    small_source: bool | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Upsert ``source`` into ``target``; columns share their names.

    on
        key columns; a NULL key matches nothing.
    update
        columns replaced on a match (of those, only when ``when(target, source)`` holds).
    insert
        columns filled on insert (default: all the source has); the rest become NULL.
    null_keys
        ``insert`` adds source rows with a NULL key on every run; ``drop`` leaves them out.
    surrogate
        column numbered on from its highest value for inserted rows.
    unique_source
        the source was just deduplicated on the key: one full outer join then does the work.
    small_source
        whether the source may be broadcast, when the caller has measured it already.

    Two source rows for one target row fail the job. A small source is broadcast, so the target
    is not shuffled. A large one meets the target in a left join that takes at most two copies of
    a key (enough to find the error, and pruned before the shuffle), and in an anti join whose
    hot keys adaptive execution can split.
    """
    if null_keys not in ("insert", "drop"):
        raise ValueError(f"null_keys must be insert or drop: {null_keys}")
    insert = list(insert or source.columns)
    has_key = reduce(and_, [F.col(k).isNotNull() for k in on])
    keyed = source.filter(has_key)
    ranked = keyed.withColumn("_copy", F.row_number().over(Window.partitionBy(*on).orderBy(*on)))
    small = fits_broadcast(keyed, max_broadcast_bytes) if small_source is None else small_source
    one_join = unique_source and not small and surrogate is None
    if not one_join:
        ranked = ranked.filter(F.col("_copy") <= 2)
    renamed = ranked.select(*[F.col(c).alias(_S + c) for c in source.columns], F.col("_copy").alias(_S + "_copy"))
    condition = reduce(and_, [F.col(k) == F.col(_S + k) for k in on])

    if small:
        old = _apply(target, target.join(F.broadcast(renamed), condition, "left"), update, when)
        seen = target.select(*on).join(F.broadcast(keyed.select(*on)), list(on), "left_semi").distinct()
        new = keyed.join(F.broadcast(seen), list(on), "left_anti")
    elif not one_join:
        old = _apply(target, target.join(renamed, condition, "left"), update, when)
        new = keyed.join(target.select(*on), list(on), "left_anti")
    else:
        flagged = target.withColumn("_t", F.lit(True))
        both = flagged.join(renamed, condition, "full")
        merged = _apply(target, both, update, when, insert)
        return _with_null_keys(merged, target, source, has_key, insert, null_keys)

    if surrogate:
        extra = source.filter(~has_key) if null_keys == "insert" else None
        added = new.select(*insert) if extra is None else new.select(*insert).unionByName(extra.select(*insert))
        # All columns decide the order, so rows with a NULL key do not share one digest.
        order = [*on, *[c for c in insert if c not in on]]
        added = assign_keys(added, surrogate, order, max_key(target, surrogate), dict(target.dtypes)[surrogate])
        return old.unionByName(_inserted(target, added))
    merged = old.unionByName(_inserted(target, new.select(*insert)))
    return _with_null_keys(merged, target, source, has_key, insert, null_keys)


def _apply(target, joined, update, when, insert=None) -> DataFrame:
    """Rows of a target-source join as target rows with their action."""
    matched = F.col(_S + "_copy").isNotNull()
    if insert is not None:
        fresh = F.col("_t").isNull()
        matched = matched & ~fresh
    else:
        fresh = F.lit(False)
    changes = when(lambda c: F.col(c), lambda c: F.col(_S + c)) if when else F.lit(True)
    action = (
        F.when(fresh, F.lit("I"))
        .when(matched & (F.col(_S + "_copy") > 1), F.raise_error(F.lit("merge: several source rows match one target row")))
        .when(matched & changes, F.lit("U"))
        .otherwise(F.lit("K"))
        .cast("string")
    )
    acted = joined.withColumn(ACTION, action)
    columns = []
    for field in target.schema.fields:
        value = F.col(field.name)
        if field.name in update:
            value = F.when(F.col(ACTION) == "U", F.col(_S + field.name)).otherwise(value)
        if insert is not None:
            new = F.col(_S + field.name) if field.name in insert else F.lit(None)
            value = F.when(F.col(ACTION) == "I", new).otherwise(value)
        columns.append(value.cast(field.dataType).alias(field.name))
    return acted.select(*columns, ACTION)


def _inserted(target: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ],
        F.lit("I").alias(ACTION),
    )


def _with_null_keys(merged, target, source, has_key, insert, null_keys) -> DataFrame:
    if null_keys == "drop":
        return merged
    return merged.unionByName(_inserted(target, source.filter(~has_key).select(*insert)))


def merge_counts(merged: DataFrame) -> DataFrame:
    """One row: rows inserted, updated and deleted by a merge (a merge deletes none)."""
    return merged.agg(
        F.count_if(F.col(ACTION) == "I").alias("rows_inserted"),
        F.count_if(F.col(ACTION) == "U").alias("rows_updated"),
        F.count_if(F.col(ACTION) == "D").alias("rows_deleted"),
    )
