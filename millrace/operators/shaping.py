"""Projections and filters shared by the clean views and loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_fields(df: DataFrame, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Strictly typed columns from record fields: ``{column: (field, type)}``."""
    return df.select(*[F.col(field).cast(kind).alias(name) for name, (field, kind) in fields.items()])


def project_json(df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns from fields of a JSON text column; a missing or unfit field is NULL."""
    record = df.select(*keep, F.try_parse_json(F.col(column)).alias("_record"))
    return record.select(
        *keep, *[F.try_variant_get("_record", f"$.{field}", kind).alias(name) for name, (field, kind) in fields.items()]
    )


def project_positions(df: DataFrame, columns: Sequence[tuple[int, str, str]]) -> DataFrame:
    """Strictly typed columns from 1-based positions: ``[(position, type, name)]``."""
    return df.select(*[F.col(df.columns[n - 1]).cast(kind).alias(name) for n, kind, name in columns])


def rename_passthrough(df: DataFrame, names: Mapping[str, Column | str]) -> DataFrame:
    """Canonical names first, then the remaining source columns unchanged."""
    taken = {n.lower() for n in names}
    first = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in names.items()]
    return df.select(*first, *[c for c in df.columns if c.lower() not in taken])


def null_placeholder(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed NULL columns for fields the source lacks; existing ones stay."""
    have = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit(None).cast(t).alias(n) for n, t in types.items() if n.lower() not in have])


def required_key_filter(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def upper_bound_filter(df: DataFrame, column: str, bound: Column) -> DataFrame:
    return df.filter(F.col(column) <= bound)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[Column | str] = ()) -> DataFrame:
    """First ``n`` rows, ordered when an order is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
