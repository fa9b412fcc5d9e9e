"""Incremental holiday calendar: normalise, parse, derive, deduplicate, merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    coalesce_default,
    day_name,
    flag,
    is_weekend_sun0,
    md5_key,
    null_if,
    trim_text,
    try_date_multi,
    upper_text,
)
from ..operators import (
    AcceptedValues,
    NotNull,
    Unique,
    first_per_key,
    merge,
    null_placeholder,
    rename_passthrough,
    required_key_filter,
)
from ..audit import write_checked
from ..operators.merge import ACTION
from ..tables import TableStore

# Source columns, compared columns, accepted types and the default type.
SOURCE_COLUMNS = {
    "raw_holiday_date": "DATE",
    "raw_holiday_name": "HOLIDAY_NAME",
    "raw_holiday_type": "TYPE",
    "raw_year": "YEAR",
}
OPTIONAL_COLUMNS = {"raw_observed_date": "string", "raw_local_name": "string"}
COMPARED = ("holiday_date", "observed_date", "holiday_name", "holiday_type")
HOLIDAY_TYPES = ("Religious", "Public", "Bank", "Regional")
DEFAULT_TYPE = "Public"
PROCESSED_AT = "dbt_processed_at"

CHECKS = (
    Unique("holiday_key"),
    NotNull("holiday_key"),
    NotNull("holiday_date"),
    NotNull("holiday_name"),
    AcceptedValues("holiday_type", HOLIDAY_TYPES),
)


def normalise(raw: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Canonical ``raw_*`` names; fields the source lacks become typed NULLs."""
    return null_placeholder(rename_passthrough(raw, names or SOURCE_COLUMNS), OPTIONAL_COLUMNS)


def holidays_clean(raw: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """One row per day and holiday name; an observed, then the latest observed, row wins."""
    parsed = normalise(raw, names).select(
        try_date_multi("raw_holiday_date").alias("holiday_date"),
        try_date_multi("raw_observed_date").alias("observed_date"),
        "raw_holiday_name",
        "raw_local_name",
        "raw_holiday_type",
    )
    day = F.col("holiday_date")
    dated = required_key_filter(parsed, "holiday_date").select(
        md5_key(day, "raw_holiday_name").alias("holiday_key"),
        day,
        "observed_date",
        upper_text("raw_holiday_name").alias("holiday_name"),
        null_if(trim_text("raw_local_name"), "").alias("local_name"),
        coalesce_default(null_if(trim_text("raw_holiday_type"), ""), DEFAULT_TYPE).alias("holiday_type"),
    )
    observed = F.col("observed_date")
    best = first_per_key(
        dated, ["holiday_key"], [observed.isNotNull().desc(), observed.desc_nulls_last()]
    )
    return best.select(
        "*",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        day_name(day).alias("day_name"),
        is_weekend_sun0(day).alias("is_weekend"),
        flag(observed != day).alias("is_observed"),
    )


def changed(target, source) -> Column:
    """True when one of the compared columns differs, NULLs compared as values."""
    out = F.lit(False)
    for c in COMPARED:
        out = out | ~target(c).eqNullSafe(source(c))
    return out


def merge_holidays(target: DataFrame, rows: DataFrame, **options) -> DataFrame:
    """Upsert by holiday key; only rows that differ are updated."""
    update = [c for c in target.columns if c != "holiday_key"]
    return merge(target, rows, ["holiday_key"], update, when=changed, unique_source=True, **options)


def run_model(store: TableStore, raw: DataFrame, names: dict[str, str] | None = None, name: str = "holidays") -> int:
    """Build the table on the first run, merge into it afterwards; a version that fails one of
    ``CHECKS`` is not published."""
    rows = holidays_clean(raw, names).withColumn(PROCESSED_AT, F.current_timestamp())
    return incremental(store, rows, name)


def incremental(store: TableStore, rows: DataFrame, name: str, checks: Sequence = CHECKS) -> int:
    if not store.exists(name):
        return write_checked(store, rows.withColumn(ACTION, F.lit("I")), name, checks)
    return write_checked(store, merge_holidays(store.read(name), rows), name, checks)
