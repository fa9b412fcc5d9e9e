"""Dates: parsing, parts and arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnOrName, as_col

# The date spellings tried after the default one, in order.
DATE_FORMATS = ("MM/dd/yyyy", "yyyy-MM-dd")


def try_date_multi(c: ColumnOrName, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First spelling that parses, NULL when none does."""
    text = as_col(c).cast("string")
    return F.coalesce(text.try_cast("date"), *[F.try_to_date(text, fmt) for fmt in formats])


def day_part(c: ColumnOrName) -> Column:
    return F.day(as_col(c)).cast("byte")


def month_part(c: ColumnOrName) -> Column:
    return F.month(as_col(c)).cast("byte")


def year_part(c: ColumnOrName) -> Column:
    return F.year(as_col(c)).cast("short")


def quarter_part(c: ColumnOrName) -> Column:
    return F.quarter(as_col(c)).cast("byte")


def day_name(c: ColumnOrName) -> Column:
    """Three-letter English weekday name."""
    return F.dayname(as_col(c))


def is_weekend_iso(c: ColumnOrName) -> Column:
    """Saturday or Sunday, days counted from Monday; NULL stays NULL."""
    return F.weekday(as_col(c)) >= 5


def is_weekend_sun0(c: ColumnOrName) -> Column:
    """Saturday or Sunday, days counted from Sunday; NULL is false."""
    return F.coalesce(F.dayofweek(as_col(c)).isin(1, 7), F.lit(False))


def date_add_days(c: ColumnOrName, days) -> Column:
    return F.date_add(as_col(c), days)


def hours_ago(hours: int) -> Column:
    """The moment ``hours`` before the query starts."""
    return F.current_timestamp() - F.make_dt_interval(hours=F.lit(hours))
