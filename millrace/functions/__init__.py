"""Scalar expressions: every helper takes and returns a Column; no Python UDFs."""

from .dates import (
    date_add_days,
    day_name,
    day_part,
    hours_ago,
    is_weekend_iso,
    is_weekend_sun0,
    month_part,
    quarter_part,
    try_date_multi,
    year_part,
)
from .keys import md5_key
from .numbers import cast_decimal, cast_int, try_decimal, try_number
from .text import coalesce_default, flag, null_if, title_case, trim_text, upper_text
from .times import cast_timestamp_ntz, try_timestamp_ntz

__all__ = [
    "cast_decimal",
    "cast_int",
    "cast_timestamp_ntz",
    "coalesce_default",
    "date_add_days",
    "day_name",
    "day_part",
    "flag",
    "hours_ago",
    "is_weekend_iso",
    "is_weekend_sun0",
    "md5_key",
    "month_part",
    "null_if",
    "quarter_part",
    "title_case",
    "trim_text",
    "try_date_multi",
    "try_decimal",
    "try_number",
    "try_timestamp_ntz",
    "upper_text",
    "year_part",
]
