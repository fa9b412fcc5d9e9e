"""Tolerant and strict number casts.

Casts go through ``decimal(38,0)``: it rounds half away from zero ("12.5" -> 13), which a direct
cast of text to an integer type does not do.
"""

from __future__ import annotations

from pyspark.sql import Column

from ._cols import ColumnOrName, as_col


def try_number(c: ColumnOrName) -> Column:
    """Whole number of up to 38 digits; NULL when the text is not a number."""
    return as_col(c).try_cast("decimal(38,0)")


def try_decimal(c: ColumnOrName, precision: int = 12, scale: int = 2) -> Column:
    """Fixed-point number; NULL when the text is not a number or overflows."""
    return as_col(c).try_cast(f"decimal({precision},{scale})")


def cast_int(c: ColumnOrName, type_name: str = "int") -> Column:
    """Strict rounding cast: a bad value fails the query."""
    return as_col(c).cast("decimal(38,0)").cast(type_name)


def cast_decimal(c: ColumnOrName, precision: int = 12, scale: int = 2) -> Column:
    """Strict fixed-point cast: a bad value fails the query."""
    return as_col(c).cast(f"decimal({precision},{scale})")
