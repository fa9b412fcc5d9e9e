"""Deterministic text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnOrName, as_col


def md5_key(day: ColumnOrName, name: ColumnOrName) -> Column:
    """Digest of a date and a normalised name, missing parts as empty text."""
    return F.md5(
        F.concat(
            F.coalesce(as_col(day).cast("string"), F.lit("")),
            F.lit("||"),
            F.coalesce(F.upper(F.trim(as_col(name))), F.lit("")),
        )
    )
