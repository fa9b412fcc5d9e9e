"""Accept a column name or a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c
