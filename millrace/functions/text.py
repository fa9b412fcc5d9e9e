"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnOrName, as_col

# Characters after which a letter is capitalised (regular-expression class body;
# whitespace plus punctuation).
TITLE_DELIMITERS = r"""\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""


def trim_text(c: ColumnOrName) -> Column:
    return F.trim(as_col(c))


def upper_text(c: ColumnOrName) -> Column:
    return F.upper(F.trim(as_col(c)))


def title_case(c: ColumnOrName) -> Column:
    """Trimmed text with the first letter of every word upper case, the rest lower case.

    Spark's ``initcap`` starts a word after a space only; here any delimiter starts one, so
    "nyali-beach" becomes "Nyali-Beach".
    """
    runs = F.regexp_extract_all(
        F.lower(F.trim(as_col(c))),
        F.lit(f"([^{TITLE_DELIMITERS}]+|[{TITLE_DELIMITERS}]+)"),
        F.lit(1),
    )
    return F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), run.substr(F.lit(2), F.length(run)))),
        "",
    )


def null_if(c: ColumnOrName, token: str) -> Column:
    return F.nullif(as_col(c), F.lit(token))


def coalesce_default(c: ColumnOrName, default) -> Column:
    """First non-NULL of a column and a literal, column or expression."""
    return F.coalesce(as_col(c), default if isinstance(default, Column) else F.lit(default))


def flag(condition: Column) -> Column:
    """Condition as a two-valued boolean: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))
