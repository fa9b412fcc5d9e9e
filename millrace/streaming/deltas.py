"""Merge only what changed since the last merge."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import has_changes
from ..plans import clean, star
from ..sources.loads import LandingZone
from ..sources.specs import LoadSpec
from ..tables import TableStore, log_step
from .ingest import auto_ingest


#: Raw tables, or a function that gives them as they are now.
Raw = Mapping[str, DataFrame] | Callable[[], Mapping[str, DataFrame]]


def merge_sales_delta(
    store: TableStore, zone: LandingZone, spec: LoadSpec, products: DataFrame, members: Raw | None = None
) -> bool:
    """Merge raw sales loaded since the fact's bookmark; true when there were any.

    The bookmark is part of the fact's version, so rows and bookmark move together and a repeated
    call finds nothing to do. New days extend the calendar first, as the fact keeps only sales on
    a known day. ``members`` are raw tables of the other dimensions (cities, branches, products,
    employees, staff), which are then merged before the sales; sales of earlier merges that named
    a member which has come since get its key. Without new sales, members wait for the next call.
    """
    bookmark = store.bookmark("fact_sales") or 0
    upto = zone.last_load(spec.table)
    delta = zone.changes_since(spec, bookmark).filter(F.col("load_id") <= upto).drop("load_id")
    if upto == bookmark or not has_changes(delta):
        return False
    raw = members() if callable(members) else (members or {})
    products = raw.get("products", products)
    star.merge_members(store, raw)
    sales = star.stage_sales(store, delta, products, "clean_sales_delta")
    staged = store.versions("clean_sales_delta")[-1]
    star.write_calendar(store, sales, "clean_sales_delta")
    rows = star.keyed_sales(sales, *star.dimensions(store), sizes=star.sizes(store))
    star.write_fact(store, rows, bookmark=upto, products=products)
    star.log_fact(store, "MERGE of changes", "clean_sales_delta")
    store.discard("clean_sales_delta", staged)
    return True


def merge_deltas(
    store: TableStore,
    zone: LandingZone,
    spec: LoadSpec,
    products: DataFrame,
    source_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
    members: Raw | None = None,
    **options,
) -> StreamingQuery:
    """Ingest new sales files and merge each batch's changes into the fact.

    With ``members``, each batch merges the other dimensions first.
    """
    return auto_ingest(
        zone, spec, source_dir, checkpoint, trigger,
        after_load=lambda _: merge_sales_delta(store, zone, spec, products, members), **options,
    )
