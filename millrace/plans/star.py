"""Dimensions, the sales fact, and the run that builds them from raw tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_name, day_part, is_weekend_iso, month_part, quarter_part, year_part
from ..operators import assign_keys, date_bounds, date_series, lookup, max_key, merge
from ..index import KeyIndex
from ..operators.joins import BROADCAST_BYTES
from ..operators.merge import ACTION
from ..tables import TableStore, log_step
from . import clean, late

# Columns of the target tables.
DIM_DATE = (
    "date_key bigint, date date, day tinyint, month tinyint, year smallint, quarter tinyint, "
    "day_name string, is_weekend boolean"
)
DIM_CITY = "city_id decimal(38,0), city_name string"
DIM_BRANCH = "branch_key bigint, branch_id decimal(38,0), city_name string, branch_name string"
DIM_PRODUCT = "product_key bigint, product_id decimal(38,0), product_name string, category string"
DIM_STAFF = "staff_key bigint, staff_id string, employee_id string, first_name string, last_name string, role string"
FACT_SALES = (
    "sale_id decimal(38,0), date_key bigint, product_key bigint, branch_key bigint, staff_key bigint, "
    "sale_ts timestamp_ntz, volume_sold decimal(12,2), price decimal(12,2), cost decimal(12,2), revenue decimal(12,2)"
)

DIMENSIONS = ("dim_date", "dim_product", "dim_city", "dim_branch", "dim_staff")
SCHEMAS = {
    "dim_date": DIM_DATE,
    "dim_city": DIM_CITY,
    "dim_branch": DIM_BRANCH,
    "dim_product": DIM_PRODUCT,
    "dim_staff": DIM_STAFF,
}
FACT_COLUMNS = [
    "date_key", "product_key", "branch_key", "staff_key", "sale_ts", "volume_sold", "price", "cost", "revenue"
]
PERIOD = "sale_period"
NO_PERIOD = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for a NULL partition value
_ROW_BYTES = 16 * 14  # a row of the fact with its ids, all columns counted at the widest
_PAIR_BYTES = 16 * 3  # a key and an id of fixed width, as ``lookup`` measures them
GRAINS = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd"}


# -- dimensions ----------------------------------------------------------------------------------


def calendar(days: DataFrame) -> DataFrame:
    """Date attributes of a ``date`` column."""
    return days.select(
        "date",
        day_part("date").alias("day"),
        month_part("date").alias("month"),
        year_part("date").alias("year"),
        quarter_part("date").alias("quarter"),
        day_name("date").alias("day_name"),
        is_weekend_iso("date").alias("is_weekend"),
    )


def dim_date(sales: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Keyed calendar over the days of the sales; days already there keep their row and key.

    An extended calendar has no gap: it runs from the earlier first day to the later last one.
    """
    bounds = date_bounds(sales, "sale_ts")
    if existing is None:
        return _with_action(assign_keys(calendar(date_series(bounds)), "date_key", ["date"]), "I")
    bounds = bounds.unionByName(date_bounds(existing, "date")).agg(
        F.min("min_d").alias("min_d"), F.max("max_d").alias("max_d")
    )
    days = calendar(date_series(bounds))
    # One row per day: fewer than four million days exist, so a calendar is safe to broadcast.
    fresh = days.join(F.broadcast(existing.select("date")), "date", "left_anti")
    added = assign_keys(fresh, "date_key", ["date"], max_key(existing, "date_key"))
    return _with_action(existing, "K").unionByName(_with_action(added, "I"))


def _with_action(df: DataFrame, action: str) -> DataFrame:
    return df.withColumn(ACTION, F.lit(action))


def dim_city(target: DataFrame, cities: DataFrame, **options) -> DataFrame:
    source = cities.select(F.col("city_id").cast("decimal(38,0)").alias("city_id"), "city_name")
    return merge(target, source, ["city_id"], ["city_name"], null_keys="drop", **options)


def dim_branch(target: DataFrame, branches: DataFrame, **options) -> DataFrame:
    """A known branch gets its new name but keeps its city; a new one gets both."""
    source = branches.select(F.col("branch_id").cast("decimal(38,0)").alias("branch_id"), "city_name", "branch_name")
    return merge(target, source, ["branch_id"], ["branch_name"], surrogate="branch_key", **options)


def dim_product(target: DataFrame, products: DataFrame, **options) -> DataFrame:
    source = products.select(F.col("product_id").cast("decimal(38,0)").alias("product_id"), "product_name", "category")
    return merge(target, source, ["product_id"], ["product_name", "category"], surrogate="product_key", **options)


def dim_staff(target: DataFrame, staff: DataFrame, **options) -> DataFrame:
    columns = ["employee_id", "first_name", "last_name", "role"]
    return merge(
        target, staff.select("staff_id", *columns), ["staff_id"], columns, surrogate="staff_key", **options
    )


# -- fact ------------------------------------------------------------------------------------------


def join_date(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales on a day of the calendar, with its key; sales without a timestamp drop out."""
    days = dates.select("date_key", F.col("date").alias("_date"))
    # One row per day: fewer than four million days exist, so a calendar is safe to broadcast.
    return sales.join(F.broadcast(days), sales["sale_ts"].cast("date") == days["_date"], "inner").drop("_date")


def lookup_product(
    sales: DataFrame, products: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES, size: int | None = None, counted: DataFrame | None = None
) -> DataFrame:
    known = products.select("product_key", F.col("product_id").cast("decimal(38,0)").alias("_id"))
    return lookup(sales, known, "product_id", "_id", ["product_key"], max_broadcast_bytes=max_broadcast_bytes, right_bytes=size, counted=counted)


def lookup_branch(
    sales: DataFrame, branches: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES, size: int | None = None, counted: DataFrame | None = None
) -> DataFrame:
    known = branches.select("branch_key", F.col("branch_id").cast("decimal(38,0)").alias("_id"))
    return lookup(sales, known, "branch_id", "_id", ["branch_key"], max_broadcast_bytes=max_broadcast_bytes, right_bytes=size, counted=counted)


def lookup_staff(
    sales: DataFrame, staff: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES, size: int | None = None, counted: DataFrame | None = None
) -> DataFrame:
    known = staff.select("staff_key", F.col("staff_id").alias("_id"))
    return lookup(sales, known, "staff_id", "_id", ["staff_key"], max_broadcast_bytes=max_broadcast_bytes, right_bytes=size, counted=counted)


def keyed_sales(
    sales: DataFrame,
    dates: DataFrame,
    products: DataFrame,
    branches: DataFrame,
    staff: DataFrame,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    sizes: Mapping[str, int | None] | None = None,
) -> DataFrame:
    """Clean sales with the surrogate keys of their dimensions, NULL for unknown members, and the
    business ids behind them. ``sizes`` are the dimensions' known bytes; others are measured."""
    sizes = sizes or {}
    rows = join_date(sales, dates)
    # Keys are counted in the sales as they are given, not behind the lookups before.
    rows = lookup_product(rows, products, max_broadcast_bytes, sizes.get("dim_product"), sales)
    rows = lookup_branch(rows, branches, max_broadcast_bytes, sizes.get("dim_branch"), sales)
    rows = lookup_staff(rows, staff, max_broadcast_bytes, sizes.get("dim_staff"), sales)
    return rows.select(
        "sale_id", "date_key", "product_key", "branch_key", "staff_key", "sale_ts",
        *[F.col(c).cast("decimal(12,2)").alias(c) for c in ("volume_sold", "price", "cost", "revenue")],
        *late.IDS,
    )


def fact_rows(*args, **options) -> DataFrame:
    """The columns of the fact from ``keyed_sales``, with the same arguments."""
    return keyed_sales(*args, **options).drop(*late.IDS)


def fact_sales(target: DataFrame, rows: DataFrame, **options) -> DataFrame:
    """Upsert by sale; a sale without an id is left out, as the id is the primary key."""
    return merge(target, rows, ["sale_id"], FACT_COLUMNS, null_keys="drop", unique_source=True, **options)


def _laid_out(rows: DataFrame, grain: str) -> DataFrame:
    """Fact rows with their period, spread so that each period becomes few, evenly sized files.

    The spread is left to adaptive execution: it joins small periods and splits one that holds a
    large share of the rows.
    """
    return rows.withColumn(PERIOD, _period(grain)).hint("rebalance", PERIOD)


def _period(grain: str) -> Column:
    return F.coalesce(F.date_format("sale_ts", GRAINS[grain]), F.lit(NO_PERIOD))


def write_fact(
    store: TableStore,
    rows: DataFrame,
    name: str = "fact_sales",
    bookmark: int | None = None,
    grain: str = "month",
    max_broadcast_bytes: int = BROADCAST_BYTES,
    products: DataFrame | None = None,
    observe: Mapping[str, Column] | None = None,
) -> int:
    """Merge rows into the stored fact, which is partitioned by period of sale.

    The first write is a plain write. A later one asks the fact's key index for the periods that
    hold an earlier version of one of the sales, and rewrites those and the periods the rows fall
    in; no other part of the fact is read, and its files stay in place.

    Rows with business ids (``keyed_sales``) also keep what waits for late members. With the raw
    ``products`` given, sales that wait for members which their dimensions have gained since the
    fact's last version get their keys in the same merge. Index, waiting entries and the
    dimensions' versions are part of the fact's version.
    """
    index = KeyIndex(store, name, "sale_id", PERIOD)
    waiting = late.Waiting(store, name, PERIOD)
    with_ids = all(i in rows.columns for i in late.IDS)
    columns = ["sale_id", *FACT_COLUMNS]
    usable = rows.filter(F.col("sale_id").isNotNull())
    # The rows are read several times below: write them once.
    delta_version = store.write(usable.withColumn(PERIOD, _period(grain)), f"{name}_delta", observe=observe)
    rows = store.read(f"{name}_delta", delta_version)
    counted = store.manifest(f"{name}_delta", delta_version).counts
    state = {"members": late.versions(store)} if with_ids else {}
    if not store.exists(name):
        first = rows.select(*columns).withColumn(ACTION, F.lit("I"))
        draft = store.prepare(_laid_out(first, grain), name, [PERIOD], bookmark)
        state["keys"] = index.build(rows.select("sale_id", PERIOD), counted.get("rows", 0))
        if with_ids:
            state["waiting"] = waiting.start(late.entries(rows, PERIOD, rows.limit(0)))
        version = store.commit(draft, _with_needs(name, state))
        store.discard(f"{name}_delta", delta_version)
        return version

    manifest = store.manifest(name)
    before = dict(manifest.extra)
    if "keys" not in before:  # a fact from before the index: its only full scan
        stored_keys = store.read(name).select("sale_id", F.coalesce(PERIOD, F.lit(NO_PERIOD)).alias(PERIOD))
        before["keys"] = index.build(stored_keys, stored_keys.count())
    n = counted.get("rows", 0)
    # The columns of the fact have a fixed width, so the number of rows bounds their size.
    small = n * _ROW_BYTES <= max_broadcast_bytes
    found = index.find(before["keys"], rows, small, n)
    stages = {f"{name}_delta": delta_version}  # what only this merge reads
    if with_ids:  # read again for what waits
        stages[f"{name}_found"] = store.write(found, f"{name}_found")
        found = store.read(f"{name}_found", stages[f"{name}_found"])
    repairs = _fixes(store, name, waiting, before, rows, products) if with_ids else None
    fixes = None
    if repairs is not None:
        stages[f"{name}_repairs"] = repairs
        if store.manifest(f"{name}_repairs", repairs).counts.get("rows", 0):
            fixes = store.read(f"{name}_repairs", repairs)
    # Distinct periods: they name folders in the manifest.
    named = rows.select(PERIOD).unionByName(found.select(PERIOD))
    named = named if fixes is None else named.unionByName(fixes.select(PERIOD))
    touched = sorted(r[PERIOD] for r in named.distinct().collect())
    part = store.read_partitions(name, touched, manifest.version).drop(PERIOD)
    if fixes is None:
        merged = fact_sales(part, rows.select(*columns), small_source=small)
    else:
        few = store.manifest(f"{name}_repairs", repairs).counts.get("rows", 0) * _ROW_BYTES <= max_broadcast_bytes
        merged = fact_sales(late.apply(part, fixes, few), rows.select(*columns), small_source=small)
        repaired = (F.col(ACTION) == "K") & F.col("_repaired")
        merged = merged.withColumn(ACTION, F.when(repaired, F.lit("U")).otherwise(F.col(ACTION))).drop("_repaired")
    kept = [v for v in manifest.partitions if v not in touched]
    draft = store.prepare(_laid_out(merged, grain), name, [PERIOD], bookmark, kept, onto=manifest.version)
    state["keys"] = index.add(before["keys"], rows.select("sale_id", PERIOD), n)
    if with_ids:
        now = late.entries(rows, PERIOD, found)
        if fixes is not None:
            now = now.unionByName(fixes.select("sale_id", PERIOD, *late.IDS))
        state["waiting"] = waiting.add(before["waiting"], now) if "waiting" in before else waiting.start(now)
    else:
        state = {**{k: v for k, v in before.items() if k != "keys"}, **state}
    version = store.commit(draft, _with_needs(name, state))
    for stage, written in stages.items():
        store.discard(stage, written)
    return version


def _with_needs(name: str, state: dict) -> dict:
    """The state and the versions of other tables it names, which must live as long as it does."""
    needs = {f"{name}_keys": state["keys"]["base"], f"{name}_keys_recent": state["keys"]["recent"]}
    if "waiting" in state:
        needs[f"{name}_waiting"] = state["waiting"]["version"]
    return {**state, "needs": needs}


def _fixes(store, name, waiting, before, rows, products) -> int | None:
    """Keys for stored sales whose members have come, written once: their version; None when there is nothing new."""
    if products is None or "waiting" not in before:
        return None
    members = late.new_members(store, before.get("members", {}))
    single = not before["waiting"]["runs"]
    found = late.repairs(waiting.read(before["waiting"]), PERIOD, members, products, single) if members else None
    if found is None:
        return None
    # A sale that comes again now has its keys from today's dimensions.
    left = found.join(rows.select("sale_id"), "sale_id", "left_anti")
    return store.write(left, f"{name}_repairs")


def read_fact(store: TableStore, name: str = "fact_sales") -> DataFrame:
    return store.read(name).drop(PERIOD)


# -- the run ----------------------------------------------------------------------------------------


def init(store: TableStore) -> None:
    """Start over: an empty version of every dimension."""
    for name, schema in SCHEMAS.items():
        store.create(name, schema)


def dimensions(store: TableStore) -> tuple[DataFrame, ...]:
    """Dates, products, branches and staff, in the order ``keyed_sales`` takes them."""
    return tuple(store.read(n) for n in ("dim_date", "dim_product", "dim_branch", "dim_staff"))


def sizes(store: TableStore) -> dict[str, int | None]:
    """Bytes of what a lookup takes from each dimension, its key and its business id, as far as the
    dimensions' writes have measured them."""
    found = {}
    for name, (business_id, _) in late.KINDS.items():
        size, rows = store.size(name), store.manifest(name).counts.get("rows")
        if size is not None and size > BROADCAST_BYTES:  # names and other columns may make it that large
            fixed = dict(store.read(name).dtypes)[business_id] != "string" and rows is not None
            size = rows * _PAIR_BYTES if fixed else None
        found[name] = size
    return found


_DAYS = {"first_day": F.min, "last_day": F.max}


def write_calendar(store: TableStore, sales: DataFrame, staged: str | None = None) -> int:
    """Extend the stored calendar to the days of the sales.

    When the write of the ``staged`` sales has seen no day outside the calendar's, the calendar
    stays the version it is, and nothing is read.
    """
    known = store.exists("dim_date")
    if known and staged is not None:
        have, want = store.manifest("dim_date").counts, store.manifest(staged).counts
        if "last_day" in have and (
            "last_day" not in want or have["first_day"] <= want["first_day"] and want["last_day"] <= have["last_day"]
        ):
            return store.versions("dim_date")[-1]
    days = dim_date(sales, store.read("dim_date") if known else None)
    return store.write(days, "dim_date", observe={k: f(F.unix_date("date")) for k, f in _DAYS.items()})


def stage_sales(store: TableStore, sales: DataFrame, products: DataFrame, name: str) -> DataFrame:
    """Clean sales, written once; their days, and sales without a timestamp, are seen on the way."""
    seen = {k: f(F.unix_date(F.col("sale_ts").cast("date"))) for k, f in _DAYS.items()}
    store.write(clean.sales_clean(sales, products), name, observe={"left_out": F.count_if(F.col("sale_ts").isNull()), **seen})
    return store.read(name)


def merge_members(store: TableStore, raw: Mapping[str, DataFrame]) -> None:
    """Merge the members of all dimensions but the calendar from raw tables.

    Tables that are not given leave their dimension as it is.
    """
    steps: dict[str, tuple[Callable[..., DataFrame], Callable[[], DataFrame], tuple[str, ...]]] = {
        "dim_city": (dim_city, lambda: clean.cities_clean(raw["cities"]), ("cities",)),
        "dim_branch": (dim_branch, lambda: clean.branches_clean(raw["branches"]), ("branches",)),
        "dim_product": (dim_product, lambda: clean.products_clean(raw["products"]), ("products",)),
        "dim_staff": (dim_staff, lambda: clean.staff_clean(raw["staff"], raw["employees"]), ("staff", "employees")),
    }
    for name, (step, source, needs) in steps.items():
        if all(n in raw for n in needs):
            staged = name.replace("dim_", "clean_")
            store.write(source(), staged)
            size = store.size(staged)
            small = None if size is None else size <= BROADCAST_BYTES
            store.write(step(store.read_or_empty(name, SCHEMAS[name]), store.read(staged), small_source=small), name)


def log_fact(store: TableStore, what: str, staged: str) -> None:
    """Log the fact's last merge and how many sales it left out."""
    left_out = store.manifest(staged).counts.get("left_out", 0)
    log_step(store, "LOAD_FACT_SALES", store.merge_counts("fact_sales"), f"{what}; {left_out} without a timestamp were left out")


def build(
    store: TableStore,
    raw: Mapping[str, DataFrame],
    production: TableStore | None = None,
    include_fact: bool = False,
    bookmark: int | None = None,
) -> TableStore:
    """Raw tables to star schema: stage clean rows, merge dimensions, merge the fact, log, publish.

    ``raw`` holds cities, branches, products, employees, staff, assignments and sales. Clean rows
    that several steps read are written once. Running again with the same input changes nothing,
    except that members without a usable id never match and are added again.
    """
    sales = stage_sales(store, raw["sales"], raw["products"], "clean_sales")
    write_calendar(store, sales)  # a full run makes a version of every table
    merge_members(store, raw)
    write_fact(store, keyed_sales(sales, *dimensions(store), sizes=sizes(store)), bookmark=bookmark, products=raw["products"])
    log_fact(store, "merged clean sales", "clean_sales")
    if production is not None:
        store.publish(production, [*DIMENSIONS, "fact_sales"] if include_fact else DIMENSIONS)
    return store
