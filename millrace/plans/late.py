"""Late members: sales that came before the product, branch or member of staff they name.

Such a sale is stored with a NULL key. What it waits for is kept beside the fact: its business ids
without a member, appended in one run per merge. The latest entry of a sale counts, so a sale that
comes again, or is repaired, replaces what it waited for. When dimensions have gained members since
the fact's last version, the entries that name one of them are picked, and their keys (and the price
and revenue that a product brings with it) are set in the fact.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import lookup
from ..operators.merge import ACTION
from ..tables import TableStore
from . import clean

#: Dimension, business id and surrogate key of each kind of member.
KINDS = {
    "dim_product": ("product_id", "product_key"),
    "dim_branch": ("branch_id", "branch_key"),
    "dim_staff": ("staff_id", "staff_key"),
}
IDS = [i for i, _ in KINDS.values()]
RUN = "run"
MAX_RUNS = 16


def _waits() -> Column:
    return F.coalesce(*[F.col(i).cast("string") for i in IDS]).isNotNull()


def missing() -> list[Column]:
    """The business ids of a keyed sale that have no member."""
    return [F.when(F.col(key).isNull(), F.col(i)).alias(i) for i, key in KINDS.values()]


def entries(rows: DataFrame, period: str, known: DataFrame) -> DataFrame:
    """What keyed sales wait for; a sale the fact held before has an entry even if for nothing."""
    waiting = rows.select("sale_id", period, *missing())
    # A sale's id is its own: no key is hot here, and nothing has to be counted or spread.
    settled = waiting.filter(~_waits()).join(known.select("sale_id"), "sale_id", "left_semi")
    return waiting.filter(_waits()).unionByName(settled)


def latest(runs: DataFrame, period: str) -> DataFrame:
    """One entry per sale, the newest."""
    entry = F.max_by(F.struct(period, *IDS), RUN).alias("e")
    return runs.groupBy("sale_id").agg(entry).select("sale_id", "e.*")


class Waiting:
    """The entries of a fact, append-only in runs, with the state kept in the fact's manifest."""

    def __init__(self, store: TableStore, fact: str, period: str, max_runs: int = MAX_RUNS):
        self.store, self.name, self.period, self.max_runs = store, f"{fact}_waiting", period, max_runs

    def read(self, state: Mapping) -> DataFrame:
        return self.store.read(self.name, state["version"])

    def start(self, found: DataFrame) -> dict:
        version = self.store.write(found.withColumn(RUN, F.lit(0)), self.name, [RUN])
        return {"version": version, "runs": 0}

    def add(self, state: Mapping, found: DataFrame) -> dict:
        run = state["runs"] + 1
        if run >= self.max_runs:  # fold: only the latest entries that wait for something
            both = self.read(state).unionByName(found.withColumn(RUN, F.lit(run)))
            return self.start(latest(both, self.period).filter(_waits()))
        kept = self.store.manifest(self.name, state["version"]).partitions
        version = self.store.write(found.withColumn(RUN, F.lit(run)), self.name, [RUN], None, kept, onto=state["version"])
        return {"version": version, "runs": run}


def versions(store: TableStore) -> dict[str, int]:
    """The latest version of each dimension."""
    return {name: store.versions(name)[-1] for name in KINDS if store.exists(name)}


def new_members(store: TableStore, since: Mapping[str, int]) -> dict[str, DataFrame]:
    """Business id and key of the members each dimension has gained since these versions.

    A dimension without a version there, or with versions since that are no longer kept, counts as
    new as a whole.
    """
    found = {}
    for name, (business_id, key) in KINDS.items():
        now = versions(store).get(name)
        if now is None or now == since.get(name):
            continue
        gained, kept = None, store.versions(name)
        between = range(since.get(name, now) + 1, now + 1)
        if name not in since or any(v not in kept for v in between):
            gained, between = store.read(name).select(business_id, key), ()
        for v in between:
            if store.manifest(name, v).counts.get("rows_I") == 0:
                continue
            rows = store.written_rows(name, v)
            rows = rows.filter(F.col(ACTION) == "I") if ACTION in rows.columns else rows
            rows = rows.select(business_id, key)
            gained = rows if gained is None else gained.unionByName(rows)
        if gained is not None:
            found[name] = gained.filter(F.col(business_id).isNotNull()).dropDuplicates([business_id])
    return found


def repairs(
    waiting: DataFrame, period: str, members: Mapping[str, DataFrame], products: DataFrame, single: bool = False
) -> DataFrame | None:
    """Sales that wait for one of these members: the keys to set, and the product's price.

    The ids that stay without a member are kept, so that they can wait on. ``single`` says that the
    entries are of one run, so that none has to be picked among a sale's before the lookups.
    """
    if not members:
        return None
    if single:
        rows = waiting.select("sale_id", period, *IDS)
    else:
        touched = None
        for name, gained in members.items():
            business_id, key = KINDS[name]
            hits = lookup(waiting.select("sale_id", business_id), gained, business_id, business_id, [key], how="inner").select("sale_id")
            touched = hits if touched is None else touched.unionByName(hits)
        rows = latest(waiting.join(touched, "sale_id", "left_semi"), period)
    prices = clean.product_prices(products)
    for name, (business_id, key) in KINDS.items():
        gained = members.get(name)
        if gained is None:
            rows = rows.withColumn(key, F.lit(None).cast("bigint"))
            continue
        gained, take = gained.withColumnRenamed(business_id, "_id"), [key]
        if name == "dim_product":  # a price comes only with a product, so the products bring it along
            gained, take = lookup(gained, prices, "_id", "_product", ["product_price"]), [key, "product_price"]
        rows = lookup(rows, gained, business_id, "_id", take, counted=waiting)
    if "product_price" not in rows.columns:
        rows = rows.withColumn("product_price", F.lit(None).cast(prices.schema["product_price"].dataType))
    found = F.coalesce(*[F.col(key) for _, key in KINDS.values()]).isNotNull()
    keys = [key for _, key in KINDS.values()]
    fixes = rows.filter(found).select("sale_id", period, *keys, "product_price", *missing())
    return fixes.dropDuplicates(["sale_id"]) if single else fixes


def apply(part: DataFrame, fixes: DataFrame, small: bool = False) -> DataFrame:
    """Stored sales with the keys, prices and revenues they waited for; ``_repaired`` marks them.

    There is one fix a sale; ``small`` says that the fixes may be broadcast.
    """
    keys = [key for _, key in KINDS.values()]
    named = fixes.select("sale_id", *[F.col(k).alias("_" + k) for k in keys], F.col("product_price").alias("_price"), F.lit(True).alias("_repaired"))
    both = part.join(F.broadcast(named) if small else named, "sale_id", "left")
    price = F.coalesce("price", F.col("_price")).cast("decimal(12,2)")
    revenue = F.coalesce("revenue", (F.coalesce("price", F.col("_price")) * F.col("volume_sold")).cast("decimal(12,2)"))
    set_to = {k: F.coalesce(k, "_" + k) for k in keys}
    # A price comes only with the product that was missing.
    set_to |= {c: F.when(F.col("_price").isNotNull(), v).otherwise(F.col(c)) for c, v in (("price", price), ("revenue", revenue))}
    return both.select(*[set_to[c].alias(c) if c in set_to else F.col(c) for c in part.columns], "_repaired")
