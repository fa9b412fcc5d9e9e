from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.audit import AuditFailed
from millrace.index import KeyIndex
from millrace.operators import has_changes, run_checks
from millrace.plans import clean, holidays, star
from millrace.sources import SPECS, LandingZone
from millrace.streaming import merge_deltas, merge_sales_delta
from millrace.tables import TableStore, log_details
from registry.inputs import raw

from .conftest import plan, rows

SF = "/root/testdata/sf0.001"
NAMES = ("cities", "branches", "products", "employees", "staff", "assignments", "sales")
LIMIT = {"max_broadcast_bytes": 0}


def sales_of(spark, *data):
    schema = (
        "sale_id string, branch_id string, staff_id string, product_id string, sale_date timestamp_ntz, "
        "volume_sold string, price string, cost string, revenue string"
    )
    return spark.createDataFrame(data, schema)


def at(day, month=1):
    return dt.datetime(2024, month, day, 12)


PRODUCTS = "product_id string, product_name string, category string, price string"


def products_of(spark):
    return spark.createDataFrame([("1", "b", "c", "9.00"), ("1", "a", "c", "2.50"), (" 2", "x", "y", "bad")], PRODUCTS)


def test_sales_clean(spark):
    sales = sales_of(
        spark,
        ("10", "1", " S1 ", "1", at(1), "2", None, "1", None),
        ("10", "1", " S2 ", "1", at(2), "3", None, "1", None),
        ("11", "x", "S1", "2", None, "2", None, "1", None),
        ("12", "1", "S1", "7", at(3), "2", "4.00", "1", "5.55"),
        ("bad", "1", "S1", "1", at(3), "2", "4.00", "1", None),
        (None, "1", "S1", "1", at(3), "2", "4.00", "1", None),
    )
    for limit in ({}, LIMIT):
        got = clean.sales_clean(sales, products_of(spark), **limit)
        seen = [(r[0] and int(r[0]), r[2], r[6] and float(r[6]), r[8] and float(r[8])) for r in rows(got)]
        assert sorted(seen, key=str) == sorted(
            [(10, "S2", 2.5, 7.5), (11, "S1", None, None), (12, "S1", 4.0, 5.55), (None, "S1", 4.0, 8.0)], key=str
        )


def test_sales_clean_shuffles_sales_once(spark):
    got = clean.sales_clean(raw(spark, SF, "sales"), raw(spark, SF, "products"))
    text = plan(got)
    # One exchange for the sales, one for the prices; the price lookup is a broadcast.
    assert text.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" not in text


def test_views_do_not_depend_on_the_join_strategy(spark):
    staff, people = raw(spark, SF, "staff"), raw(spark, SF, "employees")
    assert rows(clean.staff_clean(staff, people)) == rows(clean.staff_clean(staff, people, **LIMIT))
    branches, cities = raw(spark, SF, "branches"), raw(spark, SF, "cities")
    assert rows(clean.match_city(branches, cities)) == rows(clean.match_city(branches, cities, **LIMIT))
    both = clean.branches_clean(branches, cities).drop("matched_city_id")
    assert rows(both) == rows(clean.branches_clean(branches))


def test_latest_assignment_prefers_the_open_one(spark):
    df = spark.createDataFrame(
        [("S1", "1", dt.date(2024, 1, 1), None), ("S1", "2", dt.date(2024, 6, 1), dt.date(2024, 7, 1)),
         ("S2", "3", dt.date(2024, 1, 1), dt.date(2024, 7, 1)), ("S2", "4", dt.date(2024, 2, 1), dt.date(2024, 7, 1))],
        "staff_id string, branch_id string, start_date date, end_date date",
    )
    assert [(r[0], int(r[1])) for r in rows(clean.staff_latest_assignment(df))] == [("S1", 1), ("S2", 4)]


def test_branch_rename_keeps_the_city_and_null_keys_come_again(spark):
    schema = "branch_id int, city_name string, branch_name string"
    empty = spark.createDataFrame([], star.DIM_BRANCH)
    first = star.dim_branch(empty, spark.createDataFrame([(1, "Nairobi", "A"), (None, "Kisumu", "N")], schema)).drop("_action")
    again = star.dim_branch(first, spark.createDataFrame([(1, "Mombasa", "B"), (None, "Kisumu", "N")], schema))
    assert rows(again.select("branch_id", "city_name", "branch_name", "_action")) == [
        (1, "Nairobi", "B", "U"), (None, "Kisumu", "N", "I"), (None, "Kisumu", "N", "K")
    ]
    assert sorted(r["branch_key"] for r in again.collect()) == [1, 2, 3]


def test_primary_key_tables_leave_null_keys_out(spark):
    cities = spark.createDataFrame([(1, "A"), (None, "N")], "city_id int, city_name string")
    assert rows(star.dim_city(spark.createDataFrame([], star.DIM_CITY), cities)) == [(1, "A", "I")]


@pytest.fixture(scope="module")
def built(spark):
    from millrace.storage import work_folder

    root = work_folder(spark, "built")
    store, production = TableStore(spark, f"{root}/transformed"), TableStore(spark, f"{root}/production")
    data = {n: raw(spark, SF, n) for n in NAMES}
    star.build(store, data, production)
    first = {n: rows(store.read(n)) for n in (*star.DIMENSIONS, "fact_sales")}
    star.build(store, data, production)
    return store, production, first


def test_running_again_changes_nothing(built):
    store, _, first = built
    for name, before in first.items():
        assert rows(store.read(name)) == before, name
        assert store.merge_counts(name).first()["rows_inserted"] == 0
    counts = [(r["rows_inserted"], r["rows_updated"]) for r in log_details(store).orderBy("started_at").collect()]
    n = len(first["fact_sales"])
    assert counts == [(n, 0), (0, n)]


def test_published_are_the_dimensions(built):
    store, production, first = built
    for name in star.DIMENSIONS:
        assert rows(production.read(name)) == first[name]
    assert not production.exists("fact_sales")


def test_fact_keys_point_to_their_members(built):
    store, *_ = built
    fact = star.read_fact(store)
    dates = store.read("dim_date").select("date_key", "date")
    assert fact.join(dates, "date_key").filter(F.col("sale_ts").cast("date") != F.col("date")).isEmpty()
    for name, key in (("dim_product", "product_key"), ("dim_branch", "branch_key"), ("dim_staff", "staff_key")):
        assert fact.filter(F.col(key).isNotNull()).join(store.read(name), key, "left_anti").isEmpty()


def dimensions(spark, store):
    store.write(spark.createDataFrame([(1, Decimal(1), "A", "c")], star.DIM_PRODUCT), "dim_product")
    store.write(spark.createDataFrame([(1, Decimal(1), "N", "B")], star.DIM_BRANCH), "dim_branch")
    store.write(spark.createDataFrame([(1, "S1", "E1", "a", "b", "c")], star.DIM_STAFF), "dim_staff")


def stored(store):
    return [(int(r["sale_id"]), str(r["sale_ts"])[:10], float(r["volume_sold"])) for r in star.read_fact(store).orderBy("sale_id").collect()]


def header(*lines):
    return "\n".join(["sale_id,branch_id,staff_id,product_id,sale_date,volume_sold,price,cost,revenue", *lines]) + "\n"


def test_delta_merges_rewrite_only_touched_periods(spark, tmp_path, folder):
    store, zone, spec = TableStore(spark, f"{folder}/t"), LandingZone(spark, f"{folder}/r"), SPECS["sales"]
    dimensions(spark, store)
    source, products = tmp_path / "sales", products_of(spark)
    source.mkdir()
    (source / "1.csv").write_text(header(
        "1,1,S1,1,2024-01-05,1,1,1,1", "2,1,S1,1,2024-02-05,1,1,1,1", "3,1,S1,1,2024-03-05,1,1,1,1"))
    zone.load(spec, str(source))
    assert merge_sales_delta(store, zone, spec, products)
    before = store.manifest("fact_sales").partitions
    assert sorted(before) == ["2024-01", "2024-02", "2024-03"] and store.bookmark("fact_sales") == 1
    assert not merge_sales_delta(store, zone, spec, products)
    # Sale 2 moves from February to April, which the calendar does not have yet.
    (source / "2.csv").write_text(header("2,1,S1,1,2024-04-09,7,1,1,1", "9,1,S1,1,2024-04-01,1,1,1,1"))
    zone.load(spec, str(source))
    assert merge_sales_delta(store, zone, spec, products)
    after = store.manifest("fact_sales").partitions
    assert sorted(after) == ["2024-01", "2024-03", "2024-04"]
    assert after["2024-01"] == before["2024-01"] and after["2024-03"] == before["2024-03"]
    assert stored(store) == [(1, "2024-01-05", 1.0), (2, "2024-04-09", 7.0), (3, "2024-03-05", 1.0), (9, "2024-04-01", 1.0)]
    assert tuple(store.merge_counts("fact_sales").first()) == (1, 1, 0)
    keys = [r["date_key"] for r in store.read("dim_date").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1)) and len(keys) == 96


@pytest.mark.parametrize("limit", [{}, LIMIT])
@pytest.mark.parametrize("grain", ["year", "day"])
def test_fact_merges_equal_one_full_build(spark, folder, limit, grain):
    store = TableStore(spark, folder)
    for name in ("dim_product", "dim_branch", "dim_staff"):
        store.create(name, star.SCHEMAS[name])
    sales = clean.sales_clean(
        raw(spark, SF, "sales").filter("sale_date < timestamp_ntz'1996-01-01'" if grain == "day" else "true"), raw(spark, SF, "products")
    )
    store.write(sales, "sales")
    sales = store.read("sales")
    store.write(star.dim_date(sales), "dim_date")
    lookups = [store.read(n) for n in ("dim_date", "dim_product", "dim_branch", "dim_staff")]
    full = star.fact_rows(sales, *lookups)
    star.write_fact(store, full, "once", grain=grain)
    star.write_fact(store, full.filter("sale_id % 3 > 0").withColumn("cost", F.col("cost") * 0), "twice", grain=grain)
    star.write_fact(store, full, "twice", grain=grain, **limit)
    assert rows(star.read_fact(store, "once")) == rows(star.read_fact(store, "twice"))


def test_stream_of_deltas_equals_batch(spark, tmp_path, folder):
    store, zone = TableStore(spark, f"{folder}/t"), LandingZone(spark, f"{folder}/r")
    dimensions(spark, store)
    (tmp_path / "in").mkdir()
    lots = [["1,1,S1,1,2024-01-05,1,1,1,1", "2,1,S1,1,bad,1,1,1,1"], ["1,1,S1,1,2024-01-06,5,1,1,1"]]
    for n, lines in enumerate(lots):
        (tmp_path / "in" / f"{n}.csv").write_text(header(*lines))
        merge_deltas(store, zone, SPECS["sales"], products_of(spark), str(tmp_path / "in"), f"{folder}/c").awaitTermination()
    assert stored(store) == [(1, "2024-01-06", 5.0)]
    assert store.bookmark("fact_sales") == 2 and zone.rejected_rows(SPECS["sales"]).count() == 1
    assert not has_changes(zone.changes_since(SPECS["sales"], 2))


def spoil(paths) -> None:
    """Make files unreadable, so that a scan of one of them fails."""
    from pathlib import Path

    for path in paths:
        for file in Path(path.removeprefix("file:")).glob("*.parquet"):
            file.write_bytes(b"spoilt")


def test_a_small_delta_reads_its_buckets_and_periods_only(spark, tmp_path, folder):
    store, zone, spec = TableStore(spark, f"{folder}/t"), LandingZone(spark, f"{folder}/r"), SPECS["sales"]
    dimensions(spark, store)
    source, products = tmp_path / "sales", products_of(spark)
    source.mkdir()
    (source / "1.csv").write_text(header(*[f"{i},1,S1,1,2024-{1 + i % 12:02d}-05,1,1,1,1" for i in range(400)]))
    zone.load(spec, str(source))
    assert merge_sales_delta(store, zone, spec, products)
    fact = store.manifest("fact_sales")
    keys = store.manifest("fact_sales_keys", fact.extra["keys"]["base"])
    assert len(keys.partitions) == fact.extra["keys"]["buckets"] == 16
    index = KeyIndex(store, "fact_sales", "sale_id", "sale_period")
    one = spark.createDataFrame([(Decimal(7),)], "sale_id decimal(38,0)")
    (bucket,) = index.buckets_of(fact.extra["keys"], one)
    found = index.find(fact.extra["keys"], one, True, 1)
    assert rows(found) == [(7, "2024-08")]
    assert {f.split("/bucket=")[1].split("/")[0] for f in found.inputFiles() if "/bucket=" in f} == {bucket}
    # Sale 7 moves from August to January: nothing else may be read, so all else is spoilt.
    spoil(p for b, p in keys.partitions.items() if b != bucket)
    spoil(p for v, p in fact.partitions.items() if v not in ("2024-08", "2024-01"))
    (source / "2.csv").write_text(header("7,1,S1,1,2024-01-20,9,1,1,1"))
    zone.load(spec, str(source))
    assert merge_sales_delta(store, zone, spec, products)
    assert tuple(store.merge_counts("fact_sales").first()) == (0, 1, 0)
    after = store.manifest("fact_sales")
    changed = {v for v in after.partitions if after.partitions[v] != fact.partitions[v]}
    assert changed == {"2024-01", "2024-08"}
    assert index.find(after.extra["keys"], one, True, 1).collect()[0]["sale_period"] == "2024-01"


def test_key_index_folds_and_grows(spark, folder):
    store = TableStore(spark, folder)
    index = KeyIndex(store, "t", "k", "v", bucket_rows=10, max_runs=3)
    frame = lambda d: spark.createDataFrame(list(d.items()), "k long, v string")
    want = {k: "a" for k in range(300)}
    state = index.build(frame(want), len(want))
    assert state["buckets"] == 32
    everything = spark.range(3_000).select(F.col("id").alias("k"))
    runs = []
    for step in range(1, 9):
        change = {k: f"s{step}" for k in range(step * 7, step * 7 + 30)} | {1000 + step * 200 + i: "new" for i in range(150)}
        want |= change
        before = store.manifest("t_keys", state["base"]).partitions
        state = index.add(state, frame(change))
        runs.append(state["runs"])
        assert dict(rows(index.find(state, everything, False))) == want
    assert 0 in runs and max(runs) == 2 and state["buckets"] > 32
    # A run that died leaves versions that no state names.
    index.add(state, frame({1: "lost"}))
    state = index.add(state, frame({2: "kept"}))
    assert dict(rows(index.find(state, everything, True))) == want | {2: "kept"}
    assert before


def test_sparse_changes_leave_other_buckets_in_place(spark, folder):
    store = TableStore(spark, folder)
    index = KeyIndex(store, "t", "k", "v", max_runs=1)
    state = index.build(spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v")), 1000)
    before = store.manifest("t_keys", state["base"]).partitions
    state = index.add(state, spark.createDataFrame([(5, "b")], "k long, v string"))
    after = store.manifest("t_keys", state["base"]).partitions
    assert len(after) == len(before) == 16 and sum(after[b] != before[b] for b in before) == 1


def natural(store):
    """The fact with business ids in place of surrogate keys."""
    fact = star.read_fact(store)
    for name, business_id, key in (("dim_product", "product_id", "product_key"), ("dim_branch", "branch_id", "branch_key"), ("dim_staff", "staff_id", "staff_key")):
        fact = fact.join(store.read(name).select(key, business_id), key, "left").drop(key)
    return rows(fact.drop("date_key"))


def members_of(spark, products, branches, staff):
    return {
        "products": spark.createDataFrame(products, PRODUCTS),
        "branches": spark.createDataFrame(branches, "branch_id string, branch_name string, city_name string"),
        "staff": spark.createDataFrame(staff, "staff_id string, employee_id string"),
        "employees": spark.createDataFrame([("E1", "a", "b", None, "r")], "employee_id string, first_name string, last_name string, hire_date timestamp_ntz, role string"),
    }


def test_late_members_give_the_same_fact_as_a_full_build(spark, tmp_path, folder):
    zone, spec, store = LandingZone(spark, f"{folder}/r"), SPECS["sales"], TableStore(spark, f"{folder}/t")
    source = tmp_path / "sales"
    source.mkdir()
    p1, p2, p3 = ("1", "a", "c", "2.50"), ("2", "b", "c", "4.00"), ("3", "c", "c", "bad")
    steps = [
        # Sales 1 to 5 name members that are not there yet; 6 is whole; 7 has no timestamp.
        (["1,1,S1,2,2024-01-05,2,,1,", "2,9,S1,1,2024-01-06,1,1,1,1", "3,1,S9,9,2024-02-05,1,,1,", "4,9,S9,2,2024-03-05,3,7,1,",
          "5,1,S1,3,2024-03-06,3,,1,", "6,1,S1,1,2024-04-06,1,,1,", "7,1,S1,1,,1,1,1,1"], ([p1], [("1", "B", "N")], [("S1", "E1")])),
        # Nothing new but a sale; sale 3 comes again with another unknown product.
        (["8,1,S1,1,2024-05-01,1,1,1,1", "3,1,S9,2,2024-02-07,5,,1,"], ([p1], [("1", "B", "N")], [("S1", "E1")])),
        # Products 2 and 3 arrive; sale 4 comes again in the same lot.
        (["4,9,S9,1,2024-06-05,3,7,1,"], ([p1, p2, p3], [("1", "B", "N")], [("S1", "E1")])),
        # The branch and the member of staff arrive.
        (["10,9,S9,2,2024-07-01,1,,1,"], ([p1, p2, p3], [("1", "B", "N"), ("9", "Z", "N")], [("S1", "E1"), ("S9", "E1")])),
    ]
    for n, (lines, members) in enumerate(steps):
        (source / f"{n}.csv").write_text(header(*lines))
        zone.load(spec, str(source))
        given = members_of(spark, *members)
        assert merge_sales_delta(store, zone, spec, given["products"], given)
    full = TableStore(spark, f"{folder}/full")
    full_members = members_of(spark, *steps[-1][1])
    cities = spark.createDataFrame([("1", "N")], "city_id string, city_name string")
    star.build(full, {**full_members, "cities": cities, "sales": zone.table(spec)})
    assert natural(store) == natural(full) and len(natural(store)) == 8
    log = [r["notes"] for r in log_details(store).orderBy("started_at").collect()]
    assert "; 1 without a timestamp" in log[0] and "; 0 without a timestamp" in log[1]
    # Nothing waits any more but for what never came.
    state = store.manifest("fact_sales").extra["waiting"]
    from millrace.plans import late

    waiting = late.latest(store.read("fact_sales_waiting", state["version"]), star.PERIOD)
    assert waiting.filter("product_id IS NOT NULL OR branch_id IS NOT NULL OR staff_id IS NOT NULL").isEmpty()
    # Repaired periods only were rewritten by the last merge: sales 2, 3, 4 and the new one.
    versions = store.versions("fact_sales")
    a, b = (store.manifest("fact_sales", v).partitions for v in versions[-2:])
    assert {v for v in b if a.get(v) != b[v]} == {"2024-01", "2024-02", "2024-06", "2024-07"}


def test_merge_leaves_no_working_rows(spark, tmp_path, folder):
    """What only a merge reads goes with it; counts stay for the log."""
    from millrace.storage import FileSystem

    zone, spec, store = LandingZone(spark, f"{folder}/r"), SPECS["sales"], TableStore(spark, f"{folder}/t")
    source = tmp_path / "sales"
    source.mkdir()
    for n, products in enumerate(([("1", "a", "c", "2.50")], [("1", "a", "c", "2.50"), ("2", "b", "c", "4.00")])):
        (source / f"{n}.csv").write_text(header(f"{n},1,S1,2,2024-01-0{n + 1},2,,1,"))
        zone.load(spec, str(source))
        given = members_of(spark, products, [("1", "B", "N")], [("S1", "E1")])
        assert merge_sales_delta(store, zone, spec, given["products"], given)
    fs = FileSystem(spark, folder)
    for name, versions in (("clean_sales_delta", 2), ("fact_sales_delta", 2), ("fact_sales_found", 1), ("fact_sales_repairs", 1)):
        assert fs.names(f"{folder}/t/{name}/data") == [] and len(store.versions(name)) == versions
        assert store.manifest(name).counts.get("rows", 0) == (0 if name == "fact_sales_found" else 1)
    assert sorted(r["price"] for r in store.read("fact_sales").collect()) == [Decimal("4.00")] * 2


def test_repairs_shuffle_entries_once_a_lookup(spark, folder, monkeypatch):
    """Members too large to broadcast: keys are counted in the stored entries, and no lookup runs those before it again."""
    from functools import partial

    from millrace.operators import joins
    from millrace.plans import late

    counted, real = [], joins._salted_lookup

    def salted(left, side, key, how, *rest):
        counted.append((key, plan(rest[0] if rest else left)))
        return real(left, side, key, how, *rest)

    monkeypatch.setattr(joins, "_salted_lookup", salted)
    monkeypatch.setattr(late, "lookup", partial(late.lookup, max_broadcast_bytes=0))
    kind = f"sale_id decimal(38,0), {star.PERIOD} string, product_id decimal(38,0), branch_id decimal(38,0), staff_id string, run int"
    entries = [(Decimal(k), "2024-01", Decimal(k % 3) if k % 4 else None, Decimal(k % 5), f"S{k % 7}" if k % 2 else None, 0) for k in range(60)]
    entries += entries[:9]  # equal entries of one run
    store = TableStore(spark, folder)
    store.write(spark.createDataFrame(entries, kind), "waiting")
    members = {
        "dim_product": spark.createDataFrame([(Decimal(1), 11), (Decimal(2), 12)], "product_id decimal(38,0), product_key bigint"),
        "dim_branch": spark.createDataFrame([(Decimal(4), 24)], "branch_id decimal(38,0), branch_key bigint"),
        "dim_staff": spark.createDataFrame([("S3", 33)], "staff_id string, staff_key bigint"),
    }
    products = spark.createDataFrame([("1", "a", "c", "2.50"), ("2", "b", "c", "bad")], PRODUCTS)
    got = rows(late.repairs(store.read("waiting"), star.PERIOD, members, products, True))
    assert [k for k, _ in counted] == ["_id", "product_id", "branch_id", "staff_id"]
    assert not any("Join" in p for k, p in counted if k != "_id")
    want = []
    for sale, period, product, branch, staff, _ in dict.fromkeys(entries):
        keys = {1: 11, 2: 12}.get(product), 24 if branch == 4 else None, 33 if staff == "S3" else None
        if any(keys):
            left = [None if key else i for key, i in zip(keys, (product, branch, staff))]
            want.append((sale, period, *keys, Decimal("2.50") if product == 1 else None, *left))
    assert sorted(got, key=lambda r: r[0]) == want
    assert got == rows(late.repairs(store.read("waiting"), star.PERIOD, members, products))
    late.repairs(store.read("waiting"), star.PERIOD, {"dim_staff": members["dim_staff"]}, products, True).collect()
    assert counted[-1][0] == "staff_id"  # no product is new, so no price is looked up


def test_sizes_count_what_a_lookup_takes(spark, folder, monkeypatch):
    """Long names make a dimension large, not the key and id that sales are looked up by."""
    store = TableStore(spark, folder)
    store.write(spark.createDataFrame([(k, Decimal(k), "n" * 3_000, "c") for k in range(5)], star.DIM_PRODUCT), "dim_product")
    store.write(spark.createDataFrame([(1, Decimal(1), "c", "b")], star.DIM_BRANCH), "dim_branch")
    store.write(spark.createDataFrame([(1, "S1", "E1", "f" * 3_000, "l", "r")], star.DIM_STAFF), "dim_staff")
    monkeypatch.setattr(star, "BROADCAST_BYTES", 2_000)
    assert store.size("dim_product") > 15_000
    assert star.sizes(store) == {"dim_product": 5 * 48, "dim_branch": store.size("dim_branch"), "dim_staff": None}


def test_sales_meet_their_entries_and_fixes_without_counting_keys(spark, monkeypatch):
    """The id of a sale is its own, so nothing is measured or spread; hot keys are not looked for."""
    from millrace.operators import joins
    from millrace.plans import late

    def unwanted(*_):
        raise AssertionError("measured")

    monkeypatch.setattr(joins, "fits_broadcast", unwanted)
    ids = "product_id decimal(38,0), branch_id decimal(38,0), staff_id string"
    keyed = [(Decimal(1), "p", 1, 1, None, Decimal(1), Decimal(1), "S9"), (Decimal(2), "p", 1, 1, 1, Decimal(1), Decimal(1), "S1"), (Decimal(3), "p", 1, 1, 1, Decimal(1), Decimal(1), "S1")]
    sales = spark.createDataFrame(keyed, f"sale_id decimal(38,0), sale_period string, product_key long, branch_key long, staff_key long, {ids}")
    known = spark.createDataFrame([(Decimal(3), "q"), (Decimal(4), "q")], "sale_id decimal(38,0), sale_period string")
    assert [tuple(r) for r in late.entries(sales, "sale_period", known).orderBy("sale_id").collect()] == [(1, "p", None, None, "S9"), (3, "p", None, None, None)]
    part = spark.createDataFrame([(Decimal(k), None, 1, 1, Decimal(2), None, None) for k in (1, 2)], "sale_id decimal(38,0), product_key long, branch_key long, staff_key long, volume_sold decimal(12,2), price decimal(12,2), revenue decimal(12,2)")
    fixes = spark.createDataFrame([(Decimal(1), 7, None, None, Decimal("2.50"))], "sale_id decimal(38,0), product_key long, branch_key long, staff_key long, product_price decimal(12,2)")
    for small in (False, True):
        got = late.apply(part, fixes, small).orderBy("sale_id").collect()
        assert [(r.product_key, r.price, r.revenue, r._repaired) for r in got] == [(7, Decimal("2.50"), Decimal("5.00"), True), (None, None, None, None)]


def test_waiting_entries_fold(spark, folder):
    from millrace.plans import late

    store = TableStore(spark, folder)
    schema = "sale_id decimal(38,0), sale_period string, product_id decimal(38,0), branch_id decimal(38,0), staff_id string"
    entry = lambda *data: spark.createDataFrame([(Decimal(i), "p", p and Decimal(p), None, None) for i, p in data], schema)
    waiting = late.Waiting(store, "f", "sale_period", max_runs=2)
    state = waiting.start(entry((1, 5), (2, 6)))
    state = waiting.add(state, entry((1, None), (3, 7)))
    assert state["runs"] == 1
    state = waiting.add(state, entry((2, 8)))
    assert state["runs"] == 0
    assert sorted((int(r["sale_id"]), int(r["product_id"])) for r in waiting.read(state).collect()) == [(2, 8), (3, 7)]


# -- holidays -----------------------------------------------------------------------------------------------


def test_holiday_source_without_optional_columns(spark):
    df = spark.createDataFrame(
        [("2024-06-01", " madaraka day", "Public", 2024), ("06/01/2024", "Madaraka Day ", " ", 2024), ("TBC", "x", None, 2024)],
        '"DATE" string'.replace('"', "") + ", HOLIDAY_NAME string, TYPE string, YEAR int",
    )
    got = holidays.holidays_clean(df).collect()
    assert len(got) == 1
    row = got[0]
    assert (row["holiday_name"], row["day_name"], row["is_weekend"], row["is_observed"]) == ("MADARAKA DAY", "Sat", True, False)
    assert row["local_name"] is None and (row["year"], row["month"], row["day"]) == (2024, 6, 1)


HOLIDAYS = "raw_holiday_date string, raw_observed_date string, raw_holiday_name string, raw_local_name string, raw_holiday_type string"
SAME = {c.split()[0]: c.split()[0] for c in HOLIDAYS.split(", ")}


def test_holiday_model_updates_only_what_differs(spark, folder):
    store = TableStore(spark, folder)

    def load(*data):
        holidays.run_model(store, spark.createDataFrame(data, HOLIDAYS), SAME)
        return {r["holiday_name"]: r.asDict() for r in store.read("holidays").collect()}, tuple(store.merge_counts("holidays").first())

    first, counts = load(("2024-01-01", None, "a", None, "Bank"), ("2024-01-02", None, "b", "x", None), ("2024-01-03", None, "c", None, "Bank"))
    assert counts == (3, 0, 0)
    second, counts = load(
        ("2024-01-01", "2024-01-02", "a", None, "Bank"),
        ("2024-01-02", None, "b", "changed", None),
        ("2024-01-04", None, "d", None, "Bank"),
    )
    assert counts == (1, 1, 0)
    assert second["A"]["is_observed"] and second["A"]["observed_date"] == dt.date(2024, 1, 2)
    assert second["A"][holidays.PROCESSED_AT] > first["A"][holidays.PROCESSED_AT]
    assert second["B"] == first["B"] and second["C"] == first["C"] and "D" in second


def test_holiday_dedupe_prefers_observed_then_latest(spark):
    df = spark.createDataFrame(
        [("2024-01-01", None, "a", None, "Bank"), ("2024-01-01", "2024-01-02", "A ", None, "Bank"), ("01/01/2024", "2024-01-03", "a", None, "Bank")],
        HOLIDAYS,
    )
    assert [r["observed_date"] for r in holidays.holidays_clean(df, SAME).collect()] == [dt.date(2024, 1, 3)]


def test_holiday_checks(spark, folder):
    good = holidays.holidays_clean(spark.createDataFrame([("2024-01-01", None, "a", None, "Bank")], HOLIDAYS), SAME)
    assert {r["failures"] for r in run_checks(good, holidays.CHECKS).collect()} == {0}
    bad = good.unionByName(good).withColumn("holiday_type", F.lit("Other"))
    found = {(r["test"], r["column"]): r["failures"] for r in run_checks(bad, holidays.CHECKS).collect()}
    assert found[("unique", "holiday_key")] == 1 and found[("accepted_values", "holiday_type")] == 2


def test_a_model_run_that_fails_a_check_is_not_published(spark, folder):
    store = TableStore(spark, folder)
    good = ("2024-01-01", None, "a", None, "Bank")
    holidays.run_model(store, spark.createDataFrame([good], HOLIDAYS), SAME)
    with pytest.raises(AuditFailed, match="accepted_values"):
        holidays.run_model(store, spark.createDataFrame([good, ("2024-01-02", None, "b", None, "Private")], HOLIDAYS), SAME)
    with pytest.raises(AuditFailed, match="holiday_name"):
        holidays.run_model(store, spark.createDataFrame([good, ("2024-01-02", None, None, None, "Bank")], HOLIDAYS), SAME)
    assert store.versions("holidays") == [1] and store.read("holidays").count() == 1
    assert [f[0]["failures"] for f in store.rejected("holidays").values()] == [1, 1]


def test_the_calendar_is_written_for_new_days_only(spark, folder):
    store = TableStore(spark, folder)
    day = lambda *days: star.stage_sales(
        store, sales_of(spark, *[(str(i), "1", "S1", "1", d, "1", "1", "1", "1") for i, d in enumerate(days)]), products_of(spark), "s"
    )
    versions = [star.write_calendar(store, day(*days), "s") for days in ([at(3), at(9)], [at(4), None], [None], [at(2)], [at(2)], [at(3, 2)])]
    assert versions == [1, 1, 1, 2, 2, 3]
    assert store.read("dim_date").count() == 33


def test_old_versions_of_the_fact_expire(spark, tmp_path, folder):
    store, zone, spec = TableStore(spark, f"{folder}/t"), LandingZone(spark, f"{folder}/r"), SPECS["sales"]
    dimensions(spark, store)
    source, products = tmp_path / "sales", products_of(spark)
    source.mkdir()
    for n in range(3):
        (source / f"{n}.csv").write_text(header(f"{n},1,S9,1,2024-0{n + 1}-05,1,1,1,1", f"7,1,S1,1,2024-0{n + 1}-06,{n},1,1,1"))
        zone.load(spec, str(source))
        assert merge_sales_delta(store, zone, spec, products)
    before = stored(store)
    for name in store.tables():
        store.expire(name, keep=1, grace=0)
    assert all(len(store.versions(n)) <= 2 for n in store.tables()) and stored(store) == before
    (source / "9.csv").write_text(header("7,1,S1,1,2024-05-06,9,1,1,1"))
    zone.load(spec, str(source))
    assert merge_sales_delta(store, zone, spec, products)
    assert stored(store) == [b for b in before if b[0] != 7] + [(7, "2024-05-06", 9.0)]


def test_schemas_are_valid_json(spark, folder):
    store = TableStore(spark, folder)
    store.create("t", star.FACT_SALES)
    assert len(json.loads(store.manifest("t").schema)["fields"]) == 10
