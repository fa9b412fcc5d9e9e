from __future__ import annotations

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.operators import joins, keys
from millrace.operators.merge import ACTION

from .conftest import plan, rows

# -- first_per_key ----------------------------------------------------------------------------------


def test_first_per_key_settles_ties_and_keeps_the_null_group(spark):
    data = [(1, "b", 2), (1, "a", 2), (1, "a", 1), (None, "z", 1), (None, "y", 1), (2, None, 5), (2, "k", 5)]
    for seed in range(3):
        shuffled = data[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k int, a string, b int").repartition(3)
        got = op.first_per_key(df, ["k"], [F.col("b").desc_nulls_last()])
        assert rows(got) == [(1, "a", 2), (2, "k", 5), (None, "y", 1)]


def test_first_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(op.first_per_key(df, ["k"], [F.col("id").desc()]))
    assert "Partial" in text and text.count("Exchange hashpartitioning") == 1


# -- lookup -----------------------------------------------------------------------------------------


def hot_sides(spark):
    """A third of the rows on one key, another hot key without a match, NULL keys, equal copies."""
    left = [(7, i) for i in range(400)] + [(99, i) for i in range(100)] + [(None, i) for i in range(150)]
    left += [(i % 50, i) for i in range(500)] + [(7, 0)] * 50
    right = [(i, f"n{i}") for i in range(0, 60, 2)] + [(7, "hot"), (None, "never")]
    return (
        spark.createDataFrame(left, "k int, v int").repartition(8),
        spark.createDataFrame(right, "id int, name string"),
        left,
        {k: n for k, n in right if k is not None},
    )


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_lookup_is_whole_on_both_ways(spark, how, limit, monkeypatch):
    monkeypatch.setattr(joins, "HOT_KEYS", 3)
    left, right, data, names = hot_sides(spark)
    got = op.lookup(left, right, "k", "id", ["name"], how, max_broadcast_bytes=limit)
    want = [(k, v, names.get(k)) for k, v in data if how == "left" or k in names]
    assert rows(got) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_lookup_does_not_shuffle_the_left_side_of_a_small_lookup(spark):
    left, right, *_ = hot_sides(spark)
    assert "SortMergeJoin" not in plan(op.lookup(left, right, "k", "id", ["name"]))


def test_large_lookups_read_the_left_side_once(spark, monkeypatch, folder):
    monkeypatch.setattr(joins, "HOT_KEYS", 3)
    left, right, *_ = hot_sides(spark)
    left.write.parquet(folder)
    joined = spark.read.parquet(folder)
    for name in ("one", "two", "three"):
        joined = op.lookup(joined, right.withColumnRenamed("name", name), "k", "id", [name], max_broadcast_bytes=0)
    text = plan(joined)
    assert text.count("FileScan parquet") == 1 and text.count("SortMergeJoin") == 3


def test_lookup_with_repeated_right_keys_multiplies_rows(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "id int, n string")
    for limit in (joins.BROADCAST_BYTES, 0):
        assert rows(op.lookup(left, right, "k", "id", ["n"], max_broadcast_bytes=limit)) == [(1, "a"), (1, "b"), (2, None)]


def test_fits_broadcast_measures_text(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert op.fits_broadcast(df, 200_000) and not op.fits_broadcast(df, 100_000)


# -- assign_keys --------------------------------------------------------------------------------------


def expected_numbers(values, start=0):
    def digest(row):
        return hashlib.md5("\x1f".join("" if v is None else str(v) for v in row).encode()).hexdigest()

    ordered = sorted(values, key=lambda r: (digest(r), tuple((v is not None, v) for v in r)))
    return [(start + i, *r) for i, r in enumerate(ordered, 1)]


@pytest.mark.parametrize("chunk", [100_000, 7])
def test_assign_keys_numbers_densely_in_digest_order(spark, chunk, monkeypatch):
    monkeypatch.setattr(keys, "COPIES_PER_TASK_ROW", chunk)
    values = [(i, f"n{i}") for i in range(300)] + [(5, "n5")] * 40 + [(None, "x")] * 3 + [(None, None), (1, "")]
    df = spark.createDataFrame(values, "a int, b string").repartition(5)
    got = [tuple(r) for r in op.assign_keys(df, "key", start=10).orderBy("key").collect()]
    assert got == expected_numbers(values, 10)


def test_assign_keys_goes_on_from_a_table(spark):
    table = spark.createDataFrame([(41,), (7,)], "key int")
    df = spark.createDataFrame([("a",), ("b",)], "n string")
    assert sorted(r[0] for r in op.assign_keys(df, "key", start=op.max_key(table, "key")).collect()) == [42, 43]
    assert op.assign_keys(df.limit(0), "key").count() == 0


# -- merge ---------------------------------------------------------------------------------------------

WAYS = [
    {},
    {"max_broadcast_bytes": 0},
    {"max_broadcast_bytes": 0, "unique_source": True},
]
SCHEMA = "k int, a string, b string"


def model_merge(target, source, insert_nulls):
    """What a merge on k does when a is updated for sources whose b is not 'skip'."""
    known = {r[0]: r for r in target if r[0] is not None}
    new = {r[0]: r for r in source if r[0] is not None}
    out = []
    for r in target:
        s = new.get(r[0]) if r[0] is not None else None
        out.append((r[0], s[1], r[2], "U") if s and s[2] != "skip" else (*r, "K"))
    out += [(*s, "I") for s in source if (s[0] is None and insert_nulls) or (s[0] is not None and s[0] not in known)]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("null_keys", ["insert", "drop"])
def test_merge_against_a_model(spark, way, null_keys):
    rnd = random.Random(4)
    target = [(k, f"t{k}", "old") for k in rnd.sample(range(200), 120)] + [(None, "tn", "old")] * 2
    source = [(k, f"s{k}", rnd.choice(["skip", "go"])) for k in rnd.sample(range(200), 90)] + [(None, "sn", "go")] * 3
    merged = op.merge(
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), ["k"], ["a"],
        when=lambda t, s: s("b") != "skip", null_keys=null_keys, **way,
    )
    assert merged.columns == ["k", "a", "b", ACTION]
    assert rows(merged) == model_merge(target, source, null_keys == "insert")
    counts = op.merge_counts(merged).first()
    actions = [r[3] for r in model_merge(target, source, null_keys == "insert")]
    assert tuple(counts) == (actions.count("I"), actions.count("U"), 0)


@pytest.mark.parametrize("way", WAYS)
def test_merge_inserts_only_the_listed_columns(spark, way):
    target = spark.createDataFrame([(1, "a", "b")], SCHEMA)
    source = spark.createDataFrame([(2, "c", "d")], SCHEMA)
    got = op.merge(target, source, ["k"], ["a"], insert=["k", "a"], **way)
    assert rows(got) == [(1, "a", "b", "K"), (2, "c", None, "I")]


@pytest.mark.parametrize("way", WAYS)
def test_two_source_rows_for_one_target_row_fail(spark, way):
    target = spark.createDataFrame([(1, "a", "b")], SCHEMA)
    source = spark.createDataFrame([(1, "x", "y"), (1, "z", "y")], SCHEMA)
    with pytest.raises(Exception, match="several source rows match one target row"):
        op.merge(target, source, ["k"], ["a"], **way).collect()


@pytest.mark.parametrize("way", WAYS)
def test_repeated_source_keys_without_a_match_are_all_inserted(spark, way):
    target = spark.createDataFrame([(1, "a", "b")], SCHEMA)
    source = spark.createDataFrame([(2, "x", "y"), (2, "z", "y"), (2, "z", "y")], SCHEMA)
    assert op.merge(target, source, ["k"], ["a"], **way).filter("k = 2").count() == 3


@pytest.mark.parametrize("way", [{}, {"max_broadcast_bytes": 0}])
def test_merge_with_surrogate_keeps_old_and_numbers_new(spark, way):
    target = spark.createDataFrame([(5, 1, "a")], "key int, k int, a string")
    source = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (None, "N")], "k int, a string")
    got = op.merge(target, source, ["k"], ["a"], surrogate="key", **way)
    assert sorted(r["key"] for r in got.collect()) == [5, 6, 7, 8]
    assert rows(got.drop("key")) == [(1, "A", "U"), (2, "B", "I"), (3, "C", "I"), (None, "N", "I")]


def test_small_merge_does_not_shuffle_the_target(spark, folder):
    spark.range(1000).select("id", F.lit("t").alias("a")).write.parquet(f"{folder}/t")
    target = spark.read.parquet(f"{folder}/t")
    source = spark.range(500, 510).select("id", F.lit("s").alias("a"))
    text = plan(op.merge(target, source, ["id"], ["a"], null_keys="drop"))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 2


def test_merge_rejects_an_unknown_option(spark):
    df = spark.createDataFrame([(1, "a", "b")], SCHEMA)
    with pytest.raises(ValueError, match="null_keys"):
        op.merge(df, df, ["k"], ["a"], null_keys="keep")


# -- calendar, changes, shaping, checks ------------------------------------------------------------------


def test_date_series(spark):
    def series(a, b):
        return [r[0] for r in op.date_series(spark.createDataFrame([(a, b)], "min_d date, max_d date")).collect()]

    day = dt.date(2024, 2, 28)
    assert series(day, dt.date(2024, 3, 1)) == [day, dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert series(None, None) == [] and series(dt.date(2024, 3, 1), day) == []
    assert len(series(dt.date(1500, 1, 1), dt.date(2024, 1, 1))) == (dt.date(2024, 1, 1) - dt.date(1500, 1, 1)).days + 1


def test_table_changes(spark):
    schema = "k int, a string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None)], schema)
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (5, "e")], schema)
    assert rows(op.table_changes(old, new, ["k"])) == [(2, "B", "update"), (4, None, "delete"), (5, "e", "insert")]
    assert not op.has_changes(op.table_changes(old, old, ["k"]))


def test_shaping(spark):
    df = spark.createDataFrame([("7", "x", '{"k": 1}'), ("8", None, "broken")], "a string, b string, j string")
    assert op.project_fields(df, {"n": ("a", "int")}).dtypes == [("n", "int")]
    assert rows(op.project_positions(df, [(1, "int", "n")])) == [(7,), (8,)]
    assert rows(op.project_json(df, "j", {"k": ("k", "int")}, ["a"])) == [("7", 1), ("8", None)]
    assert op.rename_passthrough(df, {"raw_a": "a", "B": "b"}).columns == ["raw_a", "B", "a", "j"]
    assert op.null_placeholder(df, {"z": "date", "A": "int"}).dtypes[-1] == ("z", "date")
    assert rows(op.required_key_filter(df, "b").select("a")) == [("7",)]
    assert rows(op.upper_bound_filter(df, "a", F.lit("7")).select("a")) == [("7",)]
    assert [r["a"] for r in op.preview(df, 1, [F.col("a").desc()]).collect()] == ["8"]


def test_checks_find_each_failure(spark):
    data = [
        ("k1", "2024-01-01", "Public", "a"), ("k1", None, "Bank", "b" * 51), (None, "2024-01-02", "Other", "c"), ("k2", "x", None, None),
    ]
    df = spark.createDataFrame(data, "k string, d string, t string, n string")
    assert rows(op.check_unique(df, "k")) == [("k1", 2)]
    assert op.check_not_null(df, "d").count() == op.check_accepted_values(df, "t", ["Public", "Bank"]).count() == 1
    assert op.check_max_length(df, "n", 50).count() == 1
    checks = [op.Unique("k"), op.NotNull("d"), op.NotNull("k"), op.AcceptedValues("t", ("Public", "Bank")), op.MaxLength("n", 50)]
    assert rows(op.run_checks(df, checks)) == [
        ("accepted_values", "t", 1), ("max_length", "n", 1), ("not_null", "d", 1), ("not_null", "k", 1), ("unique", "k", 1)
    ]
