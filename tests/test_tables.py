from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.audit import AuditFailed, write_checked
from millrace.operators import NotNull, Unique
from millrace.operators.merge import ACTION
from millrace.storage import sweep_work, work_folder
from millrace.tables import TableStore, last_step, log_details, log_step, log_summary

from .conftest import plan, rows


def test_versions_stay_readable(spark, folder):
    store = TableStore(spark, folder)
    assert not store.exists("t") and store.bookmark("t") is None
    with pytest.raises(LookupError):
        store.read("t")
    assert store.write(spark.range(3), "t", bookmark=4) == 1
    assert store.write(store.read("t").filter("id > 0"), "t") == 2
    assert store.versions("t") == [1, 2]
    assert store.read("t").count() == 2 and store.read("t", 1).count() == 3
    assert store.manifest("t", 1).bookmark == 4 and store.bookmark("t") is None


def test_a_write_that_fails_leaves_no_version(spark, folder):
    store = TableStore(spark, folder)
    store.write(spark.range(3), "t")
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        store.write(bad, "t")
    assert store.versions("t") == [1] and store.read("t").count() == 3


def test_only_one_writer_gets_a_version(spark, folder):
    store = TableStore(spark, folder)
    store.write(spark.range(1), "t")
    with pytest.raises(Exception, match="exist"):
        store._commit("t", store.manifest("t"))


def test_kept_partitions_are_not_rewritten(spark, folder):
    store = TableStore(spark, folder)
    first = spark.createDataFrame([(1, "a", "I"), (2, "b", "I"), (3, "c", "I")], f"id int, p string, {ACTION} string")
    store.write(first, "t", ["p"])
    before = store.manifest("t").partitions
    store.write(first.filter("p = 'b'").withColumn("id", F.lit(9)).withColumn(ACTION, F.lit("U")), "t", ["p"], keep_partitions=["a", "c"])
    after = store.manifest("t").partitions
    assert after["a"] == before["a"] and after["c"] == before["c"] and after["b"] != before["b"]
    assert rows(store.read("t")) == [(1, "a"), (3, "c"), (9, "b")]
    assert rows(store.read_partitions("t", ["b", "none"])) == [(9, "b")]
    assert tuple(store.merge_counts("t").first()) == (0, 1, 0)
    assert tuple(store.merge_counts("t", 1).first()) == (3, 0, 0)


def test_empty_tables(spark, folder):
    store = TableStore(spark, folder)
    store.create("t", "a int, b string")
    assert store.read("t").dtypes == [("a", "int"), ("b", "string")] and store.read("t").count() == 0
    assert store.read_or_empty("none", "x decimal(12,2)").dtypes == [("x", "decimal(12,2)")]
    store.write(spark.range(0).select("id", F.lit("x").alias("p")), "u", ["p"])
    assert store.read("u").count() == 0


def test_published_snapshot_does_not_follow(spark, folder):
    store, production = TableStore(spark, f"{folder}/a"), TableStore(spark, f"{folder}/b")
    store.write(spark.range(3), "t")
    store.publish(production, ["t"])
    store.write(spark.range(5), "t")
    assert production.read("t").count() == 3
    production.write(spark.range(1), "t")
    assert store.read("t").count() == 5
    assert store.publish(production, ["t"], copy=True) == {"t": 3}
    assert production.manifest("t").base.startswith(f"{folder}/b") and production.read("t").count() == 5


def test_log(spark, folder):
    store = TableStore(spark, folder)
    assert log_details(store).count() == 0
    counts = spark.createDataFrame([(1, 2, 0)], "rows_inserted long, rows_updated long, rows_deleted long")
    for day in (1, 3, 2):
        log_step(store, f"S{day}", counts, "note", F.lit(dt.datetime(2024, 1, day)))
    assert last_step(log_details(store)).first()["step_name"] == "S3"
    assert rows(log_summary(store).select("step_name", "rows_affected")) == [("S1", 3), ("S2", 3), ("S3", 3)]


def test_register_and_append(spark, folder):
    store = TableStore(spark, folder)
    store.write(spark.range(2), "t")
    store.register("t", "v_t")
    assert spark.table("v_t").count() == 2
    store.append(spark.range(2), "log")
    store.append(spark.range(3), "log")
    assert store.read_appended("log", "id long").count() == 5


def test_work_folder_is_below_the_shared_one(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_counts_come_from_the_write(spark, folder):
    store = TableStore(spark, folder)
    merged = spark.createDataFrame([(1, "I"), (2, "U"), (3, "K")], f"id int, {ACTION} string")
    store.write(merged, "t", observe={"large": F.count_if(F.col("id") > 1)})
    assert store.manifest("t").counts == {"rows": 3, "bytes": 3 * 41, "rows_I": 1, "rows_U": 1, "rows_D": 0, "large": 2}
    assert "FileScan" not in plan(store.merge_counts("t")) and tuple(store.merge_counts("t").first()) == (1, 1, 0)


def test_write_audit_publish(spark, folder):
    store, checks = TableStore(spark, folder), [Unique("id"), NotNull("p")]
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    assert write_checked(store, first, "t", checks, partition_by=["p"]) == 1
    with pytest.raises(AuditFailed, match=r"unique\(id\): 1") as failed:
        # The row clashes with one of a partition that is carried over.
        write_checked(store, spark.createDataFrame([(2, "a")], "id int, p string"), "t", checks, partition_by=["p"], keep_partitions=["b"])
    assert store.versions("t") == [1] and rows(store.read("t")) == [(1, "a"), (2, "b")]
    assert store.rejected("t") == {failed.value.mark: [{"test": "unique", "column": "id", "failures": 1}]}
    assert rows(store.read_rejected("t", failed.value.mark)) == [(2, "a"), (2, "b")]
    assert write_checked(store, spark.createDataFrame([(3, "a")], "id int, p string"), "t", checks, partition_by=["p"], keep_partitions=["b"]) == 2
    assert rows(store.read("t")) == [(2, "b"), (3, "a")]


def test_expire_keeps_what_a_kept_manifest_names(spark, folder):
    store, other = TableStore(spark, f"{folder}/a"), TableStore(spark, f"{folder}/b")
    frame = lambda *data: spark.createDataFrame(list(data), "id int, p string")
    store.write(frame((1, "a"), (2, "b"), (3, "c")), "t", ["p"])
    store.write(frame((4, "a")), "t", ["p"], keep_partitions=["b", "c"])
    store.publish(other, ["t"])
    store.write(frame((5, "b")), "t", ["p"], keep_partitions=["a"])
    store.write(frame((6, "a")), "t", ["p"], keep_partitions=["b"])
    store.prepare(frame((7, "z")), "t", ["p"])  # a write under way
    before = rows(other.read("t"))
    assert store.expire("t", keep=1) == []  # too young to tell from a write under way
    assert store.versions("t") == [4]
    swept = store.expire("t", keep=1, grace=0)
    assert rows(store.read("t")) == [(5, "b"), (6, "a")]
    assert rows(other.read("t")) == before == [(2, "b"), (3, "c"), (4, "a")]
    # Version 1 keeps its partitions b and c for the snapshot, and loses a; the prepared rows go.
    assert sorted(f.rsplit("/", 1)[1][:4] for f in swept) == ["_v=0", "p=a"]
    assert store.expire("t", keep=1, grace=0) == []
    with pytest.raises(ValueError):
        store.expire("t", keep=0)


def test_expire_keeps_versions_that_others_need(spark, folder):
    store = TableStore(spark, folder)
    for k in range(4):
        store.write(spark.range(k + 1), "side")
    store.write(spark.range(1), "main", extra={"needs": {"side": 2}})
    store.expire("side", keep=1, grace=0)
    assert store.versions("side") == [2, 4] and store.read("side", 2).count() == 2
    store.write(spark.range(1), "main", extra={"needs": {"side": 4}})
    store.expire("main", keep=1, grace=0)
    store.expire("side", keep=1, grace=0)
    assert store.versions("side") == [4]


def test_rejected_versions_are_forgotten_in_time(spark, folder):
    store = TableStore(spark, folder)
    marks = [store.reject(store.prepare(spark.range(2), "t"), [{"test": "x", "column": "id", "failures": 1}]) for _ in range(3)]
    store.write(spark.range(1), "t")
    assert len(store.expire("t", keep=1, grace=0)) == 2
    assert list(store.rejected("t")) == sorted(marks)[-1:] and store.read_rejected("t", sorted(marks)[-1]).count() == 2


def test_old_work_folders_are_swept(spark):
    path = work_folder(spark, "sweep")
    spark.range(1).write.parquet(path)
    assert path.rsplit("/", 1)[1] not in sweep_work(spark, 3_600)
    assert spark.read.parquet(path).count() == 1


def test_changes_read_only_folders_that_differ(spark, folder):
    store = TableStore(spark, folder)
    frame = lambda *data: spark.createDataFrame(list(data), "id int, v string, p string")
    store.write(frame((1, "x", "a"), (2, "x", "b"), (3, "x", "c"), (4, "x", "c")), "t", ["p"])
    store.write(frame((1, "x", "c"), (3, "y", "c"), (5, "x", "c")), "t", ["p"], keep_partitions=["b"])
    found = store.changes("t", 1, 2, ["id"])
    assert rows(found) == [(1, "x", "c", "update"), (3, "y", "c", "update"), (4, "x", "c", "delete"), (5, "x", "c", "insert")]
    assert not [f for f in found.inputFiles() if "/p=b/" in f]
    assert store.changes("t", 2, 2, ["id"]).count() == 0


def test_sizes_come_from_the_write(spark, folder):
    store = TableStore(spark, folder)
    store.write(spark.createDataFrame([("abc", 1), (None, 2)], "s string, p int"), "t")
    assert store.size("t") == (16 + 3 + 8 + 16) + (16 + 0 + 8 + 16)
    store.write(spark.range(2).select("id", (F.col("id") % 2).alias("p")), "u", ["p"])
    store.write(spark.range(1).select("id", F.lit(1).alias("p")), "u", ["p"], keep_partitions=["0"])
    assert store.size("u", 1) is not None and store.size("u") is None
