from __future__ import annotations

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.functions import hours_ago
from millrace.sources import SPECS, Field, LandingZone, LoadSpec, list_stage, read_csv, read_json, read_parquet, split
from millrace.sources.files import FILE
from millrace.streaming import auto_ingest
from millrace.streaming.ingest import EVERY_MINUTE

from .conftest import rows

SALES = """sale_id,branch_id,staff_id,product_id,sale_date,volume_sold,price,cost,revenue
1, 2 ,"S1, jr",3,2024-01-02 10:00:00,1.5,2.00,\\N,NULL
 2 ,7.5,S2,4,2024-01-03,2,,1.00,"3.00"
3,1,S3
4,1,S4,5,2024-01-04,1,1,1,1,surplus,more
5,1,S5,5,not a time,1,1,1,1
x6,1,S6,5,2024-01-05,1,1,1,1
"""


@pytest.fixture
def stage(tmp_path):
    return tmp_path


def write(path: Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".gz":
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)
    return str(path)


def test_csv_reading(spark, stage):
    write(stage / "sales" / "a.csv", SALES)
    got = read_csv(spark, str(stage / "sales"), SPECS["sales"].columns).drop(FILE)
    assert rows(got)[:4] == [
        ("1", "2", "S1, jr", "3", "2024-01-02 10:00:00", "1.5", "2.00", None, None),
        ("2", "7.5", "S2", "4", "2024-01-03", "2", None, "1.00", "3.00"),
        ("3", "1", "S3", None, None, None, None, None, None),
        ("4", "1", "S4", "5", "2024-01-04", "1", "1", "1", "1"),
    ]
    assert got.count() == 6


def test_csv_quotes_and_lines_in_fields(spark, stage):
    path = write(stage / "q.csv", 'a,b\n"say ""hi""","two\nlines"\n')
    assert rows(read_csv(spark, path, ["a", "b"], multi_line=True).drop(FILE)) == [('say "hi"', "two\nlines")]


ASSIGNMENTS = [
    {"staff_id": "S1", "branch_id": 1, "start_date": "2024-01-01", "end_date": "NaT"},
    {"staff_id": "S2", "branch_id": "2", "start_date": "2024-01-01 08:00:00", "end_date": "2024-02-30", "more": [1]},
    {"staff_id": "S3", "branch_id": 3, "start_date": "soon", "end_date": None},
    {"staff_id": "S4", "branch_id": 4, "start_date": "2024-01-01"},
]


def test_json_loading(spark, stage):
    write(stage / "in" / "a.json", json.dumps(ASSIGNMENTS[:2], indent=1))
    write(stage / "in" / "deep" / "b.json.gz", json.dumps(ASSIGNMENTS[2:]))
    write(stage / "in" / "c.txt", json.dumps(ASSIGNMENTS))
    spec = SPECS["staff_branch_assignments"]
    raw = read_json(spark, str(stage / "in"), spec.columns, spec.pattern)
    assert raw.count() == 4
    good, bad = split(raw, spec)
    assert [(r[0], r[1], str(r[2]), r[3]) for r in rows(good)] == [
        ("S1", 1, "2024-01-01 00:00:00", None),
        ("S2", 2, "2024-01-01 08:00:00", None),
        ("S4", 4, "2024-01-01 00:00:00", None),
    ]
    reject = bad.first()
    assert json.loads(reject["_raw"])["staff_id"] == "S3"
    assert reject["_error"] == "start_date: not a timestamp_ntz" and reject[FILE].endswith("deep/b.json.gz")
    assert list_stage(spark, str(stage / "in"), spec.pattern).count() == 2


def test_load_with_rejects_and_history(spark, stage, folder):
    write(stage / "sales" / "a.csv", SALES)
    zone, spec = LandingZone(spark, folder), SPECS["sales"]
    assert zone.table(spec).count() == 0 and zone.load_history(spec).count() == 0
    assert zone.load(spec, str(stage / "sales")) == 1
    assert [(int(r[0]), r[1]) for r in rows(zone.table(spec))] == [(1, 2), (2, 8), (3, 1), (4, 1)]
    assert rows(zone.rejected_rows(spec, hours_ago(2)).select("_error")) == [
        ("sale_date: not a timestamp_ntz",), ("sale_id: not a decimal(38,0)",)
    ]
    entry = zone.load_history(spec, hours_ago(2)).first()
    assert (entry["parsed"], entry["loaded"], entry["rejected"]) == (6, 4, 2)
    assert entry["first_error"] == "sale_date: not a timestamp_ntz" and entry["file"].endswith("a.csv")
    assert zone.load_history(spec, F.current_timestamp() + F.make_dt_interval(hours=F.lit(1))).count() == 0


def test_a_file_is_loaded_once(spark, stage, folder):
    zone, spec = LandingZone(spark, folder), SPECS["products"]
    write(stage / "p" / "with space.csv", "product_id,product_name,category,price\n1,a,b,2\n")
    assert zone.load(spec, str(stage / "p")) == 1 and zone.load(spec, str(stage / "p")) is None
    write(stage / "p" / "b.csv", "product_id,product_name,category,price\n2,c,d,3\n")
    assert zone.new_files(spec, str(stage / "p")).count() == 1
    assert zone.refresh(spec, str(stage / "p")) == 2
    assert zone.table(spec).count() == 2
    assert rows(zone.changes_since(spec, 1).select("product_id", "load_id")) == [("2", 2)]


def test_one_named_file(spark, stage, folder):
    zone, spec = LandingZone(spark, folder), SPECS["products"]
    for name in "ab":
        write(stage / "p" / f"{name}.csv", f"product_id,product_name,category,price\n{name},x,y,2\n")
    zone.load(spec, str(stage / "p" / "b.csv"))
    assert rows(zone.table(spec).select("product_id")) == [("b",)]


def test_abort_loads_nothing(spark, stage, folder):
    write(stage / "sales" / "a.csv", SALES)
    zone, spec = LandingZone(spark, folder), SPECS["sales"].with_options(on_error="abort")
    with pytest.raises(Exception, match="load of sales aborted"):
        zone.load(spec, str(stage / "sales"))
    assert zone.table(spec).count() == 0 and zone.last_load("sales") == 0
    # The number of the failed load is used again.
    assert zone.load(spec.with_options(on_error="continue"), str(stage / "sales")) == 1


def test_skip_file_drops_the_whole_file(spark, stage, folder):
    write(stage / "sales" / "bad.csv", SALES)
    write(stage / "sales" / "good.csv", SALES.split("5,1,S5")[0])
    zone, spec = LandingZone(spark, folder), SPECS["sales"].with_options(on_error="skip_file")
    zone.load(spec, str(stage / "sales"))
    assert zone.table(spec).count() == 4
    history = rows(zone.load_history(spec).select("parsed", "loaded", "rejected"))
    assert history == [(4, 4, 0), (6, 0, 2)]


def test_unknown_rule_and_format(spark, folder):
    with pytest.raises(ValueError, match="error rule"):
        split(spark.createDataFrame([("a", "b", "f")], "staff_id string, employee_id string, _file string"),
              SPECS["staff"].with_options(on_error="maybe"))
    with pytest.raises(ValueError, match="format"):
        LandingZone.reader(SPECS["staff"].with_options(format="xml"))


def test_identity_and_constraints(spark, stage, folder):
    zone, spec = LandingZone(spark, folder), SPECS["cities"].with_options(on_error="continue")
    names = [{"city_name": "Nairobi"}, {"city_name": "x" * 51}, {"other": 1}, {"city_name": "Nairobi"}]
    write(stage / "c" / "1.json", json.dumps(names))
    zone.load(spec, str(stage / "c"))
    write(stage / "c" / "2.json", json.dumps([{"city_name": "Mombasa"}]))
    zone.load(spec, str(stage / "c"))
    assert rows(zone.table(spec)) == [(1, "Nairobi"), (2, "Nairobi"), (3, "Mombasa")]
    assert rows(zone.rejected_rows(spec).select("_error")) == [("city_name: longer than 50",), ("city_name: missing",)]


@pytest.mark.parametrize("rule", ["continue", "skip_file"])
def test_text_that_is_no_json_is_rejected(spark, stage, folder, rule):
    lines = ['{"staff_id": "S1", "employee_id": "E1"}', '{"staff_id": "S2", ', '[{"staff_id": "S3"}, {"staff_id": "S4"}]', ""]
    write(stage / "s" / "a.json", "\n".join(lines))
    zone, spec = LandingZone(spark, f"{folder}/a"), SPECS["staff"].with_options(multi_line=False, on_error=rule)
    zone.load(spec, str(stage / "s"))
    want = [("S1", "E1"), ("S3", None), ("S4", None)]
    assert rows(zone.table(spec)) == (want if rule == "continue" else [])
    assert rows(zone.rejected_rows(spec).select("_error", "_raw")) == [("malformed record", lines[1])]
    assert read_json(spark, str(stage / "s"), spec.columns, multi_line=False).count() == 3
    streamed = LandingZone(spark, f"{folder}/b")
    run(streamed, spec, str(stage / "s"), f"{folder}/c")
    assert rows(streamed.table(spec)) == rows(zone.table(spec))


def test_parquet_source(spark, stage, folder):
    path = str(stage / "pq")
    spark.createDataFrame([(1, "a"), (2, "b")], "staff_id int, employee_id string").write.parquet(path)
    assert read_parquet(spark, path, ["staff_id"]).columns == ["staff_id"]
    spec = LoadSpec("people", "parquet", (Field("staff_id", "int"), Field("who", source="employee_id")), pattern=r".*\.parquet")
    zone = LandingZone(spark, folder)
    zone.load(spec, path)
    assert rows(zone.table(spec)) == [(1, "a"), (2, "b")]


def run(zone, spec, path, checkpoint, **options):
    auto_ingest(zone, spec, path, checkpoint, **options).awaitTermination()


def test_auto_ingest_reads_each_file_once_and_resumes(spark, stage, folder):
    zone, spec = LandingZone(spark, f"{folder}/raw"), SPECS["sales"]
    source, checkpoint = str(stage / "sales"), f"{folder}/checkpoint"
    write(stage / "sales" / "a.csv", SALES)
    run(zone, spec, source, checkpoint)
    run(zone, spec, source, checkpoint)
    assert zone.last_load("sales") == 1
    write(stage / "sales" / "b.csv", SALES.replace("S1, jr", "again"))
    run(zone, spec, source, checkpoint)
    assert zone.last_load("sales") == 2 and zone.table(spec).count() == 8
    batch = LandingZone(spark, f"{folder}/batch")
    batch.load(spec, source)
    assert rows(batch.table(spec)) == rows(zone.table(spec))


def test_a_replayed_batch_is_not_loaded_twice(spark, folder):
    zone, spec = LandingZone(spark, folder), SPECS["staff"]
    batch = spark.createDataFrame([("S1", "E1", "f")], "staff_id string, employee_id string, _file string")
    assert zone.write_load(spec, batch, "q#0") == 1
    assert zone.write_load(spec, batch, "q#0") is None
    # The same file under another label leaves nothing to load, and takes no number.
    assert zone.write_load(spec, batch, "q#1") is None
    assert zone.write_load(spec, batch.withColumn("_file", F.lit("g")), "q#2") == 2


def test_two_writers_lose_nothing(spark, folder, monkeypatch):
    """A second writer commits while the first one's rows are written, again and again."""
    spec = SPECS["staff"]
    one, two = LandingZone(spark, folder), LandingZone(spark, folder)
    data = lambda *names: spark.createDataFrame([(n, "E", f"file-{n}") for n in names], "staff_id string, employee_id string, _file string")
    real, pending = LandingZone._write_history, [("b", "c"), ("d",)]

    def and_then_another(self, *args, **options):
        real(self, *args, **options)
        if self is one and pending:
            two.write_load(spec, data(*pending.pop(0)))

    monkeypatch.setattr(LandingZone, "_write_history", and_then_another)
    # Both have file-b; the first writer notices and leaves it to the second.
    assert one.write_load(spec, data("a", "b"), files=["file-a", "file-b", "file-empty"]) == 3
    assert one.write_load(spec, data("e")) == 4
    assert sorted(r["staff_id"] for r in one.table(spec).collect()) == ["a", "b", "c", "d", "e"]
    loads = {r["file"]: r["load_id"] for r in one.load_history(spec).collect()}
    assert loads == {"file-b": 1, "file-c": 1, "file-d": 2, "file-a": 3, "file-empty": 3, "file-e": 4}
    assert sorted(r["staff_id"] for r in one.changes_since(spec, 2).collect()) == ["a", "e"]
    pending.append(("g",))
    assert one.write_load(spec, data("g"), files=["file-g"]) is None  # nothing left to load
    assert one.table(spec).filter("staff_id = 'g'").count() == 1


def test_sweep_removes_what_no_load_names(spark, folder, monkeypatch):
    spec, zone = SPECS["staff"], LandingZone(spark, folder)
    data = spark.createDataFrame([("S1", "E1", "f")], "staff_id string, employee_id string, _file string")
    zone.write_load(spec, data)
    monkeypatch.setattr(LandingZone, "_try_commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        zone.write_load(spec, data)
    monkeypatch.undo()
    assert zone.table(spec).count() == 1 and zone.load_history(spec).count() == 1
    assert zone.sweep(spec) == [] and len(zone.sweep(spec, grace=0)) == 2 and zone.sweep(spec, grace=0) == []
    assert zone.write_load(spec, data) == 2 and zone.table(spec).count() == 2


def test_two_writers_of_an_identity_column(spark, folder, monkeypatch):
    spec = SPECS["branches"]
    one, two = LandingZone(spark, folder), LandingZone(spark, folder)
    data = lambda *names: spark.createDataFrame([(n, "c", f"file-{n}") for n in names], "branch_name string, city_name string, _file string")
    real, pending = LandingZone._write_history, [("x", "y")]

    def and_then_another(self, *args, **options):
        real(self, *args, **options)
        if self is one and pending:
            two.write_load(spec, data(*pending.pop()))

    monkeypatch.setattr(LandingZone, "_write_history", and_then_another)
    one.write_load(spec, data("a", "b", "c"))
    one.write_load(spec, data("d"))
    assert sorted(r["branch_id"] for r in one.table(spec).collect()) == [1, 2, 3, 4, 5, 6]
    ids = {r["branch_name"]: r["branch_id"] for r in one.table(spec).collect()}
    assert {ids["x"], ids["y"]} == {1, 2} and ids["d"] == 6


def test_identity_reads_no_earlier_rows(spark, stage, folder):
    zone, spec = LandingZone(spark, folder), SPECS["branches"]
    write(stage / "b" / "1.json", json.dumps([{"branch_name": n, "city_name": "c"} for n in "abc"]))
    zone.load(spec, str(stage / "b"))
    from pathlib import Path

    first = list(Path(folder).glob("branches/rows/**/*.parquet"))
    contents = {f: f.read_bytes() for f in first}
    for f in first:
        f.write_bytes(b"spoilt")
    write(stage / "b" / "2.json", json.dumps([{"branch_name": "d", "city_name": "c"}]))
    zone.load(spec, str(stage / "b"))
    assert [r["branch_id"] for r in zone.changes_since(spec, 1).collect()] == [4]
    assert contents and zone._commit("branches", 2).highest == 4


def test_a_first_load_in_lots_goes_on_after_an_interruption(spark, stage, folder, monkeypatch):
    zone, spec = LandingZone(spark, folder), SPECS["staff"].with_options(multi_line=False)
    for i in range(23):
        write(stage / "s" / f"{i:02d}.json", json.dumps({"staff_id": f"S{i}", "employee_id": "E"}) if i else "\n")
    real, calls = LandingZone.write_load, []

    def breaks(self, *args, **options):
        if len(calls) == 2:
            raise RuntimeError("lost")
        calls.append(options["files"])
        return real(self, *args, **options)

    monkeypatch.setattr(LandingZone, "write_load", breaks)
    with pytest.raises(RuntimeError):
        zone.load(spec, str(stage / "s"), max_files=5)
    assert zone.last_load("staff") == 2 and all(len(c) == 5 for c in calls)
    monkeypatch.setattr(LandingZone, "write_load", real)
    assert zone.load(spec, str(stage / "s"), max_files=5) == 5
    assert zone.load(spec, str(stage / "s"), max_files=5) is None
    assert sorted(r["staff_id"] for r in zone.table(spec).collect()) == sorted(f"S{i}" for i in range(1, 23))
    assert zone.load_history(spec).count() == 23
    sizes = [len(lot) for lot in LandingZone(spark, f"{folder}/x")._lots(spec, str(stage / "s"), 100, 100)]
    assert sum(sizes) == 23 and max(sizes) <= 4  # 37 or 38 bytes a file, but one


def test_streamed_files_without_rows_enter_the_history(spark, stage, folder):
    zone, spec = LandingZone(spark, f"{folder}/raw"), SPECS["sales"]
    write(stage / "sales" / "a.csv", SALES)
    write(stage / "sales" / "empty.csv", SALES.splitlines()[0] + "\n")
    run(zone, spec, str(stage / "sales"), f"{folder}/checkpoint")
    write(stage / "sales" / "later.csv", SALES.splitlines()[0] + "\n")
    run(zone, spec, str(stage / "sales"), f"{folder}/checkpoint")
    history = {r["file"].rsplit("/", 1)[1]: (r["load_id"], r["parsed"]) for r in zone.load_history(spec).collect()}
    assert history["empty.csv"] == (1, 0) and history["later.csv"] == (2, 0) and len(history) == 3
    # Read again under another checkpoint: nothing is left, and no load is made.
    run(zone, spec, str(stage / "sales"), f"{folder}/checkpoint2")
    assert zone.last_load("sales") == 2


def test_a_stream_skips_a_bad_file_where_no_rule_is_given(spark, stage, folder):
    zone, spec = LandingZone(spark, f"{folder}/raw"), SPECS["cities"].with_options(multi_line=False)
    assert spec.on_error == "abort"
    write(stage / "c" / "bad.json", '{"city_name": "ok"}\n{"other": 1}')
    write(stage / "c" / "good.json", '{"city_name": "Nairobi"}')
    run(zone, spec, str(stage / "c"), f"{folder}/checkpoint")
    assert [r["city_name"] for r in zone.table(spec).collect()] == ["Nairobi"]


def test_scheduled_trigger(spark, stage, folder):
    zone, spec = LandingZone(spark, f"{folder}/raw"), SPECS["branches"]
    write(stage / "b" / "branches.json", json.dumps([{"branch_name": "One", "city_name": "Nairobi"}]))
    query = auto_ingest(zone, spec, str(stage / "b"), f"{folder}/checkpoint", EVERY_MINUTE)
    try:
        for _ in range(60):
            if query.lastProgress:
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    assert rows(zone.table(spec)) == [(1, "One", "Nairobi")]


def test_every_spec_names_its_columns_once():
    for spec in SPECS.values():
        assert len(set(spec.columns)) == len(spec.columns) and spec.on_error in ("abort", "continue")
