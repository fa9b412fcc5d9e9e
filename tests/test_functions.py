from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace import functions as fn


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("12.5", 13), ("-12.5", -13), (" 7 ", 7), ("x24", None), ("", None), (None, None), ("9" * 38, int("9" * 38)), ("9" * 39, None)],
)
def test_try_number(spark, text, want):
    assert one(spark, text, fn.try_number) == want


@pytest.mark.parametrize(
    ("text", "want"), [("1.005", "1.01"), ("-1.005", "-1.01"), ("12345678901", None), ("n/a", None), ("3", "3.00")]
)
def test_try_decimal(spark, text, want):
    assert one(spark, text, fn.try_decimal) == (None if want is None else Decimal(want))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("  nyali-beach ", "Nyali-Beach"),
        ("o'neil (ST. john)", "O'neil (St. John)"),
        ("a/b\\c|d", "A/B\\C|D"),
        ("3rd floor", "3rd Floor"),
        ("tab\there", "Tab\tHere"),
        ("élan vital", "Élan Vital"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(spark, text, want):
    assert one(spark, text, fn.title_case) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("2024-03-01", dt.date(2024, 3, 1)), ("03/09/2024", dt.date(2024, 3, 9)), ("TBC", None), (None, None), ("13/40/2024", None)],
)
def test_try_date_multi(spark, text, want):
    assert one(spark, text, fn.try_date_multi) == want


def test_weekends(spark):
    days = spark.createDataFrame([(dt.date(2024, 6, d),) for d in range(1, 9)] + [(None,)], "d date")
    got = days.select("d", fn.is_weekend_iso("d"), fn.is_weekend_sun0("d"), fn.day_name("d")).collect()
    for d, iso, sun0, name in got:
        if d is None:
            assert iso is None and sun0 is False and name is None
        else:
            assert iso == sun0 == (d.isoweekday() >= 6)
            assert name == d.strftime("%a")


def test_strict_casts_fail(spark):
    for f in (fn.cast_int, fn.cast_decimal, fn.cast_timestamp_ntz):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            one(spark, "bad", f)


def test_cast_int_rounds(spark):
    assert one(spark, "12.5", fn.cast_int) == 13


def test_timestamps(spark):
    assert one(spark, "2024-01-02 03:04:05", fn.cast_timestamp_ntz) == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, "NaT", fn.try_timestamp_ntz) is None


def test_md5_key(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), " new year "), (None, None)], "d date, n string")
    got = [r[0] for r in df.select(fn.md5_key("d", "n")).collect()]
    assert got == [hashlib.md5(t.encode()).hexdigest() for t in ("2024-01-01||NEW YEAR", "||")]


def test_hours_ago(spark):
    now, then = spark.range(1).select(F.current_timestamp(), fn.hours_ago(2)).first()
    assert now - then == dt.timedelta(hours=2)


def test_text_helpers(spark):
    assert one(spark, "  ", lambda c: fn.null_if(fn.trim_text(c), "")) is None
    assert one(spark, None, lambda c: fn.coalesce_default(c, "Public")) == "Public"
    assert one(spark, None, lambda c: fn.flag(c == "x")) is False
    assert one(spark, " ab ", fn.upper_text) == "AB"
