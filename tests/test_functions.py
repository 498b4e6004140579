"""Scalar Column helpers against plain-Python statements of the same rules."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wrenchcast.functions import scalar as sc


def _py_valid(day: str, aircraft: str) -> bool:
    d = day.split("-")
    a = aircraft.split("-")
    return (len(d) == 3 and [len(p) for p in d] == [4, 2, 2]
            and len(a) == 2 and [len(p) for p in a] == [2, 3])


TEXT = st.text(alphabet="20X5-AB1\n .", max_size=12)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=30))
def test_valid_request_matches_split_rule(spark, pairs):
    pairs += [("2024-01-05", "ZK-TAN"), ("20X5-AA-01", "ZK-TAN"), ("2024/01/05", "ZK-TAN"), ("2024-01-05", "XYZ-SH")]
    df = spark.createDataFrame(pairs, "day string, asset string")
    got = [(r.day, r.asset, r.ok) for r in df.select("day", "asset", sc.valid_request("day", "asset").alias("ok")).collect()]
    assert all(ok == _py_valid(d, a) for d, a, ok in got)


def _py_asset(name: str) -> str | None:
    parts = name.removesuffix(".csv").split("-")
    good = len(parts) == 6 and all(parts) and name.endswith(".csv") and (len(parts[4]), len(parts[5])) == (2, 3)
    return "-".join(parts[4:]) if good else None


PART = st.text(alphabet="ABCXYZ0123", min_size=1, max_size=5)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(PART, min_size=6, max_size=7), min_size=1, max_size=20))
def test_asset_from_file_name_matches_split_rule(spark, names):
    files = [*("-".join(p) + ".csv" for p in names), *("-".join([*p[:4], "ZK", "TAN"]) + ".csv" for p in names),
             "odd.csv", "a-b-c-d-ZK.csv", "a-b-c-d-ZK-TAN.CSV", "a-b-c-d-ZK-TAN.csv.csv", "a-b-c--ZK-TAN.csv"]
    df = spark.createDataFrame([(f,) for f in files], "name string")
    got = {r.name: r.asset for r in df.select("name", sc.asset_from_file_name("name").alias("asset")).collect()}
    assert got == {f: _py_asset(f) for f in files}


def test_dates_and_predictions(spark):
    df = spark.createDataFrame([("2015-06-01 23:50:00.000", 0.0), ("bad", 1.0), (None, None)], "ts string, p double")
    rows = df.select(sc.parse_date(sc.day_text("ts")).alias("d"), sc.decode_prediction("p").alias("t")).collect()
    assert [(r.d, r.t) for r in rows] == [(dt.date(2015, 6, 1), "No maintenance"), (None, "Maintenance"), (None, None)]
    assert not df.select(sc.strict_day_text(F.lit("20X5-AA-01"))).first()[0]


def test_exact_sum_is_order_independent(spark):
    vals = [0.1 * i for i in range(1, 200)] + [1e6 + 0.01, -1e6]
    a = spark.createDataFrame([(round(v, 2),) for v in vals], "v double").repartition(7)
    b = spark.createDataFrame([(round(v, 2),) for v in reversed(vals)], "v double").repartition(3)
    assert a.agg(sc.exact_sum("v", 2)).first()[0] == b.agg(sc.exact_sum("v", 2)).first()[0]
    assert a.select(sc.hash_bucket("v", 10).alias("b")).where("b < 0 OR b >= 10").count() == 0


def test_fast_day_parse_equals_pattern_parse(spark):
    vals = ["2024-01-05", "2024-02-30", "2024-13-01", "+024-01-05", " 024-01-05", "0000-01-01", "2024-1-05",
            "20X5-AA-01", "2024-01-05 ", "9999-12-31", "2024-02-29", "2023-02-29", None]
    df = spark.createDataFrame([(v,) for v in vals], "d string")
    rows = df.select(sc.parse_date("d").cast("string").alias("a"), sc.parse_iso_day("d").cast("string").alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_exact_sum_never_wraps(spark):
    big = spark.range(3).select(F.lit(9.2e16).alias("v"))  # 9.2e18 cents each: the sum overflows a long
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert big.agg(sc.exact_sum("v", 2)).first()[0] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    import pytest
    with pytest.raises(Exception):
        big.agg(sc.exact_sum("v", 2)).collect()
