"""Feature matrix, labels and the band join on hand-made fixtures."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wrenchcast.operators import matrix as mx

E = dt.date(2024, 3, 10)


def _d(offset):
    return E + dt.timedelta(days=offset)


def _matrix(spark, asset, offsets):
    return spark.createDataFrame([(asset, _d(o), 1.0) for o in offsets],
                                 "asset_id string, day date, avg_sensor double")


def _events(spark, rows):
    return spark.createDataFrame(rows, "asset_id string, event_day date")


def test_label_boundary(spark):
    m = _matrix(spark, "XY-AAA", [-8, -7, -1, 0, 1])
    ev = _events(spark, [("XY-AAA", E)])
    got = {r.day: r.label for r in mx.label_within_horizon(m, ev).collect()}
    assert [got[_d(o)] for o in (-8, -7, -1, 0, 1)] == [0, 1, 1, 1, 0]


def test_label_without_today(spark):
    m = _matrix(spark, "XY-AAA", [-8, -7, -1, 0, 1])
    ev = _events(spark, [("XY-AAA", E)])
    got = {r.day: r.label for r in mx.label_within_horizon(m, ev, include_today=False).collect()}
    assert [got[_d(o)] for o in (-8, -7, -1, 0, 1)] == [0, 1, 1, 0, 0]


def test_label_fanout_keeps_one_row(spark):
    m = _matrix(spark, "XY-AAA", [0])
    ev = _events(spark, [("XY-AAA", _d(1)), ("XY-AAA", _d(3)), ("XY-AAA", _d(7))])
    out = mx.label_within_horizon(m, ev).collect()
    assert len(out) == 1 and out[0].label == 1


def test_label_other_asset_does_not_count(spark):
    m = _matrix(spark, "XY-AAA", [0])
    ev = _events(spark, [("XY-BBB", _d(1)), (None, _d(1))])
    assert mx.label_within_horizon(m, ev).first().label == 0


def _brute_band(mrows, erows, h):
    out = []
    for a, d, v in mrows:
        hits = [e for (b, e) in erows if b == a and e is not None and d <= e <= d + dt.timedelta(days=h)]
        out += [(a, d, v, e) for e in hits] or [(a, d, v, None)]
    return sorted(out, key=lambda r: (r[0], r[1], r[3] or dt.date.min))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(-12, 12)), min_size=1, max_size=25),
       st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(-12, 12)), max_size=25),
       st.integers(0, 9))
def test_band_join_equals_brute_force(spark, mrows, erows, h):
    mrows = sorted({(a, _d(o), float(o)) for a, o in mrows})
    erows = [(a, _d(o)) for a, o in erows]
    m = spark.createDataFrame(mrows, "asset_id string, day date, avg_sensor double")
    ev = spark.createDataFrame(erows, "asset_id string, event_day date")
    got = sorted(((r.asset_id, r.day, r.avg_sensor, r.event_day) for r in mx.band_join_left(m, ev, h).collect()),
                 key=lambda r: (r[0], r[1], r[3] or dt.date.min))
    assert got == _brute_band(mrows, erows, h)
    # One pair per chunk gives the same pairs.
    salted = sorted(((r.asset_id, r.day, r.avg_sensor, r.event_day)
                     for r in mx.band_join_left(m, ev, h, pairs_per_chunk=1).collect()),
                    key=lambda r: (r[0], r[1], r[3] or dt.date.min))
    assert salted == got
    # The label is the existence form of the same join, monotone in the horizon.
    lab = {(r.asset_id, r.day): r.label for r in mx.label_within_horizon(m, ev, h).collect()}
    lab_next = {(r.asset_id, r.day): r.label for r in mx.label_within_horizon(m, ev, h + 1).collect()}
    assert len(lab) == len(mrows)
    assert all(lab_next[k] >= v for k, v in lab.items())
    assert lab == {(a, d): int(any(x[3] is not None for x in got if x[0] == a and x[1] == d)) for a, d, _ in mrows}


def test_build_matrix_dedups_kpis_deterministically(spark):
    readings = spark.createDataFrame([("XY-AAA", E, 10.0), ("XY-AAA", E, 20.0), ("XY-AAA", _d(1), 5.0)],
                                     "asset_id string, day date, value double")
    kpis = spark.createDataFrame([("XY-AAA", E, 9.0, 3, 1), ("XY-AAA", E, 5.0, 2, 0)],
                                 "asset_id string, day date, flighthours double, flightcycles int, delayedminutes int")
    ev = _events(spark, [("XY-AAA", _d(2))])
    out = mx.build_matrix(readings, kpis, ev).collect()
    assert len(out) == 1  # day +1 has no KPI row: inner join drops it
    r = out[0]
    assert (r.avg_sensor, r.flighthours, r.flightcycles, r.delayedminutes, r.label) == (15.0, 5.0, 2, 0, 1)
    assert mx.build_matrix(readings, kpis, ev).columns == mx.MATRIX_COLUMNS


def test_build_matrix_observed_until(spark):
    readings = spark.createDataFrame([("A", _d(o), 1.0) for o in range(-10, 1)], "asset_id string, day date, value double")
    kpis = spark.createDataFrame([("A", _d(o), 1.0, 1, 0) for o in range(-10, 1)],
                                 "asset_id string, day date, flighthours double, flightcycles int, delayedminutes int")
    ev = _events(spark, [])
    out = mx.build_matrix(readings, kpis, ev, observed_until=E)
    assert out.agg(F.max("day")).first()[0] == _d(-7)


def test_first_row_per_key_handles_nulls(spark):
    df = spark.createDataFrame([("k", None, "x"), ("k", 1, "a"), ("j", 2, "b")], "key string, o int, v string")
    got = {r.key: (r.o, r.v) for r in mx.first_row_per_key(df, ["key"], ["o"]).collect()}
    assert got == {"k": (None, "x"), "j": (2, "b")}


def test_matrix_plan_has_no_band_join(spark):
    """The label join is an equi-join on (asset_id, day): no nested loop, no cartesian product."""
    from wrenchcast.plans.matrix_queries import feature_matrix
    from .conftest import SF_SMALL
    plan = feature_matrix(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def _log_matrix(log, h=7, include_today=True):
    et = F.col("kind")
    return mx.build_matrix_from_log(
        log, asset=F.col("asset"), day=F.col("d"), value=F.col("value"),
        is_reading=et != "err", is_kpi=et.isin("kpi", "kpi2"), is_interruption=(et == "err") & (F.col("value") >= 5),
        kpi_aggs={"flighthours": lambda k: F.sum(F.when(k, F.col("value"))),
                  "flightcycles": lambda k: F.sum(k.cast("int")).cast("int"),
                  "delayedminutes": lambda k: F.sum((k & (F.col("kind") == "kpi2")).cast("int")).cast("int")},
        horizon_days=h, include_today=include_today)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(-10, 10),
                          st.sampled_from(["read", "kpi", "kpi2", "err"]), st.integers(0, 9)), min_size=1, max_size=40),
       st.integers(0, 8), st.booleans())
def test_one_scan_matrix_equals_three_sources(spark, rows, h, include_today):
    log = spark.createDataFrame([(a, _d(o), k, float(v)) for a, o, k, v in rows],
                                "asset string, d date, kind string, value double")
    readings = log.where("kind <> 'err'").select(F.col("asset").alias("asset_id"), F.col("d").alias("day"), "value")
    kpis = (log.where("kind IN ('kpi', 'kpi2')").groupBy(F.col("asset").alias("asset_id"), F.col("d").alias("day"))
            .agg(F.sum("value").alias("flighthours"), F.count(F.lit(1)).cast("int").alias("flightcycles"),
                 F.sum((F.col("kind") == "kpi2").cast("int")).cast("int").alias("delayedminutes")))
    inter = log.where("kind = 'err' AND value >= 5").select(F.col("asset").alias("asset_id"), F.col("d").alias("event_day"))
    three = mx.build_matrix(readings, kpis, inter, h, include_today)
    one = _log_matrix(log, h, include_today)

    def norm(df):
        return sorted((r.asset_id, r.day, round(r.avg_sensor, 9), r.flighthours, r.flightcycles, r.delayedminutes,
                       r.label) for r in df.collect())
    assert norm(one) == norm(three)


def test_one_scan_matrix_plan(spark):
    from wrenchcast.plans.matrix_queries import feature_matrix
    from .conftest import SF_SMALL
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = feature_matrix(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_feature_matrix_unique_per_key_on_driver_tables(spark):
    from wrenchcast.plans.matrix_queries import feature_matrix, feature_matrix_sources
    for fn in (feature_matrix, feature_matrix_sources):
        m = fn(spark, "/root/testdata/sf0.01")
        assert m.count() == m.select("asset_id", "day").distinct().count() == 3282


def test_hot_asset_is_reduced_before_the_shuffle(spark):
    """One asset holds over a third of all log rows: the result is unchanged and
    the only exchange receives partial aggregates, not raw rows."""
    rows = [("HOT", _d(i % 20), ("read", "kpi", "err")[i % 3], float(i % 10)) for i in range(3000)]
    rows += [(f"A{i % 50}", _d(i % 20), ("read", "kpi", "kpi2", "err")[i % 4], float(i % 10)) for i in range(4000)]
    log = spark.createDataFrame(rows, "asset string, d date, kind string, value double").repartition(6)
    one = _log_matrix(log)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = one._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchange_at = plan.index("Exchange hashpartitioning(asset_id")
    assert "partial_sum" in plan[exchange_at:] and "partial_max" in plan[exchange_at:]
    hot = one.where("asset_id = 'HOT'").collect()
    assert len(hot) == 20 and all(r.label == 1 for r in hot)
    assert sum(r.flightcycles for r in hot) == 1000


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.one_of(st.none(), st.integers(-5, 5)),
                          st.sampled_from(["read", "kpi", "kpi2", "err"]), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=40))
def test_one_scan_daily_table_equals_two_sources(spark, rows):
    log = spark.createDataFrame([(a, None if o is None else _d(o), k, None if v is None else float(v))
                                 for a, o, k, v in rows], "asset string, d date, kind string, value double")
    et = F.col("kind")
    kpi_aggs = {"flighthours": lambda k: F.sum(F.when(k, F.col("value"))),
                "flightcycles": lambda k: F.sum(k.cast("int")).cast("int"),
                "delayedminutes": lambda k: F.sum((k & (F.col("kind") == "kpi2")).cast("int")).cast("int")}
    one = mx.daily_table_from_log(log, F.col("asset"), F.col("d"), F.col("value"), et.isin("read", "kpi", "kpi2"),
                                  et.isin("kpi", "kpi2"), kpi_aggs)
    readings = log.where("kind <> 'err'").select(F.col("asset").alias("asset_id"), F.col("d").alias("day"), "value")
    kpis = (log.where("kind IN ('kpi', 'kpi2')").groupBy(F.col("asset").alias("asset_id"), F.col("d").alias("day"))
            .agg(F.sum("value").alias("flighthours"), F.count(F.lit(1)).cast("int").alias("flightcycles"),
                 F.sum((F.col("kind") == "kpi2").cast("int")).cast("int").alias("delayedminutes")))
    two = mx.daily_table(readings, kpis)

    def norm(df):
        return sorted(((r.asset_id, r.day, None if r.avg_sensor is None else round(r.avg_sensor, 9), r.flighthours,
                        r.flightcycles, r.delayedminutes, r.has_sensor, r.has_kpi) for r in df.collect()), key=str)
    assert norm(one) == norm(two)


def test_empty_inputs_keep_schema(spark):
    readings = spark.createDataFrame([], "asset_id bigint, day date, value double")
    kpis = spark.createDataFrame([], "asset_id bigint, day date, flighthours double, flightcycles int, delayedminutes int")
    ev = spark.createDataFrame([], "asset_id bigint, event_day date")
    out = mx.build_matrix(readings, kpis, ev)
    assert out.isEmpty() and out.columns == mx.MATRIX_COLUMNS
    assert mx.label_days(ev, 0, include_today=False).schema["asset_id"].dataType.simpleString() == "bigint"
    m = spark.createDataFrame([(1, E, 1.0)], "asset_id bigint, day date, avg_sensor double")
    assert mx.label_within_horizon(m, ev, 0, include_today=False).first().label == 0
    assert mx.band_join_left(m, ev).first().event_day is None


def _plan_counts(df):
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("FileScan"), plan.count("Exchange ")


def test_band_join_plan_has_two_scans_and_four_exchanges(spark):
    from wrenchcast.plans.matrix_queries import join_band_left
    from .conftest import SF_SMALL
    limits = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scans, exchanges = _plan_counts(join_band_left(spark, SF_SMALL))
    finally:
        for k, v in limits.items():
            spark.conf.set(k, v)
    assert scans == 2 and exchanges <= 4


def test_band_join_repeats_a_hot_key(spark):
    m = spark.createDataFrame([("A", E, 1.0), ("B", E, 2.0)], "asset_id string, day date, avg_sensor double")
    ev = spark.range(50_000).select(F.lit("A").alias("asset_id"), F.lit(E).alias("event_day"))
    out = mx.band_join_left(m, ev, pairs_per_chunk=1000)
    assert {(r.asset_id, r["count"]) for r in out.groupBy("asset_id").count().collect()} == {("A", 50_000), ("B", 1)}


def test_unique_kpis_skip_the_dedup(spark):
    r = spark.createDataFrame([("A", E, 3.0)], "asset_id string, day date, value double")
    k = spark.createDataFrame([("A", E, 1.0, 2, 3)], "asset_id string, day date, flighthours double, "
                                                     "flightcycles int, delayedminutes int")
    ev = spark.createDataFrame([], "asset_id string, event_day date")
    assert mx.build_matrix(r, k, ev).collect() == mx.build_matrix(r, k, ev, unique_kpis=True).collect()


def test_dedup_when_key_is_every_column(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert sorted(map(tuple, mx.first_row_per_key(df, ["k", "v"]).collect())) == [(1, "a"), (2, "b")]


def test_band_join_chunks_equal_default_on_driver_tables(spark):
    from wrenchcast.plans import tables as tb
    from .conftest import SF_SMALL
    ev = tb.table(spark, SF_SMALL, "events")
    sensor = mx.daily_average(tb.readings(ev), tb.VALUE_SCALE)
    inter = tb.interruptions(ev)
    default = sorted(map(tuple, mx.band_join_left(sensor, inter).collect()), key=str)
    salted = sorted(map(tuple, mx.band_join_left(sensor, inter, pairs_per_chunk=1).collect()), key=str)
    assert salted == default and len(default) > 0


def test_flagship_scan_reads_only_needed_columns(spark):
    import contextlib
    import io
    import re
    from wrenchcast.plans.matrix_queries import feature_matrix
    from .conftest import SF_SMALL
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        feature_matrix(spark, SF_SMALL).explain("formatted")
    schemas = re.findall(r"ReadSchema: struct<(.*)>", buf.getvalue())
    assert len(schemas) == 1
    assert sorted(c.split(":")[0] for c in schemas[0].split(",")) == ["event_type", "ts", "user_id", "value"]
    assert "PushedFilters: [Or(" in buf.getvalue()


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.one_of(st.none(), st.integers(-6, 6)),
                          st.sampled_from(["read", "kpi", "kpi2", "err"]), st.one_of(st.none(), st.integers(0, 9))),
                min_size=1, max_size=40))
def test_one_scan_matrix_equals_three_sources_with_nulls(spark, rows):
    log = spark.createDataFrame([(a, None if o is None else _d(o), k, None if v is None else float(v))
                                 for a, o, k, v in rows], "asset string, d date, kind string, value double")
    readings = log.where("kind <> 'err'").select(F.col("asset").alias("asset_id"), F.col("d").alias("day"), "value")
    kpis = (log.where("kind IN ('kpi', 'kpi2')").groupBy(F.col("asset").alias("asset_id"), F.col("d").alias("day"))
            .agg(F.sum("value").alias("flighthours"), F.count(F.lit(1)).cast("int").alias("flightcycles"),
                 F.sum((F.col("kind") == "kpi2").cast("int")).cast("int").alias("delayedminutes")))
    inter = log.where("kind = 'err' AND value >= 5").select(F.col("asset").alias("asset_id"), F.col("d").alias("event_day"))
    # build_matrix joins on (asset_id, day): null keys never match, as in the one-scan form.
    three = mx.build_matrix(readings.where("asset_id IS NOT NULL AND day IS NOT NULL"),
                            kpis.where("asset_id IS NOT NULL AND day IS NOT NULL"), inter)
    one = _log_matrix(log)

    def norm(df):
        return sorted(((r.asset_id, r.day, None if r.avg_sensor is None else round(r.avg_sensor, 9), r.flighthours,
                        r.flightcycles, r.delayedminutes, r.label) for r in df.collect()), key=str)
    assert norm(one) == norm(three)


def test_band_join_null_assets_never_match(spark):
    m = spark.createDataFrame([(None, E, 1.0), ("A", E, 2.0)], "asset_id string, day date, avg_sensor double")
    ev = spark.createDataFrame([(None, E), ("A", _d(2)), ("A", _d(3))], "asset_id string, event_day date")
    for per_task in (1 << 20, 1):
        got = sorted(((r.asset_id, r.event_day) for r in mx.band_join_left(m, ev, pairs_per_chunk=per_task).collect()),
                     key=str)
        assert got == sorted([(None, None), ("A", _d(2)), ("A", _d(3))], key=str)
