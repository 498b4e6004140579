"""Sources and sinks: sensor folder, CSV variants, JDBC on embedded Derby, writers, catalog."""

import os
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wrenchcast.operators.matrix import build_matrix
from wrenchcast.sources import files, jdbc, readings, sinks


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        fh.write(text)


def _sensor_file(folder, name, rows):
    body = "date;series;value\n" + "".join(f"{d};eventData;{v}\n" for d, v in rows)
    _write(os.path.join(folder, name), body)


@pytest.fixture()
def sensor_folder(tmp_path):
    folder = str(tmp_path / "sensors")
    # Crosses midnight: two (asset, day) groups from one file.
    _sensor_file(folder, "010615-QQX-QQY-0007-ZK-TAN.csv",
                 [("2015-06-01 23:50:00.000", "10.0"), ("2015-06-01 23:55:00.000", "20.0"),
                  ("2015-06-02 00:05:00.000", "30.0")])
    # Name carries a different date than its readings: the row's date wins.
    _sensor_file(folder, "300515-QQY-QQZ-0031-ZK-TAN.csv", [("2015-06-02 08:00:00.000", "50.0")])
    # Another aircraft, with one unparsable value.
    _sensor_file(folder, "020615-QQZ-QQY-0052-ZK-UMA.csv",
                 [("2015-06-02 10:00:00.000", "7.5"), ("2015-06-02 11:00:00.000", "n/a")])
    _write(os.path.join(folder, "notes.txt"), "not a sensor file")
    return folder


def test_sensor_folder_single_scan(spark, sensor_folder):
    df = readings.read_readings(spark, sensor_folder)
    got = {(r.asset_id, str(r.day)): r["avg_value"] for r in
           df.groupBy("asset_id", "day").agg(F.avg("value").alias("avg_value")).collect()}
    assert got == {("ZK-TAN", "2015-06-01"): 15.0, ("ZK-TAN", "2015-06-02"): 40.0, ("ZK-UMA", "2015-06-02"): 7.5}
    assert readings.bad_reading_count(spark, sensor_folder).first().bad_rows == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1


def test_sensor_folder_asset_filter(spark, sensor_folder):
    df = readings.read_readings(spark, sensor_folder, asset_id="ZK-UMA")
    assert {r.asset_id for r in df.collect()} == {"ZK-UMA"}


def test_reading_issues_by_reason(spark, sensor_folder):
    _sensor_file(sensor_folder, "odd.csv", [("2015-06-02 10:00:00.000", "1.0")])
    _sensor_file(sensor_folder, "x-020615-QQZ-QQY-0052-ZK-UMA.csv", [("2015-06-02 10:00:00.000", "bad")])
    _sensor_file(sensor_folder, "030615-QQZ-QQY-0053-ZK-UMA.csv", [("2015-06-31 10:00:00.000", "2.0"), ("", "3.0")])
    row = readings.reading_issues(spark, sensor_folder).first().asDict()
    assert row == {"n_rows": 10, "n_good": 5, "bad_file_name": 2, "bad_date": 2, "bad_value": 2}
    good = readings.read_readings(spark, sensor_folder)
    assert good.count() == 5 and {r.asset_id for r in good.collect()} == {"ZK-TAN", "ZK-UMA"}


def test_sensor_folder_empty_and_missing(spark, tmp_path):
    empty = tmp_path / "empty"
    empty.mkdir()
    for folder in (str(empty), str(tmp_path / "missing")):
        df = readings.read_readings(spark, folder)
        assert df.columns == ["asset_id", "day", "value"]
        assert df.isEmpty()


def test_matrix_from_sensor_files_and_tables(spark, sensor_folder):
    kpis = spark.createDataFrame([("ZK-TAN", "2015-06-01", 3.5, 2, 10)],
                                 "asset_id string, day string, flighthours double, flightcycles int, delayedminutes int") \
        .withColumn("day", F.col("day").cast("date"))
    events = spark.createDataFrame([("ZK-TAN", "2015-06-05")], "asset_id string, event_day string") \
        .withColumn("event_day", F.col("event_day").cast("date"))
    out = build_matrix(readings.read_readings(spark, sensor_folder), kpis, events).collect()
    assert len(out) == 1 and out[0].avg_sensor == 15.0 and out[0].label == 1


def test_csv_variants(spark, tmp_path):
    tab = str(tmp_path / "hangars.txt")
    _write(tab, "Hangar\tBay\tSite\tCode\r\nNorth wing\tN4\tQuay\tNWQ\r\n\"South, annex\"\t\tMoor\tSAM\r\n")
    df = files.read_csv(spark, tab, sep="\t", infer_schema=True)
    assert df.columns == ["Hangar", "Bay", "Site", "Code"]
    rows = {r.Code: r for r in df.collect()}
    assert rows["SAM"].Hangar == "South, annex" and rows["SAM"].Bay is None

    bank = str(tmp_path / "crew.csv")
    _write(bank, 'role;duty;points\n"lead";"off";12\n"the ""old"" hand";"on";-3\n')
    b = files.read_csv(spark, bank, sep=";", quote='"', escape='"', schema="role string, duty string, points int")
    assert sorted((r.role, r.points) for r in b.collect()) == [('lead', 12), ('the "old" hand', -3)]


def test_writers_and_readback(spark, tmp_path):
    df = spark.range(0, 100).select("id", (F.col("id") % 3).alias("g"))
    out = str(tmp_path / "csv")
    sinks.write_csv(df, out, num_files=5)
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == 5
    back = files.read_csv(spark, out, schema="id bigint, g bigint")
    assert back.count() == 100
    jout = str(tmp_path / "json")
    sinks.write_json(df, jout, num_files=2)
    assert spark.read.json(jout).count() == 100
    sinks.write_csv(df.limit(3), out)  # overwrite an existing folder
    assert files.read_csv(spark, out, schema="id bigint, g bigint").count() == 3


def test_matrix_round_trip(spark, tmp_path):
    m = spark.createDataFrame([("ZK-TAN", "2015-06-01", 1.5, 2.0, 3, 4, 1), ("ZK-UMA", "2015-07-02", 2.5, 1.0, 1, 0, 0)],
                              "asset_id string, day string, avg_sensor double, flighthours double, "
                              "flightcycles int, delayedminutes int, label int").withColumn("day", F.col("day").cast("date"))
    pq = str(tmp_path / "matrix")
    sinks.write_matrix(m, pq)
    assert {"month=2015-06", "month=2015-07"} <= set(os.listdir(pq))
    back = files.read_matrix(spark, pq)
    assert back.schema == m.schema and sorted(map(tuple, back.collect())) == sorted(map(tuple, m.collect()))
    csv = str(tmp_path / "matrix_csv")
    sinks.write_matrix_csv(m, csv)
    back_csv = files.read_matrix(spark, csv, fmt="csv")
    assert sorted(map(tuple, back_csv.collect())) == sorted(map(tuple, m.collect()))


def test_rows_to_frame(spark):
    data = [{"tail": "zk1", "legs": 7, "fuel": 0.25, "wet": False}, {"tail": "zk2", "legs": 9, "wet": True},
            {"tail": "zk3", "legs": 2, "fuel": 8.75}]
    df = files.rows_to_frame(spark, data)
    assert df.columns == ["tail", "legs", "fuel", "wet"]
    assert [r.fuel for r in df.collect()] == [0.25, None, 8.75]
    named = files.rows_to_frame(spark, [("zk9", 5)], ("tail", "legs"))
    assert named.columns == ["tail", "legs"]


def test_views_and_catalog(spark):
    df = spark.range(0, 3)
    sinks.register_view(df, "small_view")
    assert spark.sql("SELECT count(*) AS n FROM small_view;").first().n == 3
    info = sinks.catalog_overview(spark)
    assert "default" in info["databases"]
    assert ("small_view", "TEMPORARY", True) in info["tables"]
    assert sinks.describe_database(spark).count() > 0
    with pytest.raises(AnalysisException):
        spark.sql("INSERT INTO small_view VALUES (9)")


DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _pushed(df):
    """What the scans of a plan push down, in upper case."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return " ".join(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)).replace("*", "").upper()


def test_jdbc_on_embedded_derby(spark):
    url = "jdbc:derby:memory:wrenchcast;create=true"
    kpis = spark.createDataFrame(
        [(f"XY-{i % 4:03d}", f"2024-01-{1 + i % 20:02d}", float(i), i, i % 5, i) for i in range(40)],
        "aircraftid string, timeid string, flighthours double, flightcycles int, delayedminutes int, rowid int"
    ).withColumn("timeid", F.col("timeid").cast("date"))
    kpis.write.format("jdbc").options(url=url, dbtable="KPIS", createTableColumnTypes="aircraftid VARCHAR(16)",
                                      **DERBY).mode("overwrite").save()
    ev = spark.createDataFrame([("XY-001", "3453", "2024-01-05"), ("XY-001", "9999", "2024-01-06")],
                               "aircraftregistration string, subsystem string, starttime string")
    ev.write.format("jdbc").options(url=url, dbtable="EVENTS", **DERBY,
                                    createTableColumnTypes="aircraftregistration VARCHAR(16), subsystem VARCHAR(8), "
                                                           "starttime VARCHAR(32)").mode("overwrite").save()

    with pytest.raises(ValueError, match="one task"):
        jdbc.read_kpis(spark, url, DERBY, table="KPIS")
    whole = jdbc.read_kpis(spark, url, DERBY, table="KPIS", single_read=True)
    assert whole.count() == 40
    parallel = jdbc.read_kpis(spark, url, DERBY, table="KPIS", partition_column="ROWID", lower_bound=0,
                              upper_bound=40, num_partitions=4)
    assert parallel.rdd.getNumPartitions() == 4 and parallel.count() == 40
    one = jdbc.read_kpis(spark, url, DERBY, table="KPIS", asset_id="XY-001", day="2024-01-02")
    assert sorted(r.flighthours for r in one.collect()) == [1.0, 21.0]
    pushed = _pushed(one)
    assert "EQUALTO(AIRCRAFTID,XY-001)" in pushed and "EQUALTO(TIMEID,2024-01-02)" in pushed
    by_day = jdbc.read_kpis(spark, url, DERBY, table="KPIS", partition_column="TIMEID", lower_bound="2024-01-01",
                            upper_bound="2024-01-21", num_partitions=5)
    assert by_day.rdd.getNumPartitions() == 5 and sorted(by_day.collect()) == sorted(whole.collect())
    parts = jdbc.read_kpis(spark, url, DERBY, table="KPIS", predicates=['"delayedminutes" < 2', '"delayedminutes" >= 2'])
    assert parts.rdd.getNumPartitions() == 2 and sorted(parts.collect()) == sorted(whole.collect())
    inter = jdbc.read_interruptions(spark, url, DERBY, table="EVENTS", single_read=True).collect()
    assert [(r.asset_id, str(r.event_day)) for r in inter] == [("XY-001", "2024-01-05")]
    for first, last, n in (("2024-01-05", "2024-01-05", 1), ("2024-01-06", "2024-01-09", 0), ("2024-01-01", "2024-01-04", 0)):
        some = jdbc.read_interruptions(spark, url, DERBY, table="EVENTS", asset_id="XY-001", first_day=first, last_day=last)
        assert some.count() == n
        assert f"GREATERTHANOREQUAL(STARTTIME,{first})" in _pushed(some) and "LESSTHAN(STARTTIME," in _pushed(some)


def test_management_stage_from_files_and_jdbc(spark, sensor_folder, tmp_path):
    from wrenchcast.jobs import load_sources, run_management
    url = "jdbc:derby:memory:wrenchcast_jobs;create=true"
    kpis = spark.createDataFrame([("ZK-TAN", "2015-06-01", 3.5, 2, 10), ("ZK-TAN", "2015-06-02", 1.5, 1, 0),
                                  ("ZK-UMA", "2015-06-02", 2.0, 1, 5)],
                                 "aircraftid string, timeid string, flighthours double, flightcycles int, "
                                 "delayedminutes int").withColumn("timeid", F.col("timeid").cast("date"))
    kpis.write.format("jdbc").options(url=url, dbtable="UTIL", createTableColumnTypes="aircraftid VARCHAR(16)",
                                      **DERBY).mode("overwrite").save()
    ev = spark.createDataFrame([("ZK-TAN", "3453", "2015-06-08"), ("ZK-UMA", "1111", "2015-06-03")],
                               "aircraftregistration string, subsystem string, starttime string")
    ev.write.format("jdbc").options(url=url, dbtable="INTERRUPTS", **DERBY,
                                    createTableColumnTypes="aircraftregistration VARCHAR(16), subsystem VARCHAR(8), "
                                                           "starttime VARCHAR(32)").mode("overwrite").save()
    sources = load_sources(spark, sensor_folder, url, DERBY, url, DERBY, kpi_table="UTIL", event_table="INTERRUPTS",
                           kpi_partitioning={"single_read": True}, event_partitioning={"single_read": True})
    matrix = run_management(sources, str(tmp_path / "matrix"))
    got = {(r.asset_id, str(r.day)): (r.avg_sensor, r.label) for r in matrix.collect()}
    # 2015-06-01 + 7 = 2015-06-08: labelled; 06-02 too; the other subsystem's event does not count.
    assert got == {("ZK-TAN", "2015-06-01"): (15.0, 1), ("ZK-TAN", "2015-06-02"): (40.0, 1),
                   ("ZK-UMA", "2015-06-02"): (7.5, 0)}


def test_sensor_corpus_shape_single_scan(spark, tmp_path):
    """A folder shaped like the reference corpus (376 files, 5 to 49 readings
    each, 20 aircraft, files crossing midnight) read in one scan; the daily
    averages equal a plain-Python computation over the same files."""
    import datetime as dt
    import random
    import time

    from wrenchcast.operators.matrix import daily_average

    rnd = random.Random(7)
    folder = str(tmp_path / "corpus")
    expected = {}
    for i in range(376):
        aircraft = f"XY-{chr(65 + i % 20)}{chr(65 + (i * 7) % 26)}Z"
        start = dt.datetime(2015, 1, 1) + dt.timedelta(days=rnd.randrange(130), hours=rnd.randrange(24))
        rows = []
        for k in range(rnd.randint(5, 49)):
            ts = start + dt.timedelta(minutes=10 * k)
            v = round(rnd.uniform(2.0, 83.0), 2)
            rows.append((ts.strftime("%Y-%m-%d %H:%M:%S.000"), f"{v}"))
            expected.setdefault((aircraft, ts.date()), []).append(v)
        _sensor_file(folder, f"{start:%d%m%y}-AAA-BBB-{i:04d}-{aircraft}.csv", rows)
    t0 = time.perf_counter()
    got = {(r.asset_id, r.day): r.avg_sensor
           for r in daily_average(readings.read_readings(spark, folder), value_scale=2).collect()}
    elapsed = time.perf_counter() - t0
    assert set(got) == set(expected)
    assert all(abs(got[k] - sum(v) / len(v)) < 1e-6 for k, v in expected.items())
    print(f"corpus: {len(expected)} groups from 376 files in {elapsed:.2f} s")


def test_append_table_adds_rows(spark, tmp_path):
    path = str(tmp_path / "appended")
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    sinks.append_table(first, path)
    sinks.append_table(spark.createDataFrame([(2, "b")], "k int, v string"), path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b")]


def test_sensor_folder_recursive(spark, tmp_path):
    root = str(tmp_path / "nested")
    _sensor_file(os.path.join(root, "2015-06-01"), "010615-QQX-QQY-0007-ZK-TAN.csv", [("2015-06-01 10:00:00.000", "1.0")])
    _sensor_file(os.path.join(root, "2015-06-02"), "020615-QQX-QQY-0008-ZK-TAN.csv", [("2015-06-02 10:00:00.000", "3.0")])
    assert readings.read_readings(spark, root).isEmpty()
    got = sorted((str(r.day), r.value) for r in readings.read_readings(spark, root, recursive=True).collect())
    assert got == [("2015-06-01", 1.0), ("2015-06-02", 3.0)]


def test_matrix_reload_prunes_months(spark, tmp_path):
    m = spark.createDataFrame([("A", f"2015-{mo:02d}-10", 1.0, 1.0, 1, 0, 0) for mo in range(1, 7)],
                              "asset_id string, day string, avg_sensor double, flighthours double, "
                              "flightcycles int, delayedminutes int, label int").withColumn("day", F.col("day").cast("date"))
    pq = str(tmp_path / "matrix")
    sinks.write_matrix(m, pq)
    part = files.read_matrix(spark, pq, days=("2015-02-01", "2015-03-31"))
    assert sorted(str(r.day) for r in part.collect()) == ["2015-02-10", "2015-03-10"]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_jdbc_properties_form_equals_options_form(spark):
    url = "jdbc:derby:memory:wrenchcast_forms;create=true"
    df = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "rowid int, v string")
    df.write.format("jdbc").options(url=url, dbtable="T", createTableColumnTypes="v VARCHAR(8)", **DERBY) \
        .mode("overwrite").save()
    a = jdbc.read_table(spark, url, "T", DERBY, "ROWID", 0, 20, 4, form="options")
    b = jdbc.read_table(spark, url, "T", DERBY, "ROWID", 0, 20, 4, form="properties")
    assert a.rdd.getNumPartitions() == b.rdd.getNumPartitions() == 4
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() == 20
    assert jdbc.read_table(spark, url, "T", DERBY, form="properties", single_read=True).count() == 20


def test_matrix_for_one_record(spark, sensor_folder):
    from wrenchcast.jobs import matrix_for_record
    url = "jdbc:derby:memory:wrenchcast_record;create=true"
    kpis = spark.createDataFrame([("ZK-TAN", "2015-06-01", 3.5, 2, 10), ("ZK-TAN", "2015-06-02", 1.5, 1, 0)],
                                 "aircraftid string, timeid string, flighthours double, flightcycles int, "
                                 "delayedminutes int").withColumn("timeid", F.col("timeid").cast("date"))
    kpis.write.format("jdbc").options(url=url, dbtable="UTIL", createTableColumnTypes="aircraftid VARCHAR(16)",
                                      **DERBY).mode("overwrite").save()
    ev = spark.createDataFrame([("ZK-TAN", "3453", "2015-06-09")],
                               "aircraftregistration string, subsystem string, starttime string")
    ev.write.format("jdbc").options(url=url, dbtable="INTERRUPTS", **DERBY,
                                    createTableColumnTypes="aircraftregistration VARCHAR(16), subsystem VARCHAR(8), "
                                                           "starttime VARCHAR(32)").mode("overwrite").save()
    one = matrix_for_record(spark, sensor_folder, url, DERBY, url, DERBY, "ZK-TAN", "2015-06-02",
                            kpi_table="UTIL", event_table="INTERRUPTS")
    rows = one.collect()
    # 2015-06-02: readings 30 and 50 (two files, one crossing midnight), event on 06-09 = day + 7.
    assert [(r.asset_id, str(r.day), r.avg_sensor, r.flighthours, r.label) for r in rows] == \
        [("ZK-TAN", "2015-06-02", 40.0, 1.5, 1)]
    pushed = _pushed(one)
    assert "EQUALTO(TIMEID,2015-06-02)" in pushed
    assert "GREATERTHANOREQUAL(STARTTIME,2015-06-02)" in pushed and "LESSTHAN(STARTTIME,2015-06-10)" in pushed
