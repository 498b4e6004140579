"""Versioned stored tables, observed reading counts and exit requests."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from wrenchcast import jobs
from wrenchcast.jobs import Sources, run_management
from wrenchcast.sources import readings
from wrenchcast.sources.files import read_matrix
from wrenchcast.sources.store import MatrixStore
from wrenchcast.streaming import score as stream

FILES = {"010615-AAA-BBB-0001-ZK-TAN.csv": [("2015-06-01 10:00:00", "10"), ("2015-06-01 11:00:00", "20"), ("x", "5"),
                                            ("2015-06-02 01:00:00", "abc")],
         "010615-AAA-BBB-0002-ZK-UMA.csv": [("2015-06-02 10:00:00", "7.5"), ("2015-06-03 10:00:00", "")]}


def sensor_folder(path):
    os.makedirs(path)
    for name, rows in FILES.items():
        with open(os.path.join(path, name), "w") as f:
            f.write("date;series;value\n" + "".join(f'{d};s;{v}\n' for d, v in rows))
    return str(path)


def tables(spark, path, counts=None, shift=0):
    kpis = spark.createDataFrame([("ZK-TAN", "2015-06-01", 3.5 + shift, 2, 10), ("ZK-UMA", "2015-06-02", 2.0, 1, 5)],
                                 "asset_id string, d string, flighthours double, flightcycles int, delayedminutes int"
                                 ).select("asset_id", F.col("d").cast("date").alias("day"), "flighthours", "flightcycles",
                                          "delayedminutes")
    events = spark.createDataFrame([("ZK-TAN", "2015-06-05")], "asset_id string, d string").select(
        "asset_id", F.col("d").cast("date").alias("event_day"))
    return Sources(readings.read_readings(spark, path, counts=counts), kpis, events, counts)


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def test_management_commits_a_pair_with_its_counts(spark, tmp_path):
    folder, root = sensor_folder(tmp_path / "in"), str(tmp_path / "store")
    store = MatrixStore(spark, root)
    assert not store.exists() and store.manifest().isEmpty() and store.expire() == []
    with pytest.raises(LookupError):
        store.current()
    matrix = run_management(tables(spark, folder, Observation()), root)
    assert {(r.asset_id, str(r.day), r.label) for r in matrix.collect()} == {("ZK-TAN", "2015-06-01", 1),
                                                                            ("ZK-UMA", "2015-06-02", 0)}
    issues = readings.reading_issues(spark, folder).first().asDict()
    current = store.current().asDict()
    assert {c: current[c] for c in issues} == issues and issues["n_rows"] == 6 and issues["n_good"] == 3
    assert current["horizon_days"] == 7 and store.daily().count() >= 2


def test_readings_are_scanned_once(spark, tmp_path):
    """The counts come from the plan that reads the readings, and dropping rows does not hide them."""
    folder, counts = sensor_folder(tmp_path / "in"), Observation()
    frame = readings.read_readings(spark, folder, counts=counts)
    plan = frame.groupBy("asset_id").count()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CollectMetrics") == 1 and plan.count("Relation [") == 1
    assert frame.where("asset_id = 'ZK-UMA'").count() == 1
    assert readings.observed_counts(counts)["n_good"] == 3
    idle = Observation()
    readings.read_readings(spark, folder, counts=idle)
    assert readings.observed_counts(idle, 0.2) is None


@pytest.mark.parametrize("dies_in", ["write_daily", "write_matrix", "commit"])
def test_a_run_that_dies_leaves_the_old_pair(spark, tmp_path, monkeypatch, dies_in):
    folder, root = sensor_folder(tmp_path / "in"), str(tmp_path / "store")
    run_management(tables(spark, folder), root)
    store = MatrixStore(spark, root)
    before = store.current()["version"], rows(read_matrix(spark, root)), rows(store.daily())

    def die(*_, **__):
        raise KeyboardInterrupt("the driver is gone")

    monkeypatch.setattr(*((MatrixStore, "commit") if dies_in == "commit" else (jobs, dies_in)), die)
    with pytest.raises(KeyboardInterrupt):
        run_management(tables(spark, folder, shift=1), root)
    monkeypatch.undo()
    assert (store.current()["version"], rows(read_matrix(spark, root)), rows(store.daily())) == before
    opened = read_matrix(spark, root)
    run_management(tables(spark, folder, shift=1), root)
    assert rows(opened) == before[1] != rows(read_matrix(spark, root))  # an open reader keeps its version
    left = set(os.listdir(os.path.join(root, "versions")))
    assert set(store.expire(keep=1)) == {before[0]}
    assert set(store.expire(keep=1, uncommitted=True)) == left - {before[0], store.current()["version"]}
    assert rows(store.daily()) != before[2] and os.listdir(os.path.join(root, "versions")) == [store.current()["version"]]
    with pytest.raises(ValueError):
        store.expire(keep=0)


@pytest.mark.parametrize("days, exits", [(["exit"], 1), (["2024-01-01"], 0), (["2024-01-01", "EXIT"], 1)])
def test_exit_is_seen_by_the_write_alone(spark, tmp_path, monkeypatch, days, exits):
    monkeypatch.setattr(stream, "score_requests", lambda completed, model: completed)
    daily = spark.createDataFrame([("XY-AAA", "2024-01-01", 1.0, 1.0, 1, 1, True, True)],
                                  "asset_id string, d string, avg_sensor double, flighthours double, flightcycles int, "
                                  "delayedminutes int, has_sensor boolean, has_kpi boolean").select(
        "asset_id", F.col("d").cast("date").alias("day"), "avg_sensor", "flighthours", "flightcycles", "delayedminutes",
        "has_sensor", "has_kpi")
    batch = spark.createDataFrame([(i, d, "XY-AAA") for i, d in enumerate(days)],
                                  "request_id long, day string, asset_id string")
    seen = []
    write = stream._batch_writer(daily, None, str(tmp_path / "out"), None, lambda: seen.append(1))
    reader = type(spark.read)
    monkeypatch.setattr(reader, "parquet", lambda *_: pytest.fail("the output is read again"))
    write(batch, 3)
    assert len(seen) == exits
