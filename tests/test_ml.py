"""Training, registry, batch scoring and streaming scoring on small fixtures."""

import datetime as dt
import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wrenchcast.jobs import Sources, run_stages
from wrenchcast.ml import features as ft
from wrenchcast.ml import registry as rg
from wrenchcast.ml import score as scr
from wrenchcast.ml.evaluate import summary_metrics
from wrenchcast.ml.indexer import TableIndexModel
from wrenchcast.ml.train import train_models
from wrenchcast.streaming import score as stream

D0 = dt.date(2024, 1, 1)
ASSETS = [f"XY-{c * 3}" for c in ("AAA", "BBB", "CCC", "DDD", "EEE")]


def _planted(spark, n=500):
    rows = []
    for i in range(n):
        asset = ASSETS[i % 5][:6]
        day = D0 + dt.timedelta(days=i // 5)
        sensor = float((i * 37) % 100)
        rows.append((asset, day, sensor, float(i % 7), i % 4, i % 3, int(sensor > 60)))
    return spark.createDataFrame(rows, "asset_id string, day date, avg_sensor double, flighthours double, "
                                       "flightcycles int, delayedminutes int, label int")


SMALL = dict(depths=(4,), bins=(32,), folds=2, parallelism=2)


@pytest.fixture(scope="module")
def trained(spark):
    return train_models(_planted(spark), **SMALL)


def test_models_beat_majority(trained):
    assert [t.model_class for t in trained] == ["DecisionTreeClassificationModel", "RandomForestClassificationModel"]
    for t in trained:
        assert t.metrics["accuracy"] > 0.8  # majority class is 0.6
        assert t.metrics["weighted_recall"] == pytest.approx(t.metrics["accuracy"])
        assert t.params == {"num_features": 7, "max_depth": 4, "max_bins": 32, "skipped_rows": 0,
                            "skipped_test_rows": 0, "dropped_bins": ""}


def test_same_seed_same_predictions(spark, trained):
    again = train_models(_planted(spark), models=("DecisionTree",), **SMALL)[0]
    m = _planted(spark)
    a = [r.prediction for r in trained[0].model.transform(m).orderBy("asset_id", "day").collect()]
    b = [r.prediction for r in again.model.transform(m).orderBy("asset_id", "day").collect()]
    assert a == b


def test_feature_pipeline_width_and_bins(spark):
    m = _planted(spark)
    fitted = ft.feature_pipeline("index").fit(m)
    assert ft.feature_width(fitted) == 6
    assert ft.category_sizes(fitted)["feat_day_index"] == 101
    with pytest.raises(ValueError, match="maxBins"):
        train_models(m, models=("DecisionTree",), depths=(3,), bins=(32,), folds=2, date_feature="index")


def test_metrics_match_evaluator(spark, trained):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    scored = trained[0].model.transform(_planted(spark))
    ours = summary_metrics(scored).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    assert ours.accuracy == pytest.approx(ev.evaluate(scored), abs=1e-6)


def _runs(spark):
    rows = [("r1", "e", "DecisionTreeClassificationModel", 0.9), ("r2", "e", "RandomForestClassificationModel", 0.9),
            ("r0", "e", "RandomForestClassificationModel", 0.8), ("r3", "other", "DecisionTreeClassificationModel", 0.99)]
    return spark.createDataFrame(rows, "run_id string, experiment string, model_class string, accuracy double")


def test_top_runs_deterministic_and_filtered(spark):
    runs = _runs(spark)
    top = rg.top_runs(runs, 2, experiment="e").collect()
    assert [(r.rank, r.run_id) for r in top] == [(1, "r1"), (2, "r2")]
    rf = rg.top_runs(runs, 2, rg.model_class_filter("RandomForest"), "e").collect()
    assert [r.run_id for r in rf] == ["r2", "r0"]
    assert rg.model_class_filter("Default") is None
    with pytest.raises(ValueError):
        rg.model_class_filter("Boosting")


def test_registry_log_and_load(spark, tmp_path, trained):
    reg = rg.RunRegistry(spark, str(tmp_path / "registry"))
    assert reg.runs().isEmpty()
    ids = [reg.log_run("exp", t.model, t.model_class, t.metrics, t.params) for t in trained]
    assert reg.runs().count() == 2
    best_dt = reg.load_best_model("exp", "DecisionTree")
    assert isinstance(best_dt, PipelineModel)
    assert type(best_dt.stages[-1]).__name__ == "DecisionTreeClassificationModel"
    assert reg.best("exp", k=2).count() == 2 and len(set(ids)) == 2


def _daily(spark):
    sensor = spark.createDataFrame([("XY-AAA", D0, 80.0), ("XY-BBB", D0, 10.0), ("XY-ZZZ", D0, 90.0),
                                    ("XY-CCC", D0, 50.0)], "asset_id string, day date, avg_sensor double")
    kpis = spark.createDataFrame([("XY-AAA", D0, 1.0, 1, 0), ("XY-BBB", D0, 2.0, 2, 1), ("XY-ZZZ", D0, 1.0, 0, 0)],
                                 "asset_id string, day date, flighthours double, flightcycles int, delayedminutes int")
    return sensor, kpis


def _requests(spark):
    return spark.createDataFrame([(1, "2024-01-01", "XY-AAA"), (2, "2024/01/01", "XY-AAA"), (3, "2024-01-02", "XY-AAA"),
                                  (4, "2024-01-01", "XY-CCC"), (5, "2024-01-01", "XY-ZZZ"), (6, "2024-01-01", "XY-BBB")],
                                 "request_id long, day string, asset_id string")


EXPECTED_STATUS = {1: "ok", 2: "invalid", 3: "no_sensor", 4: "no_kpi", 5: "ok", 6: "ok"}


def test_score_requests_keeps_every_request(spark, trained):
    sensor, kpis = _daily(spark)
    out = scr.score_requests(scr.complete_requests(_requests(spark), sensor, kpis), trained[0].model).collect()
    got = {r.request_id: r for r in out}
    assert {k: r.status for k, r in got.items()} == EXPECTED_STATUS
    assert got[1].prediction_text == "Maintenance" and got[6].prediction_text == "No maintenance"
    assert got[5].prediction is not None  # asset unseen in training is scored
    assert got[2].prediction is None and got[3].prediction is None


def test_streaming_equals_batch(spark, tmp_path, trained):
    sensor, kpis = _daily(spark)
    inbox = str(tmp_path / "inbox")
    os.makedirs(inbox)
    _requests(spark).coalesce(1).write.mode("overwrite").option("header", True).csv(inbox + "/batch1")
    q = stream.start_scoring(spark, inbox + "/batch1", sensor, kpis, trained[0].model,
                             str(tmp_path / "out"), str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    streamed = {r.request_id: (r.status, r.prediction) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {r.request_id: (r.status, r.prediction) for r in
             scr.score_requests(scr.complete_requests(_requests(spark), sensor, kpis), trained[0].model).collect()}
    assert streamed == batch
    assert not stream.exit_seen(spark, str(tmp_path / "out"))


def test_run_stages_end_to_end(spark, tmp_path):
    m = _planted(spark, 200)
    readings = m.select("asset_id", "day", F.col("avg_sensor").alias("value"))
    kpis = m.select("asset_id", "day", "flighthours", "flightcycles", "delayedminutes")
    events = m.where("label = 1").select("asset_id", F.col("day").alias("event_day"))
    out = run_stages(spark, "all", Sources(readings, kpis, events), str(tmp_path / "matrix"),
                     str(tmp_path / "reg"), "exp", requests=_requests(spark), models=("DecisionTree",), **SMALL)
    assert out.count() == 6
    from wrenchcast.operators.matrix import build_matrix
    from wrenchcast.sources.files import read_matrix
    stored = sorted(map(tuple, read_matrix(spark, str(tmp_path / "matrix")).collect()))
    assert stored == sorted(map(tuple, build_matrix(readings, kpis, events).collect()))
    with pytest.raises(ValueError):
        run_stages(spark, "deploy", Sources(readings, kpis, events), "", "", "exp")


def test_daily_table_scoring_equals_two_sides(spark, trained):
    from wrenchcast.operators.matrix import daily_table
    sensor, kpis = _daily(spark)
    readings = sensor.select("asset_id", "day", F.col("avg_sensor").alias("value"))
    daily = daily_table(readings, kpis)
    assert {(r.asset_id, r.has_sensor, r.has_kpi) for r in daily.collect()} == {
        ("XY-AAA", True, True), ("XY-BBB", True, True), ("XY-ZZZ", True, True), ("XY-CCC", True, False)}
    one = {r.request_id: (r.status, r.prediction) for r in
           scr.score_requests(scr.complete_requests_daily(_requests(spark), daily), trained[0].model).collect()}
    two = {r.request_id: (r.status, r.prediction) for r in
           scr.score_requests(scr.complete_requests(_requests(spark), sensor, kpis), trained[0].model).collect()}
    assert one == two and {k: v[0] for k, v in one.items()} == EXPECTED_STATUS


def test_streaming_exit_request_is_kept_and_seen(spark, tmp_path, trained):
    sensor, kpis = _daily(spark)
    inbox = str(tmp_path / "inbox")
    reqs = _requests(spark).unionByName(spark.createDataFrame([(99, "exit", "exit")], "request_id long, day string, asset_id string"))
    reqs.coalesce(1).write.option("header", True).csv(inbox)
    q = stream.start_scoring(spark, inbox, sensor, kpis, trained[0].model, str(tmp_path / "out"),
                             str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    out = {r.request_id: r.status for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out[99] == "exit" and len(out) == 7
    assert stream.exit_seen(spark, str(tmp_path / "out"))


def test_stream_over_the_stored_daily_table_equals_batch(spark, tmp_path, trained):
    from wrenchcast.operators.matrix import daily_table
    sensor, kpis = _daily(spark)
    daily = daily_table(sensor.select("asset_id", "day", F.col("avg_sensor").alias("value")), kpis)
    inbox = str(tmp_path / "inbox")
    _requests(spark).coalesce(1).write.option("header", True).csv(inbox)
    q = stream.start_scoring(spark, inbox, None, None, trained[0].model, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                             available_now=True, daily=daily)
    q.awaitTermination(120)
    got = {r.request_id: (r.status, r.prediction) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = scr.score_requests(scr.complete_requests_daily(_requests(spark), daily), trained[0].model)
    assert got == {r.request_id: (r.status, r.prediction) for r in batch.collect()}


def test_analysis_stage_goes_on_to_the_classifier(spark, tmp_path):
    m = _planted(spark, 200)
    readings = m.select("asset_id", "day", F.col("avg_sensor").alias("value"))
    kpis = m.select("asset_id", "day", "flighthours", "flightcycles", "delayedminutes")
    events = m.where("label = 1").select("asset_id", F.col("day").alias("event_day"))
    path, reg = str(tmp_path / "matrix"), str(tmp_path / "reg")
    assert run_stages(spark, "management", Sources(readings, kpis, events), path, reg, "exp", _requests(spark),
                      horizon_days=0) is None
    out = run_stages(spark, "analysis", None, path, reg, "exp", _requests(spark), models=("DecisionTree",), **SMALL)
    assert out.count() == 6
    assert run_stages(spark, "classifier", None, path, reg, "exp", _requests(spark), idx=0).count() == 6
    with pytest.raises(ValueError, match="sources"):
        run_stages(spark, "all", None, path, reg, "exp")


def test_split_by_day(spark):
    from wrenchcast.ml.train import split_matrix
    m = _planted(spark, 100)
    train, test = split_matrix(m, first_test_day=D0 + dt.timedelta(days=15))
    assert train.agg(F.max("day")).first()[0] < test.agg(F.min("day")).first()[0]
    assert train.count() + test.count() == 100


def test_asset_feature_options(spark):
    m = _planted(spark)
    cont = ft.feature_pipeline(asset_feature="continuous").fit(m)
    out = cont.transform(m)
    attrs = out.schema["features"].metadata["ml_attr"]["attrs"]
    assert "nominal" not in attrs or all(a["name"] != "feat_asset_rank" for a in attrs["nominal"])
    assert ft.feature_width(cont) == 7
    assert ft.feature_width(ft.feature_pipeline(asset_feature="none").fit(m)) == 6
    res = train_models(m, models=("DecisionTree",), depths=(3,), bins=(4,), folds=2, asset_feature="continuous")
    assert res[0].params["max_bins"] == 4
    with pytest.raises(ValueError, match="continuous"):
        train_models(m, models=("DecisionTree",), depths=(3,), bins=(4,), folds=2)


def test_score_until_exit_stops_on_exit_request(spark, tmp_path, trained):
    from wrenchcast.operators.matrix import daily_table
    sensor, kpis = _daily(spark)
    daily = daily_table(sensor.select("asset_id", "day", F.col("avg_sensor").alias("value")), kpis)
    inbox = str(tmp_path / "inbox")
    reqs = _requests(spark).unionByName(
        spark.createDataFrame([(99, "exit", "exit")], "request_id long, day string, asset_id string"))
    reqs.coalesce(1).write.option("header", True).csv(inbox)
    stopped = stream.score_until_exit(spark, inbox, daily, trained[0].model, str(tmp_path / "out"),
                                      str(tmp_path / "ckpt"), processing_time="1 second", timeout_seconds=90)
    assert stopped
    out = {r.request_id: r.status for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out[99] == "exit" and {k: v for k, v in out.items() if k != 99} == EXPECTED_STATUS


def test_rows_with_null_features_are_counted(spark):
    m = _planted(spark, 200).withColumn("flighthours", F.when(F.col("flightcycles") == 0, None)
                                        .otherwise(F.col("flighthours")))
    res = train_models(m, models=("DecisionTree",), depths=(3,), bins=(32,), folds=2)
    params = res[0].params
    total = m.where("flighthours IS NULL").count()
    assert params["skipped_rows"] + params["skipped_test_rows"] == total and params["skipped_test_rows"] > 0


def test_null_days_are_counted_and_stored(spark, tmp_path):
    m = _planted(spark, 300).withColumn("day", F.when(F.col("flightcycles") != 1, F.col("day")))
    res = train_models(m, models=("DecisionTree",), depths=(3,), bins=(4, 32), folds=2, on_unusable_bins="drop")
    reg = rg.RunRegistry(spark, str(tmp_path / "reg"))
    reg.log_run("exp", res[0].model, res[0].model_class, res[0].metrics, res[0].params)
    run = reg.runs().first()
    assert run.skipped_rows + run.skipped_test_rows == m.where("day IS NULL").count()
    assert run.dropped_bins == "4"
    with pytest.raises(ValueError, match="maxBins"):
        train_models(m, models=("DecisionTree",), depths=(3,), bins=(4, 32), folds=2)


def test_registry_hides_no_other_fault(spark, tmp_path):
    assert rg.RunRegistry(spark, str(tmp_path / "none")).runs().count() == 0
    os.makedirs(tmp_path / "bad" / "runs")
    (tmp_path / "bad" / "runs" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        rg.RunRegistry(spark, str(tmp_path / "bad")).runs().collect()


def test_metrics_of_no_rows(spark):
    empty = spark.createDataFrame([], "label int, prediction double")
    assert summary_metrics(empty).first().n == 0


def test_daily_for_requests_prunes_partitions(spark, tmp_path):
    from wrenchcast.sources.sinks import write_daily
    from wrenchcast.operators.matrix import daily_table
    from wrenchcast.ml.score import daily_for_requests
    m = _planted(spark, 100)
    readings = m.select("asset_id", "day", F.col("avg_sensor").alias("value"))
    kpis = m.select("asset_id", "day", "flighthours", "flightcycles", "delayedminutes")
    path = str(tmp_path / "daily")
    write_daily(daily_table(readings, kpis), path)
    stored = spark.read.parquet(path)
    reqs = spark.createDataFrame([(1, "2024-01-03", "XY-AAA"), (2, "2024-01-05", "XY-BBB"), (3, "bad", "x")],
                                 "request_id long, day string, asset_id string")
    part = daily_for_requests(reqs, stored)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan and "2024-01-03" in plan
    assert {str(r.day) for r in part.select("day").distinct().collect()} == {"2024-01-03", "2024-01-05"}
    stray = reqs.unionByName(spark.createDataFrame([(4, "9999-01-01", "XY-AAA")], reqs.schema))
    assert {str(r.day) for r in daily_for_requests(stray, stored).select("day").distinct().collect()} == {
        "2024-01-03", "2024-01-05"}
    empty = daily_for_requests(reqs.where("request_id = 3"), stored)
    assert empty.isEmpty()


def test_all_stages_on_driver_tables(spark, tmp_path):
    from wrenchcast.plans import tables as tb
    from wrenchcast.plans.ml_queries import _requests
    from wrenchcast.functions import scalar as sc
    from wrenchcast.jobs import run_classifier, run_management, run_analysis
    from .conftest import SF_SMALL
    ev = tb.table(spark, SF_SMALL, "events")
    sources = Sources(tb.readings(ev), tb.kpis(ev), tb.interruptions(ev))
    matrix_path, reg = str(tmp_path / "matrix"), str(tmp_path / "reg")
    matrix = run_management(sources, matrix_path, value_scale=tb.VALUE_SCALE)
    assert matrix.count() == 326
    run_analysis(spark, matrix_path, reg, "exp", models=("DecisionTree", "RandomForest"), depths=(4,), bins=(32,),
                 folds=2, asset_feature="continuous")
    reqs = _requests(spark, SF_SMALL)
    scored = run_classifier(spark, reqs, matrix_path, reg, "exp",
                            valid=sc.valid_day_text("day") & F.col("asset_id").isNotNull())
    n_events = ev.count()
    assert scored.count() == n_events
    statuses = {r.status for r in scored.select("status").distinct().collect()}
    assert "ok" in statuses and statuses <= {"ok", "invalid", "no_sensor", "no_kpi", "incomplete"}
    assert scored.where("status = 'ok' AND prediction IS NULL").isEmpty()


def test_split_methods(spark):
    from wrenchcast.ml.train import split_matrix
    from wrenchcast.operators.sampling import bernoulli_sample
    m = _planted(spark, 300)
    for method in ("hash", "random"):
        train, test = split_matrix(m, method=method)
        assert train.count() + test.count() == 300
        assert train.join(test, ["asset_id", "day"]).isEmpty()
    with pytest.raises(ValueError):
        split_matrix(m, method="random", first_test_day=D0)
    assert 0 < bernoulli_sample(m, 0.4, seed=666).count() < 300


def test_score_until_exit_after_restart_returns_at_once(spark, tmp_path):
    out = str(tmp_path / "out")
    spark.createDataFrame([(99, "exit")], "request_id long, status string").write.parquet(out + "/batch_id=0")
    assert stream.score_until_exit(spark, str(tmp_path / "inbox"), None, None, out, str(tmp_path / "ckpt"))


def test_streaming_in_several_micro_batches(spark, tmp_path, trained):
    sensor, kpis = _daily(spark)
    inbox = str(tmp_path / "inbox")
    reqs = _requests(spark)
    for i, part in enumerate([(1, 2), (3, 4), (5, 6)]):
        reqs.where(F.col("request_id").isin(*part)).coalesce(1).write.option("header", True).csv(f"{inbox}/f{i}")
    # one folder per file: read all sub-folders through a glob
    q = stream.start_scoring(spark, f"{inbox}/*", sensor, kpis, trained[0].model, str(tmp_path / "out"),
                             str(tmp_path / "ckpt"), available_now=True, max_files_per_trigger=1)
    q.awaitTermination(120)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    streamed = {r.request_id: r.status for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert streamed == EXPECTED_STATUS


def test_indexers_fitted_on_training_rows_only(spark):
    late = spark.createDataFrame([("XY-NEW", D0 + dt.timedelta(days=150 + i), 50.0, 1.0, 1, 0, 0) for i in range(5)],
                                 "asset_id string, day date, avg_sensor double, flighthours double, "
                                 "flightcycles int, delayedminutes int, label int")
    m = _planted(spark, 500).unionByName(late)
    res = train_models(m, models=("DecisionTree",), depths=(3,), bins=(32,), folds=2,
                       first_test_day=D0 + dt.timedelta(days=90))
    indexer = [s for s in res[0].model.stages if isinstance(s, TableIndexModel)][0]
    known = [r.value for r in indexer.index.collect()]
    assert "XY-NEW" not in known and len(known) == 5
    scored = res[0].model.transform(late).select("prediction").collect()
    assert len(scored) == 5  # the unseen asset is scored through the extra index


def test_load_best_model_by_index(spark, tmp_path, trained):
    reg = rg.RunRegistry(spark, str(tmp_path / "registry"))
    dt_model, rf_model = trained
    # Log the random forest with a higher accuracy so the order is known.
    reg.log_run("exp", dt_model.model, dt_model.model_class, {**dt_model.metrics, "accuracy": 0.7}, dt_model.params)
    reg.log_run("exp", rf_model.model, rf_model.model_class, {**rf_model.metrics, "accuracy": 0.9}, rf_model.params)
    first = reg.load_best_model("exp", None, idx=0)
    second = reg.load_best_model("exp", None, idx=1)
    assert type(first.stages[-1]).__name__ == "RandomForestClassificationModel"
    assert type(second.stages[-1]).__name__ == "DecisionTreeClassificationModel"
    with pytest.raises(LookupError):
        reg.load_best_model("exp", None, idx=2)


def test_empty_test_split_is_reported(spark):
    m = _planted(spark, 100)
    with pytest.raises(ValueError, match="test split is empty"):
        train_models(m, models=("DecisionTree",), depths=(3,), bins=(32,), folds=2,
                     first_test_day=D0 + dt.timedelta(days=400))


def test_empty_training_split_is_reported(spark):
    m = _planted(spark, 100)
    with pytest.raises(ValueError, match="training split is empty"):
        train_models(m, models=("DecisionTree",), depths=(3,), bins=(32,), folds=2, first_test_day=D0)
