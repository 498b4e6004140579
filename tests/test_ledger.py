"""Resumable grid search: equal to Spark's CrossValidator, and only missing fits are made."""

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tests.test_ml import _planted
from wrenchcast.jobs import run_analysis
from wrenchcast.ml.ledger import FitLedger, rows_key
from wrenchcast.ml.registry import RunRegistry
from wrenchcast.ml.train import cross_validate

POINTS = [(1, 8), (1, 16), (3, 8), (3, 16)]


class Tree(DecisionTreeClassifier):
    """Counts its fits; dies at the fit number ``dies_at``."""
    made, dies_at = 0, None

    def _fit(self, dataset):
        if Tree.made == Tree.dies_at:
            raise RuntimeError("the driver is gone")
        Tree.made += 1
        return super()._fit(dataset)


@pytest.fixture(scope="module")
def rows(spark):
    noisy = _planted(spark).withColumn("label", F.when(F.rand(3) < 0.1, 1 - F.col("label")).otherwise(F.col("label")))
    assembled = VectorAssembler(inputCols=["avg_sensor", "flighthours"], outputCol="features").transform(noisy)
    folded = assembled.withColumn("fold", F.pmod(F.xxhash64("asset_id", "day"), F.lit(3)).cast("int"))
    return folded.select("features", "label", "fold").persist()


@pytest.fixture(autouse=True)
def fresh_counter():
    Tree.made, Tree.dies_at = 0, None


def test_means_are_those_of_cross_validator(spark, rows):
    est = DecisionTreeClassifier(labelCol="label", featuresCol="features", seed=69)
    grid = ParamGridBuilder().addGrid(est.maxDepth, [1, 3]).addGrid(est.maxBins, [8, 16]).build()
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy")
    own = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=evaluator, numFolds=3, foldCol="fold",
                         parallelism=2).fit(rows)
    best, means = cross_validate(est, "DecisionTree", POINTS, rows, 3, 2)
    by_point = {(g[est.maxDepth], g[est.maxBins]): m for g, m in zip(grid, own.avgMetrics)}
    assert means == pytest.approx(by_point)
    assert best == (own.bestModel.getOrDefault("maxDepth"), own.bestModel.getOrDefault("maxBins"))


def test_a_search_goes_on_where_it_stopped(spark, rows, tmp_path):
    est = Tree(labelCol="label", featuresCol="features", seed=69)
    ledger = FitLedger(spark, str(tmp_path), "weekly")
    assert ledger.fits().isEmpty()
    Tree.dies_at = 5
    with pytest.raises(RuntimeError):
        cross_validate(est, "DecisionTree", POINTS, rows, 3, 1, ledger, "k")
    assert len(ledger.done("DecisionTree", "k")) == 5
    Tree.made, Tree.dies_at = 0, None
    best, means = cross_validate(est, "DecisionTree", POINTS, rows, 3, 2, ledger, "k")
    assert Tree.made == 3 * len(POINTS) - 5
    assert (best, means) == cross_validate(est, "DecisionTree", POINTS, rows, 3, 2)
    Tree.made = 0
    assert cross_validate(est, "DecisionTree", POINTS, rows, 3, 2, ledger, "k")[0] == best and Tree.made == 0
    assert FitLedger(spark, str(tmp_path), "other").done("DecisionTree", "k") == {}
    with pytest.raises(ValueError, match="other rows"):
        cross_validate(est, "DecisionTree", POINTS, rows, 3, 2, ledger, "other key")


def test_rows_key_knows_rows_and_options(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    assert rows_key(a, 3) == rows_key(a.repartition(5).orderBy(F.desc("a")), 3)
    other = spark.createDataFrame([(1, "x"), (3, None)], "a int, b string")
    assert len({rows_key(a, 3), rows_key(a, 4), rows_key(other, 3), rows_key(a.union(a), 3)}) == 4


def test_empty_folds_are_refused(spark, rows):
    est = DecisionTreeClassifier(labelCol="label", featuresCol="features")
    with pytest.raises(ValueError, match="fold 0"):
        cross_validate(est, "DecisionTree", POINTS[:1], rows.where("fold = 0"), 1, 1)


def test_analysis_logs_each_class_once(spark, tmp_path, monkeypatch):
    matrix, registry = str(tmp_path / "matrix"), str(tmp_path / "reg")
    _planted(spark, 200).withColumn("month", F.date_format("day", "yyyy-MM")).write.partitionBy("month").parquet(matrix)
    small = dict(depths=(2,), bins=(32,), folds=2, parallelism=2)
    log = RunRegistry.log_run

    def dies_at_the_second(self, experiment, model, model_class, *rest):
        if model_class.startswith("RandomForest"):
            raise RuntimeError("the driver is gone")
        return log(self, experiment, model, model_class, *rest)

    monkeypatch.setattr(RunRegistry, "log_run", dies_at_the_second)
    with pytest.raises(RuntimeError):
        run_analysis(spark, matrix, registry, "exp", "s1", **small)
    monkeypatch.undo()
    fits = FitLedger(spark, registry, "s1").fits().count()
    ids = run_analysis(spark, matrix, registry, "exp", "s1", **small)
    runs = {r.run_id: r for r in RunRegistry(spark, registry).runs().collect()}
    assert len(ids) == 2 and set(ids) == set(runs) and {r.search_id for r in runs.values()} == {"s1"}
    assert FitLedger(spark, registry, "s1").fits().count() == fits == 4
    assert run_analysis(spark, matrix, registry, "exp", "s1", **small) == ids
    assert RunRegistry(spark, registry).runs().count() == 2
