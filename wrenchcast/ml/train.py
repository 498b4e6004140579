"""Train, tune and compare tree classifiers on the matrix.

* The split is by a hash of the row key (or by day), so it does not change
  with partitioning; folds of the cross validation come from a hash column
  (``foldCol``) for the same reason.
* The feature pipeline is fitted once, on the training rows only.
* The scored test rows are evaluated in one aggregation pass.
* Model fits of the grid run in parallel (``parallelism``); each fit is a
  distributed Spark ML job whose split statistics are aggregated by executors.
* With a ledger every finished fit is recorded, and a search begun again fits
  only what is missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchcast.ml.evaluate import summary_metrics
from wrenchcast.ml.features import NUMERIC_FEATURES, category_sizes, feature_pipeline, feature_width
from wrenchcast.ml.ledger import FitLedger, Point, rows_key
from wrenchcast.operators.sampling import by_day_split, hash_folds, hash_split

# Fixed values of the reference's tuning: depth 5/10/15 x bins 120/140/160,
# 3 folds, seed 69, 80/20 train/test split, accuracy as the selection metric.
DEFAULT_DEPTHS = (5, 10, 15)
DEFAULT_BINS = (120, 140, 160)
DEFAULT_FOLDS = 3
DEFAULT_SEED = 69
DEFAULT_TEST_FRACTION = 0.2


@dataclass
class TrainedModel:
    model_class: str
    model: PipelineModel
    metrics: dict
    params: dict = field(default_factory=dict)


def _estimators(seed: int, names):
    out = []
    for name in names:
        if name == "DecisionTree":
            out.append(DecisionTreeClassifier(labelCol="label", featuresCol="features", seed=seed))
        elif name == "RandomForest":
            out.append(RandomForestClassifier(labelCol="label", featuresCol="features", seed=seed))
        else:
            raise ValueError(f"unknown model {name!r}")
    return out


def split_matrix(matrix: DataFrame, seed: int = DEFAULT_SEED, test_fraction: float = DEFAULT_TEST_FRACTION,
                 first_test_day=None, method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """Train / test rows. By key hash by default; by time when ``first_test_day``
    is given; ``method='random'`` is the reference's ``randomSplit``, whose rows
    change with the partitioning of the matrix."""
    if method == "random" and first_test_day is not None:
        raise ValueError("a split by day is not random: give first_test_day or method='random', not both")
    if method == "random":
        train, test = matrix.randomSplit([1.0 - test_fraction, test_fraction], seed=seed)
        return train, test
    if method != "hash":
        raise ValueError("method must be 'hash' or 'random'")
    if first_test_day is not None:
        train, test = by_day_split(matrix, "day", first_test_day)
        return train, test
    key = F.concat_ws("|", F.col("asset_id").cast("string"), F.col("day").cast("string"))
    train, test = hash_split(matrix, key, (1.0 - test_fraction, test_fraction), seed)
    return train, test


def skipped_rows(split: DataFrame, date_feature: str, asset_feature: str) -> tuple[int, int]:
    """Rows of a split and how many of them the assembler skips, in one pass.

    A null asset or, as a category, a null day is an index of its own and is
    kept; a null day has no calendar, and a null number has no value.
    """
    needed = NUMERIC_FEATURES + (["day"] if date_feature == "calendar" else [])
    any_null = F.lit(False)
    for c in needed:
        any_null = any_null | F.col(c).isNull()
    counts = split.agg(F.count(F.lit(1)).alias("rows"),
                       F.coalesce(F.sum(any_null.cast("long")), F.lit(0)).alias("skipped")).first()
    return int(counts["rows"]), int(counts["skipped"])


def cross_validate(estimator, name: str, points: list[Point], rows: DataFrame, folds: int, parallelism: int,
                   ledger: FitLedger | None = None, data_key: str = "") -> tuple[Point, dict[Point, float]]:
    """The grid point of best mean accuracy over the folds (the first of equal ones), and all means.

    ``rows`` has features, label and fold. The numbers are those of Spark's ``CrossValidator`` with that fold column;
    here each fit is a unit of its own, so that the ledger can hold it.
    """
    done = ledger.done(name, data_key) if ledger else {}
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    todo = [(p, f) for f in range(folds) for p in points if (p, f) not in done]
    for fold in sorted({f for _, f in todo}):
        for side, part in (("training", F.col("fold") != fold), ("validation", F.col("fold") == fold)):
            if rows.where(part).isEmpty():
                raise ValueError(f"no {side} rows at fold {fold}; use more rows or fewer folds")

    def fit(task: tuple[Point, int]) -> tuple[tuple[Point, int], float]:
        (depth, bins), fold = task
        model = estimator.fit(rows.where(F.col("fold") != fold),
                              {estimator.maxDepth: depth, estimator.maxBins: bins})
        accuracy = evaluator.evaluate(model.transform(rows.where(F.col("fold") == fold)))
        if ledger:
            ledger.record(name, data_key, (depth, bins), fold, accuracy)
        return task, accuracy

    with ThreadPool(max(1, min(parallelism, len(todo)))) as pool:
        done |= dict(pool.imap_unordered(inheritable_thread_target(rows.sparkSession)(fit), todo))
    means = {p: sum(done[p, f] for f in range(folds)) / folds for p in points}
    return max(points, key=lambda p: means[p]), means


def train_models(matrix: DataFrame, **options) -> list[TrainedModel]:
    """All of ``train_each``, whose options these are."""
    return list(train_each(matrix, **options))


def train_each(matrix: DataFrame, models=("DecisionTree", "RandomForest"), depths=DEFAULT_DEPTHS,
               bins=DEFAULT_BINS, folds: int = DEFAULT_FOLDS, seed: int = DEFAULT_SEED,
               test_fraction: float = DEFAULT_TEST_FRACTION, date_feature: str = "calendar",
               parallelism: int = 4, first_test_day=None,
               asset_feature: str = "category", split_method: str = "hash",
               on_unusable_bins: str = "error", ledger: FitLedger | None = None) -> Iterator[TrainedModel]:
    """Fit every model class over the grid with k-fold CV; evaluate the best
    of each on the held-out rows.

    A tree needs ``maxBins`` >= the number of values of every categorical
    feature (assets + 1 for unseen ones; days with ``date_feature='index'``).
    Grid points below that raise a ValueError that names the needed value; with
    ``on_unusable_bins='drop'`` they are left out, and each run records which
    (``dropped_bins``). Rows the assembler skips for a null in any feature are
    counted for the training and the test split and recorded with the run.
    Finished fits are read from and added to the ``ledger``, if there is one.
    """
    if on_unusable_bins not in ("error", "drop"):
        raise ValueError("on_unusable_bins must be 'error' or 'drop'")
    train, test = split_matrix(matrix, seed, test_fraction, first_test_day, split_method)
    rows, skipped = skipped_rows(train, date_feature, asset_feature)
    if not rows:
        raise ValueError("the training split is empty; use more rows, another test_fraction or a later "
                         "first_test_day")
    _, skipped_test = skipped_rows(test, date_feature, asset_feature)
    features = feature_pipeline(date_feature, asset_feature=asset_feature).fit(train)
    sizes = category_sizes(features)
    if asset_feature != "category":
        sizes.pop("feat_asset_index", None)
    needed = max(sizes.values(), default=2)
    usable_bins = [b for b in bins if b >= needed]
    dropped_bins = [b for b in bins if b < needed]
    if not usable_bins or (dropped_bins and on_unusable_bins == "error"):
        raise ValueError(f"maxBins must be >= {needed} (values of the largest categorical feature); "
                         f"grid has {list(bins)}; for large fleets use asset_feature='continuous'")
    width = feature_width(features)

    key = F.concat_ws("|", F.col("asset_id").cast("string"), F.col("day").cast("string"))
    train_f = hash_folds(features.transform(train), key, folds, seed, "fold") \
        .select("features", "label", "fold").persist(StorageLevel.MEMORY_AND_DISK)
    test_f = features.transform(test).select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    points = [(d, b) for d in depths for b in usable_bins]
    try:
        data_key = rows_key(train, folds, seed, date_feature, asset_feature) if ledger else ""
        for name, est in zip(models, _estimators(seed, models)):
            (depth, most_bins), _ = cross_validate(est, name, points, train_f, folds, parallelism, ledger, data_key)
            best = est.fit(train_f, {est.maxDepth: depth, est.maxBins: most_bins})
            metrics = summary_metrics(best.transform(test_f)).first().asDict()
            if not metrics.get("n"):
                raise ValueError("the test split is empty; use more rows, another test_fraction or an earlier "
                                 "first_test_day")
            params = {"num_features": width, "max_depth": best.getOrDefault("maxDepth"),
                      "max_bins": best.getOrDefault("maxBins"), "skipped_rows": skipped,
                      "skipped_test_rows": skipped_test, "dropped_bins": ",".join(map(str, dropped_bins))}
            yield TrainedModel(type(best).__name__, PipelineModel(features.stages + [best]), metrics, params)
    finally:
        train_f.unpersist()
        test_f.unpersist()
