"""Run table and model store.

Runs are rows of a Parquet table under a shared folder; each run's fitted
pipeline is saved next to it. Selecting the best model is a top-k query on
that table, filtered by experiment and model class, ties broken by run id.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wrenchcast.schemas import RUNS

# Model names accepted by the reference's command line.
MODEL_CLASSES = {"DecisionTree": "DecisionTreeClassificationModel",
                 "RandomForest": "RandomForestClassificationModel",
                 "Default": None}


def model_class_filter(choice: str | None) -> str | None:
    """'DecisionTree' / 'RandomForest' -> class name; 'Default' or None -> no filter."""
    if choice is None:
        return None
    if choice not in MODEL_CLASSES:
        raise ValueError(f"unknown model choice {choice!r}; expected one of {sorted(MODEL_CLASSES)}")
    return MODEL_CLASSES[choice]


def top_runs(runs: DataFrame, k: int = 2, model_class: str | None = None,
             experiment: str | None = None, metric: str = "accuracy") -> DataFrame:
    """The ``k`` best runs by ``metric``, with ``rank`` 1..k."""
    if experiment is not None:
        runs = runs.where(F.col("experiment") == experiment)
    if model_class is not None:
        runs = runs.where(F.col("model_class") == model_class)
    best = runs.orderBy(F.desc_nulls_last(metric), F.asc("run_id")).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last(metric), F.asc("run_id"))))


def top_runs_per_class(runs: DataFrame, k: int = 2, metric: str = "accuracy") -> DataFrame:
    """The ``k`` best runs of every model class, with ``rank`` inside the class."""
    w = Window.partitionBy("model_class").orderBy(F.desc_nulls_last(metric), F.asc("run_id"))
    return runs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


class RunRegistry:
    """Experiments, runs and models under one shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def runs_path(self) -> str:
        return f"{self.root}/runs"

    def runs(self) -> DataFrame:
        """All logged runs; an empty table when nothing is logged yet."""
        try:
            return self.spark.read.schema(RUNS).parquet(self.runs_path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], RUNS)

    def log_run(self, experiment: str, model: PipelineModel, model_class: str, metrics: dict,
                params: dict, search_id: str | None = None) -> str:
        """Save the fitted pipeline and append one run row."""
        run_id = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/models/{run_id}"
        model.write().overwrite().save(path)
        row = (run_id, experiment, model_class, float(metrics["accuracy"]), float(metrics["weighted_recall"]),
               None if metrics.get("recall_positive") is None else float(metrics["recall_positive"]),
               int(params["num_features"]), int(params["max_depth"]), int(params["max_bins"]), path,
               dt.datetime.now(), params.get("skipped_rows"), params.get("skipped_test_rows"),
               params.get("dropped_bins"), search_id)
        self.spark.createDataFrame([row], RUNS).write.mode("append").parquet(self.runs_path)
        return run_id

    def best(self, experiment: str | None = None, choice: str | None = None, k: int = 2) -> DataFrame:
        """Top-k runs of the experiment, filtered by model class."""
        return top_runs(self.runs(), k, model_class_filter(choice), experiment)

    def load_best_model(self, experiment: str | None = None, choice: str | None = None,
                        idx: int = 0) -> PipelineModel:
        rows = self.best(experiment, choice, k=idx + 1).where(F.col("rank") == idx + 1) \
            .select("model_path").collect()
        if not rows:
            raise LookupError("no run matches the selection")
        return PipelineModel.load(rows[0]["model_path"])
