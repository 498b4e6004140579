"""The three stages of the application (K1, K2, K4, K6) as plain functions.

management: sources -> feature matrix (Parquet by month) + daily table
analysis:   stored matrix -> tuned models -> run table + saved pipelines
classifier: requests + stored daily table + best saved pipeline -> scored requests

Each stage reads what the previous one wrote, so a later stage can run on
its own and the written tables cut the lineage between stages.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wrenchcast.ml.ledger import FitLedger
from wrenchcast.ml.registry import RunRegistry, model_class_filter
from wrenchcast.ml.score import complete_requests_daily, daily_for_requests, score_requests
from wrenchcast.ml.train import train_each
from wrenchcast.operators.matrix import build_matrix, daily_table, matrix_from_daily
from wrenchcast.sources.files import read_matrix
from wrenchcast.sources.jdbc import INTERRUPTION_TABLE, KPI_TABLE, read_interruptions, read_kpis
from wrenchcast.sources.readings import observed_counts, read_readings
from wrenchcast.sources.sinks import write_daily, write_matrix
from wrenchcast.sources.store import MatrixStore

STAGES = ("all", "management", "analysis", "classifier")


@dataclass
class Sources:
    readings: DataFrame       # asset_id, day, value
    kpis: DataFrame           # asset_id, day, flighthours, flightcycles, delayedminutes
    interruptions: DataFrame  # asset_id, event_day
    reading_counts: Observation | None = None  # filled by the first action that scans the readings


def load_sources(spark: SparkSession, sensor_folder: str, warehouse_url: str, warehouse_props: dict,
                 events_url: str, events_props: dict, kpi_partitioning: dict | None = None,
                 event_partitioning: dict | None = None, kpi_table: str = KPI_TABLE,
                 event_table: str = INTERRUPTION_TABLE, recursive: bool = False) -> Sources:
    """The three inputs as the application has them: a folder of sensor CSV
    files, a KPI table in the warehouse and an interruption table in the
    operations database. ``*_partitioning`` are the parallel JDBC read options
    (``partition_column``, ``lower_bound``, ``upper_bound``, ``num_partitions``)."""
    counts = Observation()
    return Sources(read_readings(spark, sensor_folder, recursive=recursive, counts=counts),
                   read_kpis(spark, warehouse_url, warehouse_props, table=kpi_table, **(kpi_partitioning or {})),
                   read_interruptions(spark, events_url, events_props, table=event_table,
                                      **(event_partitioning or {})), counts)


def matrix_for_record(spark: SparkSession, sensor_folder: str, warehouse_url: str, warehouse_props: dict,
                      events_url: str, events_props: dict, asset_id: str, day, horizon_days: int = 7,
                      kpi_table: str = KPI_TABLE, event_table: str = INTERRUPTION_TABLE) -> DataFrame:
    """The matrix row of one (asset, day), as the reference's management stage
    computed it for a single record (nothing is written).

    Every restriction reaches its source: only the asset's sensor files are
    opened (file-name glob), and the KPI and interruption queries carry the
    asset with the day and [day, day + horizon] to their databases.
    """
    the_day = F.lit(day).cast("date")
    last_day = dt.date.fromisoformat(str(day)[:10]) + dt.timedelta(days=horizon_days)
    readings = read_readings(spark, sensor_folder, asset_id=asset_id).where(F.col("day") == the_day)
    kpis = read_kpis(spark, warehouse_url, warehouse_props, table=kpi_table, asset_id=asset_id, day=day)
    events = read_interruptions(spark, events_url, events_props, table=event_table, asset_id=asset_id,
                                first_day=day, last_day=last_day)
    return build_matrix(readings, kpis, events, horizon_days=horizon_days)


def run_management(sources: Sources, matrix_path: str, horizon_days: int = 7,
                   value_scale: int | None = None) -> DataFrame:
    """Write the daily table (what the classifier joins with), then the
    labelled matrix derived from the stored daily table: the raw readings
    are scanned once, and the written table cuts the lineage.

    Both go to a new version under ``matrix_path``, which becomes the current one
    when both are complete (``sources.store``). Its manifest row holds what the
    scan of the readings counted, good and bad rows, when the sources come from
    ``load_sources``.
    """
    spark = sources.readings.sparkSession
    store = MatrixStore(spark, matrix_path)
    version = store.new_version()
    write_daily(daily_table(sources.readings, sources.kpis, value_scale), store.path(version, "daily"))
    matrix = matrix_from_daily(store.daily(version), sources.interruptions, horizon_days)
    write_matrix(matrix, store.matrix_path(version))
    store.commit(version, horizon_days, observed_counts(sources.reading_counts) if sources.reading_counts else None)
    return read_matrix(spark, matrix_path)


def run_analysis(spark: SparkSession, matrix_path: str, registry_root: str, experiment: str,
                 search_id: str | None = None, **train_options) -> list[str]:
    """Tune and log a model of each class; the run ids.

    With a ``search_id`` the search can be interrupted: called again with it, only
    the fits that are not recorded are made, and classes whose run is logged are
    left as they are. Without one every call is a search of its own.
    """
    registry = RunRegistry(spark, registry_root)
    run_ids = []
    if search_id is not None:
        logged = registry.runs().where((F.col("search_id") == search_id) & (F.col("experiment") == experiment))
        found = {r["model_class"]: r["run_id"] for r in logged.select("model_class", "run_id").collect()}
        names = train_options.pop("models", ("DecisionTree", "RandomForest"))
        run_ids = [found[model_class_filter(n)] for n in names if model_class_filter(n) in found]
        train_options["models"] = [n for n in names if model_class_filter(n) not in found]
        train_options["ledger"] = FitLedger(spark, registry_root, search_id)
        if not train_options["models"]:
            return run_ids
    for trained in train_each(read_matrix(spark, matrix_path), **train_options):
        run_ids.append(registry.log_run(experiment, trained.model, trained.model_class,
                                        trained.metrics, trained.params, search_id))
    return run_ids


def run_classifier(spark: SparkSession, requests: DataFrame, matrix_path: str, registry_root: str,
                   experiment: str, choice: str | None = None, idx: int = 0,
                   valid: Column | None = None) -> DataFrame:
    """Score requests against the stored daily table with the chosen saved
    pipeline. ``valid`` replaces the default request-format check."""
    model = RunRegistry(spark, registry_root).load_best_model(experiment, choice, idx)
    requests = requests.persist()  # read for its days now and by the join when the caller runs the result
    daily = daily_for_requests(requests, MatrixStore(spark, matrix_path).daily())
    return score_requests(complete_requests_daily(requests, daily, valid), model)


def run_stages(spark: SparkSession, stage: str, sources: Sources | None, matrix_path: str, registry_root: str,
               experiment: str, requests: DataFrame | None = None, choice: str | None = None, idx: int = 0,
               horizon_days: int = 7, value_scale: int | None = None, valid: Column | None = None,
               **train_options) -> DataFrame | None:
    """Run ``stage`` and what follows it, like the reference: ``all`` runs the
    three stages, ``analysis`` goes on to the classifier, ``management`` and
    ``classifier`` stand alone. Only the management stage reads ``sources``. The
    classifier scores ``requests``; without any, its result is None."""
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}")
    if stage in ("all", "management"):
        if sources is None:
            raise ValueError(f"stage {stage!r} needs sources")
        run_management(sources, matrix_path, horizon_days, value_scale)
    if stage in ("all", "analysis"):
        run_analysis(spark, matrix_path, registry_root, experiment, **train_options)
    if stage != "management" and requests is not None:
        return run_classifier(spark, requests, matrix_path, registry_root, experiment, choice, idx, valid)
    return None
