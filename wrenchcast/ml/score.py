"""Complete and score (asset, day) requests in batch.

The reference handled one typed request at a time with three ``count()`` jobs
and re-fitted indexers per request. Here a whole frame of requests is
completed with two left joins and a ``status`` column, then scored with the
saved pipeline in one pass; a bad request gets a status and never stops the
job, and no request is lost.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrenchcast.functions.scalar import decode_prediction, parse_iso_day, valid_request
from wrenchcast.ml.features import NUMERIC_FEATURES, with_invalid_kept
from wrenchcast.operators.matrix import KEYS

# Fixed status values of a request.
STATUS_INVALID = "invalid"
STATUS_NO_SENSOR = "no_sensor"
STATUS_NO_KPI = "no_kpi"
STATUS_OK = "ok"
STATUS_INCOMPLETE = "incomplete"
STATUS_EXIT = "exit"

#: Requested days that a filter lists one by one (about ten years).
MAX_LISTED_DAYS = 4000


def _any_null(cols) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNull()
    return out


def complete_requests(requests: DataFrame, sensor_daily: DataFrame, kpis: DataFrame,
                      valid: Column | None = None, day_text_col: str = "day") -> DataFrame:
    """Requests (request_id, asset_id, day text) + sensor average + KPIs + status.

    sensor_daily: asset_id, day, avg_sensor (one row per key)
    kpis:         asset_id, day, flighthours, flightcycles, delayedminutes (one row per key)
    ``valid`` defaults to the reference's format check of day and asset text.
    """
    s = sensor_daily.select(*KEYS, "avg_sensor", F.lit(True).alias("has_sensor"))
    k = kpis.select(*KEYS, "flighthours", "flightcycles", "delayedminutes", F.lit(True).alias("has_kpi"))
    return _complete(requests, [s, k], valid, day_text_col)


def complete_requests_daily(requests: DataFrame, daily: DataFrame, valid: Column | None = None,
                            day_text_col: str = "day") -> DataFrame:
    """Same as ``complete_requests`` with one stored daily table
    (``operators.matrix.daily_table``): one left join per request frame."""
    d = daily.select(*KEYS, "avg_sensor", "flighthours", "flightcycles", "delayedminutes",
                     F.when(F.col("has_sensor"), F.lit(True)).alias("has_sensor"),
                     F.when(F.col("has_kpi"), F.lit(True)).alias("has_kpi"))
    return _complete(requests, [d], valid, day_text_col)


def daily_for_requests(requests: DataFrame, daily: DataFrame, day_text_col: str = "day") -> DataFrame:
    """The part of a (day-partitioned) daily table a request frame can match.

    The distinct requested days, at most ``MAX_LISTED_DAYS`` of them, become a
    filter on the partition column, so that only their folders are read, whatever
    stray day a request names. A frame with more days reads all that lie between
    its first and last."""
    days = requests.select(parse_iso_day(F.col(day_text_col)).alias("d")).where("d IS NOT NULL").distinct()
    listed = [r["d"] for r in days.limit(MAX_LISTED_DAYS + 1).collect()]
    if not listed:
        return daily.where(F.lit(False))
    if len(listed) <= MAX_LISTED_DAYS:
        return daily.where(F.col("day").isin(listed))
    ends = days.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).first()
    return daily.where(F.col("day").between(F.lit(ends["lo"]), F.lit(ends["hi"])))


def _complete(requests: DataFrame, sides: list[DataFrame], valid: Column | None, day_text_col: str) -> DataFrame:
    valid = valid if valid is not None else valid_request(day_text_col, "asset_id")
    reqs = requests.withColumn("_valid", valid)
    if day_text_col == "day":
        reqs = reqs.withColumnRenamed("day", "day_text")
        day_text_col = "day_text"
    joined = reqs.withColumn("day", F.when(F.col("_valid"), parse_iso_day(F.col(day_text_col))))
    for side in sides:
        joined = joined.join(side, KEYS, "left")
    status = (F.when(~F.col("_valid"), F.lit(STATUS_INVALID))
              .when(F.col("has_sensor").isNull(), F.lit(STATUS_NO_SENSOR))
              .when(F.col("has_kpi").isNull(), F.lit(STATUS_NO_KPI))
              .when(_any_null(NUMERIC_FEATURES), F.lit(STATUS_INCOMPLETE))
              .otherwise(F.lit(STATUS_OK)))
    return joined.withColumn("status", status).drop("_valid", "has_sensor", "has_kpi")


def score_requests(completed: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``prediction`` and ``prediction_text`` to completed requests.

    Every request is transformed in one pass (null features become NaN
    instead of dropping the row); only rows with status ``ok`` keep their
    prediction, others get null and keep their status.
    """
    keep_all = with_invalid_kept(model)
    ok = (F.col("status") == STATUS_OK)
    scored = keep_all.transform(completed.withColumn("_ok", ok))
    pred = F.when(F.col("_ok"), F.col("prediction"))
    base = [c for c in completed.columns]
    return scored.select(*base, pred.alias("prediction"), decode_prediction(pred).alias("prediction_text"))
