"""Registered queries of the model family.

Driver mapping: ``labels.quality`` plays the true label and ``labels.toxic``
the prediction; runs are per (brand, type) aggregates of ``part``; requests
are built from ``events`` (some malformed, some pointing at days without data).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wrenchcast.functions import scalar as sc
from wrenchcast.ml import evaluate as ev
from wrenchcast.ml import registry as rg
from wrenchcast.ml import score as scr
from wrenchcast.operators import keys as ky
from wrenchcast.operators import matrix as mx
from wrenchcast.plans import tables as tb


def string_index(spark, sf_dir):
    """I1 over a column whose vocabulary grows with the data: the distributed
    frequency index gives StringIndexer's numbers without a driver-side label
    list (the saved model pipeline keeps its index as a table, see ml/indexer)."""
    events = tb.table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("asset"))
    return ky.frequency_index(events, "asset", "asset_index").select("event_id", "asset_index")


def metric_accuracy(spark, sf_dir):
    scored = tb.table(spark, sf_dir, "labels")
    return ev.summary_metrics(scored, label_col="quality", prediction_col="toxic")


def metric_recall(spark, sf_dir):
    scored = tb.table(spark, sf_dir, "labels")
    return ev.per_class_counts(scored, label_col="quality", prediction_col="toxic")


def _runs(spark, sf_dir):
    part = tb.table(spark, sf_dir, "part")
    return (part.groupBy(F.col("p_brand").alias("run_id"), F.col("p_type").alias("model_class"))
            .agg(F.round(F.avg(F.when(F.col("p_size") <= 25, 1.0).otherwise(0.0)), 6).alias("accuracy")))


def topk_runs(spark, sf_dir):
    return rg.top_runs_per_class(_runs(spark, sf_dir), k=2).select("model_class", "rank", "run_id", "accuracy")


def _requests(spark, sf_dir):
    events = tb.table(spark, sf_dir, "events")
    eid = F.col("event_id")
    # The day of a timestamp as text: to_date + cast equals the first 10
    # characters of the timestamp text and is cheaper per row.
    day_text = F.to_date("ts").cast("string")
    day = (F.when(eid % 13 == 0, F.regexp_replace(day_text, "-", "/"))
           .when(eid % 7 == 0, F.date_add(F.to_date("ts"), 45).cast("string"))
           .otherwise(day_text))
    return events.select(eid.alias("request_id"), F.col("user_id").alias("asset_id"), day.alias("day"))


def complete_requests(spark, sf_dir):
    """K3: every request joined once with the daily table built in one pass
    over the event log (sensor average, KPIs, presence flags)."""
    events = tb.table(spark, sf_dir, "events")
    et = F.col("event_type")
    daily = mx.daily_table_from_log(
        events, asset=F.col("user_id"), day=F.to_date("ts"), value=F.col("value"),
        is_reading=et != tb.SENSOR_EXCLUDED_TYPE, is_kpi=et.isin(*tb.KPI_TYPES),
        kpi_aggs=tb.kpi_aggregates(), value_scale=tb.VALUE_SCALE)
    valid = sc.valid_day_text("day") & F.col("asset_id").isNotNull()
    return scr.complete_requests_daily(_requests(spark, sf_dir), daily, valid=valid)


QUERIES = {
    "string_index": string_index,
    "metric_accuracy": metric_accuracy,
    "metric_recall": metric_recall,
    "topk_runs": topk_runs,
    "complete_requests": complete_requests,
}

_PER_CLASS = """(SELECT quality AS label, CAST(count(*) AS BIGINT) AS support,
        CAST(sum(CASE WHEN CAST(quality AS DOUBLE) = CAST(toxic AS DOUBLE) THEN 1 ELSE 0 END) AS BIGINT) AS correct
        FROM labels GROUP BY quality)"""

ORACLE = {
    "string_index": """WITH f AS (SELECT CAST(user_id AS VARCHAR) AS v, count(*) AS n FROM events GROUP BY 1),
        idx AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v ASC) - 1 AS DOUBLE) AS asset_index FROM f)
        SELECT e.event_id, idx.asset_index FROM events e JOIN idx ON idx.v = CAST(e.user_id AS VARCHAR)""",
    "metric_accuracy": f"""SELECT CAST(sum(support) AS BIGINT) AS n,
        round(sum(correct) / sum(support), 6) AS accuracy,
        round(sum(support * (correct / support)) / sum(support), 6) AS weighted_recall,
        round(max(CASE WHEN label = 1 THEN correct / support END), 6) AS recall_positive
        FROM {_PER_CLASS} p""",
    "metric_recall": f"SELECT label, support, correct, round(correct / support, 6) AS recall FROM {_PER_CLASS} p",
    "topk_runs": """SELECT model_class, CAST(rank AS INTEGER) AS rank, run_id, accuracy FROM (
        SELECT *, row_number() OVER (PARTITION BY model_class ORDER BY accuracy DESC NULLS LAST, run_id) AS rank
        FROM (SELECT p_brand AS run_id, p_type AS model_class,
                     round(avg(CASE WHEN p_size <= 25 THEN 1.0 ELSE 0.0 END), 6) AS accuracy
              FROM part GROUP BY p_brand, p_type) r) t WHERE rank <= 2""",
    "complete_requests": f"""
        WITH r AS (SELECT event_id AS request_id, user_id AS asset_id,
                CASE WHEN event_id % 13 = 0 THEN replace(substring(CAST(ts AS VARCHAR), 1, 10), '-', '/')
                     WHEN event_id % 7 = 0 THEN CAST(CAST(ts AS DATE) + 45 AS VARCHAR)
                     ELSE substring(CAST(ts AS VARCHAR), 1, 10) END AS day_text FROM events),
             v AS (SELECT *, coalesce(regexp_full_match(day_text, '[^-]{{4}}-[^-]{{2}}-[^-]{{2}}'), false)
                             AND asset_id IS NOT NULL AS valid FROM r),
             p AS (SELECT request_id, asset_id, day_text, valid,
                          CASE WHEN valid THEN CAST(TRY_STRPTIME(day_text, '%Y-%m-%d') AS DATE) END AS day FROM v)
        SELECT p.request_id, p.asset_id, p.day_text, p.day, s.avg_sensor,
               k.flighthours, k.flightcycles, k.delayedminutes,
               CASE WHEN NOT p.valid THEN 'invalid' WHEN s.asset_id IS NULL THEN 'no_sensor'
                    WHEN k.asset_id IS NULL THEN 'no_kpi'
                    WHEN s.avg_sensor IS NULL OR k.flighthours IS NULL OR k.flightcycles IS NULL
                         OR k.delayedminutes IS NULL THEN 'incomplete'
                    ELSE 'ok' END AS status
        FROM p LEFT JOIN {tb.SENSOR_SQL} s ON s.asset_id = p.asset_id AND s.day = p.day
               LEFT JOIN {tb.KPIS_SQL} k ON k.asset_id = p.asset_id AND k.day = p.day""",
}
