"""Registered queries of the feature-matrix family."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchcast.operators import matrix as mx
from wrenchcast.plans import tables as tb
from wrenchcast.plans.tables import (INTERRUPTIONS_SQL, KPIS_SQL,
                                     SENSOR_SQL, VALUE_SCALE)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.table(spark, sf_dir, "events")


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 on the event log: readings, KPI facts and interruptions are rows of
    ``events``, so the log is scanned and shuffled once."""
    ev = _events(spark, sf_dir)
    et = F.col("event_type")
    return mx.build_matrix_from_log(
        ev, asset=F.col("user_id"), day=F.to_date("ts"), value=F.col("value"),
        is_reading=et != tb.SENSOR_EXCLUDED_TYPE, is_kpi=et.isin(*tb.KPI_TYPES),
        is_interruption=(et == tb.INTERRUPTION_TYPE) & (F.col("value") >= tb.INTERRUPTION_MIN_VALUE),
        kpi_aggs=tb.kpi_aggregates(), value_scale=VALUE_SCALE)


def feature_matrix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 with three separate sources (sensor files, KPI table, interruption
    table in the domain); here each is a filtered view of ``events``."""
    ev = _events(spark, sf_dir)
    # The KPI view is an aggregate by (asset, day), so its keys are unique.
    return mx.build_matrix(tb.readings(ev), tb.kpis(ev), tb.interruptions(ev),
                           value_scale=VALUE_SCALE, unique_kpis=True)


def daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table request scoring joins with (K3): sensor average and
    KPIs of every (asset, day) with either, one scan of the event log."""
    ev = _events(spark, sf_dir)
    et = F.col("event_type")
    return mx.daily_table_from_log(
        ev, asset=F.col("user_id"), day=F.to_date("ts"), value=F.col("value"),
        is_reading=et != tb.SENSOR_EXCLUDED_TYPE, is_kpi=et.isin(*tb.KPI_TYPES),
        kpi_aggs=tb.kpi_aggregates(), value_scale=VALUE_SCALE)


def daily_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mx.daily_average(tb.readings(_events(spark, sf_dir)), VALUE_SCALE)


def join_inner_multikey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor averages joined with KPIs on (asset, day).

    The reference compared a day text with a DATE column; both sides are
    DATE here, so the join keys have one type and no per-row cast.
    """
    ev = _events(spark, sf_dir)
    sensor = mx.daily_average(tb.readings(ev), VALUE_SCALE)
    return sensor.join(tb.kpis(ev), mx.KEYS, "inner")


def join_band_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    sensor = mx.daily_average(tb.readings(ev), VALUE_SCALE)
    return mx.band_join_left(sensor, tb.interruptions(ev))


def label_7day(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    sensor = mx.daily_average(tb.readings(ev), VALUE_SCALE)
    return mx.label_within_horizon(sensor, tb.interruptions(ev))


def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order per customer: the earliest, ties broken by the other columns."""
    orders = tb.table(spark, sf_dir, "orders")
    return mx.first_row_per_key(orders, ["o_custkey"], ["o_orderdate"])


QUERIES = {
    "feature_matrix": feature_matrix,
    "feature_matrix_sources": feature_matrix_sources,
    "daily_table": daily_table,
    "daily_avg": daily_avg,
    "join_inner_multikey": join_inner_multikey,
    "join_band_left": join_band_left,
    "label_7day": label_7day,
    "dedup_by_key": dedup_by_key,
}

_LABEL = """CASE WHEN EXISTS (SELECT 1 FROM {l} l WHERE l.asset_id = s.asset_id
                 AND l.event_day BETWEEN s.day AND s.day + 7) THEN 1 ELSE 0 END""".format(l=INTERRUPTIONS_SQL)

_FEATURE_MATRIX_SQL = f"""
        SELECT s.asset_id, s.day, s.avg_sensor, k.flighthours, k.flightcycles, k.delayedminutes,
               {_LABEL} AS label
        FROM {SENSOR_SQL} s JOIN {KPIS_SQL} k ON s.asset_id = k.asset_id AND s.day = k.day"""

ORACLE = {
    "feature_matrix": _FEATURE_MATRIX_SQL,
    "feature_matrix_sources": _FEATURE_MATRIX_SQL,
    "daily_table": f"""
        SELECT coalesce(s.asset_id, k.asset_id) AS asset_id, coalesce(s.day, k.day) AS day, s.avg_sensor,
               k.flighthours, k.flightcycles, k.delayedminutes,
               s.asset_id IS NOT NULL AS has_sensor, k.asset_id IS NOT NULL AS has_kpi
        FROM {SENSOR_SQL} s FULL OUTER JOIN {KPIS_SQL} k ON s.asset_id = k.asset_id AND s.day = k.day""",
    "daily_avg": f"SELECT * FROM {SENSOR_SQL} s",
    "join_inner_multikey": f"""
        SELECT s.asset_id, s.day, s.avg_sensor, k.flighthours, k.flightcycles, k.delayedminutes
        FROM {SENSOR_SQL} s JOIN {KPIS_SQL} k ON s.asset_id = k.asset_id AND s.day = k.day""",
    "join_band_left": f"""
        SELECT s.asset_id, s.day, s.avg_sensor, l.event_day
        FROM {SENSOR_SQL} s LEFT JOIN {INTERRUPTIONS_SQL} l
          ON l.asset_id = s.asset_id AND l.event_day BETWEEN s.day AND s.day + 7""",
    "label_7day": f"SELECT s.asset_id, s.day, s.avg_sensor, {_LABEL} AS label FROM {SENSOR_SQL} s",
    "dedup_by_key": """
        SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                  ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST, o_orderstatus NULLS FIRST,
                           o_totalprice NULLS FIRST, o_orderpriority NULLS FIRST) AS rn
              FROM orders) t WHERE rn = 1""",
}
