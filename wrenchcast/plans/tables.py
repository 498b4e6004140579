"""Driver tables and their mapping onto the maintenance domain.

Domain table          driver table and expression
readings              events where event_type <> 'error': user_id, day of ts, value
KPIs                  events of purchase/view/click summed and counted per user and day
interruptions         events where event_type = 'error' and value >= 100
nullable frame        orders with o_totalprice nulled for every 5th key (tables hold no nulls)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchcast.functions.scalar import exact_sum

# Fixed values of the mapping (section 7.2 of the survey).
SENSOR_EXCLUDED_TYPE = "error"
KPI_TYPES = ("purchase", "view", "click")
DELAY_TYPE = "click"
INTERRUPTION_TYPE = "error"
INTERRUPTION_MIN_VALUE = 100
# events.value and all money columns carry exactly two decimals.
VALUE_SCALE = 2

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_day() -> F.Column:
    # ts is TIMESTAMP_NTZ: the cast to DATE needs no time zone.
    return F.to_date(F.col("ts")).alias("day")


def readings(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type") != SENSOR_EXCLUDED_TYPE)
            .select(F.col("user_id").alias("asset_id"), event_day(), "value"))


def kpis(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type").isin(*KPI_TYPES))
            .groupBy(F.col("user_id").alias("asset_id"), event_day())
            .agg(exact_sum("value", VALUE_SCALE).alias("flighthours"),
                 F.count(F.lit(1)).cast("int").alias("flightcycles"),
                 F.sum((F.col("event_type") == DELAY_TYPE).cast("int")).cast("int").alias("delayedminutes")))


def interruptions(events: DataFrame) -> DataFrame:
    return (events.where((F.col("event_type") == INTERRUPTION_TYPE)
                         & (F.col("value") >= INTERRUPTION_MIN_VALUE))
            .select(F.col("user_id").alias("asset_id"), F.to_date("ts").alias("event_day")))


def kpi_aggregates() -> dict:
    """KPI columns as aggregates over the KPI rows of a key (for the one-scan matrix)."""
    return {
        "flighthours": lambda in_kpi: exact_sum(F.when(in_kpi, F.col("value")), VALUE_SCALE),
        "flightcycles": lambda in_kpi: F.sum(in_kpi.cast("int")).cast("int"),
        "delayedminutes": lambda in_kpi: F.sum((in_kpi & (F.col("event_type") == DELAY_TYPE)).cast("int")).cast("int"),
    }


def nullable_orders(orders: DataFrame) -> DataFrame:
    """Orders with nulls injected by a key rule (the driver tables hold none).

    ``o_totalprice`` is null when o_orderkey % 5 = 0 and ``o_orderstatus`` is
    null when o_orderkey % 7 = 0. All rows are kept.
    """
    k = F.col("o_orderkey")
    return orders.select(
        "o_orderkey", "o_custkey",
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority")


NULLABLE_ORDERS_SQL = """(SELECT o_orderkey, o_custkey,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
        o_orderdate, o_orderpriority FROM orders)"""

READINGS_SQL = """(SELECT user_id AS asset_id, CAST(ts AS DATE) AS day, value
        FROM events WHERE event_type <> 'error')"""

KPIS_SQL = """(SELECT user_id AS asset_id, CAST(ts AS DATE) AS day,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS flighthours,
        CAST(count(*) AS INTEGER) AS flightcycles,
        CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS INTEGER) AS delayedminutes
        FROM events WHERE event_type IN ('purchase', 'view', 'click') GROUP BY 1, 2)"""

INTERRUPTIONS_SQL = """(SELECT user_id AS asset_id, CAST(ts AS DATE) AS event_day
        FROM events WHERE event_type = 'error' AND value >= 100)"""

SENSOR_SQL = """(SELECT asset_id, day,
        round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value), 6) AS avg_sensor
        FROM """ + READINGS_SQL + """ r GROUP BY 1, 2)"""
