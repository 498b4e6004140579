"""JDBC tables (A4, A5): KPIs of the warehouse and interruption events.

The reference read each table into ONE partition (no bounds). A
``partition_column`` with bounds, or a list of predicates, splits the read into
parallel queries; filters and the column list written as Columns are pushed into
the generated SQL.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wrenchcast.functions.scalar import parse_date

# Fixed values of the reference's sources.
KPI_TABLE = "public.aircraftutilization"
INTERRUPTION_TABLE = "oldinstance.operationinterruption"
SENSOR_SUBSYSTEM = "3453"


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower_bound=None, upper_bound=None,
               num_partitions: int | None = None, predicates: list[str] | None = None,
               form: str = "options", single_read: bool = False) -> DataFrame:
    """A JDBC scan in parallel parts: ranges of ``partition_column`` (whole
    numbers, dates or timestamps; bounds as values or text) or one query per
    predicate (``plan_predicates`` makes even ones). ``single_read`` allows one unpartitioned query, for tables or
    filters known to be small; without it that is refused.

    ``form='options'`` (A5) goes through ``format('jdbc').options(...)``;
    ``form='properties'`` (A4) through ``spark.read.jdbc(url, table, ...,
    properties=...)``. Both build the same relation.
    """
    if form not in ("options", "properties"):
        raise ValueError("form must be 'options' or 'properties'")
    props = dict(properties or {})
    if predicates:
        if partition_column is not None:
            raise ValueError("give predicates or a partition_column, not both")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        props |= {"partitionColumn": partition_column, "lowerBound": str(lower_bound),
                  "upperBound": str(upper_bound), "numPartitions": str(num_partitions)}
    elif not single_read:
        raise ValueError(f"reading {table} whole would be one query in one task: give a partition_column with bounds, "
                         "or predicates, or single_read=True for a small table")
    if form == "properties":
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.format("jdbc").options(url=url, dbtable=table, **props).load()


#: A value with more than so many times a part's share of the rows is hot.
HOT_SHARE = 1.5


def plan_predicates(spark: SparkSession, url: str, table: str, column: str, num_parts: int,
                    properties: dict | None = None, split_column: str | None = None) -> list[str]:
    """Predicates for ``read_table`` that cut ``table`` into about ``num_parts`` parts of even size.

    Range bounds guess that values are spread evenly; here the database counts the
    rows of each value of ``column`` (one grouped query, so one row per distinct
    value comes back: meant for dates or codes) and the ranges follow the counts. A
    hot value gets parts of its own: ranges of ``split_column``, counted in a second
    query over the hot values only, or without one a single part. Null values are a
    part too. The parts cover every row once, also rows that are added between the
    planning and the read.
    """
    if num_parts < 1:
        raise ValueError("num_parts must be at least 1")
    quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    key = quote(column)
    counted = _counts(spark, url, properties, f"SELECT {key} AS {quote('k')}, COUNT(*) AS {quote('n')} FROM {table} "
                                              f"GROUP BY {key}").persist()
    try:
        sizes = counted.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("k").isNull(), F.col("n"))).alias("nulls")).first()
        if not sizes["all"]:
            return ["1 = 1"]
        share = max(1.0, sizes["all"] / num_parts)
        known = counted.where("k IS NOT NULL")
        hot = [(r["k"], r["n"]) for r in  # fewer than num_parts
               known.where(F.col("n") > HOT_SHARE * share).orderBy("k").collect()]
        usual = known.where(F.col("n") <= HOT_SHARE * share)
        starts = _starts(usual.select("k", "n", F.lit(0).alias("g")), share)
    finally:
        counted.unpersist()
    out = []
    lows = [low for _, low in starts]
    for low, high in zip([None, *lows[1:]], [*lows[1:], None]) if lows or not hot else []:
        apart = [f"{key} <> {_literal(v)}" for v, _ in hot if (low is None or v >= low) and (high is None or v < high)]
        out.append(" AND ".join([_range(key, low, high), *apart]))
    if not lows:  # only hot and null values now; any other value that is added meanwhile
        out = [" AND ".join([f"{key} IS NOT NULL", *[f"{key} <> {_literal(v)}" for v, _ in hot]])]
    if split_column is None:
        out += [f"{key} = {_literal(v)}" for v, _ in hot]
    elif hot:
        split = quote(split_column)
        parts = _counts(spark, url, properties, f"SELECT {key} AS {quote('g')}, {split} AS {quote('k')}, COUNT(*) AS "
                        f"{quote('n')} FROM {table} WHERE {key} IN ({', '.join(_literal(v) for v, _ in hot)}) "
                        f"GROUP BY {key}, {split}")
        ranges: dict = {v: [] for v, _ in hot}
        for g, low in _starts(parts.where("k IS NOT NULL"), share):
            ranges[g].append(low)
        for v, lows in ranges.items():
            out += [f"{key} = {_literal(v)} AND {_range(split, low, high)}"
                    for low, high in zip([None, *lows[1:]], [*lows[1:], None])] or [f"{key} = {_literal(v)} AND {split} IS NOT NULL"]
            out.append(f"{key} = {_literal(v)} AND {split} IS NULL")
    return out + [f"{key} IS NULL"]


def _counts(spark: SparkSession, url: str, properties: dict | None, query: str) -> DataFrame:
    return read_table(spark, url, f"({query}) counts", properties, single_read=True)


def _starts(counted: DataFrame, share: float) -> list[tuple]:
    """(g, first k) of ranges of about ``share`` rows inside each g, in order; ``counted`` has k, n, g."""
    inside = Window.partitionBy("g").orderBy("k")
    total = F.sum("n").over(Window.partitionBy("g"))
    pieces = F.greatest(F.lit(1), F.round(total / F.lit(share)))
    middle = F.sum("n").over(inside) - F.col("n") / 2
    part = F.floor(middle * pieces / total)
    found = counted.withColumn("part", part).groupBy("g", "part").agg(F.min("k").alias("low")).orderBy("g", "part")
    return [(r["g"], r["low"]) for r in found.collect()]  # one row per part


def _range(column: str, low, high) -> str:
    bounds = ([] if low is None else [f"{column} >= {_literal(low)}"]) + \
        ([] if high is None else [f"{column} < {_literal(high)}"])
    return " AND ".join(bounds) or f"{column} IS NOT NULL"


def _literal(value) -> str:
    """SQL text of a value, as Spark's own JDBC pushdown writes it."""
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def read_kpis(spark: SparkSession, url: str, properties: dict | None = None, table: str = KPI_TABLE,
              asset_id: str | None = None, day=None, **partitioning) -> DataFrame:
    """Daily KPIs as (asset_id, day, flighthours, flightcycles, delayedminutes);
    an optional record filter is pushed to the database (B15), and one record
    needs no partitioning. The table's natural split is its date ``timeid``."""
    if asset_id is not None and day is not None:
        partitioning.setdefault("single_read", True)
    kpis = read_table(spark, url, table, properties, **partitioning).select(
        "aircraftid", "timeid", "flighthours", "flightcycles", "delayedminutes")
    if asset_id is not None:
        kpis = kpis.where(F.col("aircraftid") == asset_id)
    if day is not None:
        kpis = kpis.where(F.col("timeid") == F.lit(day).cast("date"))
    return kpis.select(F.col("aircraftid").cast("string").alias("asset_id"),
                       F.col("timeid").cast("date").alias("day"),
                       F.col("flighthours").cast("double").alias("flighthours"),
                       F.col("flightcycles").cast("int").alias("flightcycles"),
                       F.col("delayedminutes").cast("int").alias("delayedminutes"))


def read_interruptions(spark: SparkSession, url: str, properties: dict | None = None,
                       table: str = INTERRUPTION_TABLE, subsystem: str = SENSOR_SUBSYSTEM,
                       asset_id: str | None = None, first_day=None, last_day=None, **partitioning) -> DataFrame:
    """Interruptions of one subsystem as (asset_id, event_day).

    ``first_day`` and ``last_day`` (dates or ISO text) restrict the raw start time,
    which the database evaluates; the parsed day it could not.
    """
    if asset_id is not None and first_day is not None and last_day is not None:
        partitioning.setdefault("single_read", True)
    src = read_table(spark, url, table, properties, **partitioning).where(F.col("subsystem") == subsystem)
    if asset_id is not None:
        src = src.where(F.col("aircraftregistration") == asset_id)
    # ISO text sorts like its dates, so both kinds of column compare with the day's first moment.
    kind = "string" if src.schema["starttime"].dataType.typeName() == "string" else "timestamp"
    if first_day is not None:
        src = src.where(F.col("starttime") >= F.lit(str(first_day)[:10]).cast(kind))
    if last_day is not None:
        after = dt.date.fromisoformat(str(last_day)[:10]) + dt.timedelta(days=1)
        src = src.where(F.col("starttime") < F.lit(after.isoformat()).cast(kind))
    return src.select(F.col("aircraftregistration").cast("string").alias("asset_id"),
                      parse_date(F.col("starttime").cast("string").substr(1, 10)).alias("event_day"))
