"""Writers (A13-A15, A18) and catalog helpers.

All writes are done by the executors; ``mode('overwrite')`` deletes the old folder
before the new files are committed (the reference tried ``os.remove`` on a
folder, which fails), so readers of a folder in use need a new path per write; the
management stage's tables get one through ``sources.store``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              num_files: int | None = None, sep: str = ",") -> None:
    """CSV with a header (A13); ``num_files`` controls the file count."""
    out = df.repartition(num_files) if num_files else df
    out.write.mode(mode).option("header", header).option("sep", sep).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", num_files: int | None = None) -> None:
    out = df.repartition(num_files) if num_files else df
    out.write.mode(mode).json(path)


def write_matrix(matrix: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store the matrix as Parquet partitioned by month of ``day``: a reload
    with ``read_matrix(days=...)`` reads only the matching month folders. A range shuffle on
    (day, asset_id) gives each task a run of consecutive days, so a folder
    gets few files and a busy month is still written by several tasks."""
    month = F.date_format("day", "yyyy-MM")
    (matrix.repartitionByRange("day", "asset_id").withColumn("month", month)
     .write.mode(mode).partitionBy("month").parquet(path))


def write_daily(daily: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store the daily table partitioned by ``day``: scoring a batch of
    requests reads only the folders of the requested days. Range-partitioned
    on (day, asset_id) so each task writes a run of consecutive days."""
    (daily.repartitionByRange("day", "asset_id")
     .write.mode(mode).partitionBy("day").parquet(path))


def write_matrix_csv(matrix: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The reference's layout: CSV with header, ``aircraft id`` and text ``date``."""
    out = matrix.select(F.col("asset_id").alias("aircraft id"), F.col("day").cast("string").alias("date"),
                        "avg_sensor", "flighthours", "flightcycles", "delayedminutes", "label")
    write_csv(out, path, mode)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """New rows go to a new frame or an appended write, never INSERT into a view."""
    df.write.mode("append").format(fmt).save(path)


def register_view(df: DataFrame, name: str) -> None:
    """Temp view for SQL text."""
    df.createOrReplaceTempView(name)


def catalog_overview(spark: SparkSession) -> dict:
    """Databases and tables of the session catalog (A17): small metadata."""
    return {
        "databases": [d.name for d in spark.catalog.listDatabases()],
        "current": spark.catalog.currentDatabase(),
        "tables": [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()],
    }


def describe_database(spark: SparkSession, name: str | None = None) -> DataFrame:
    return spark.sql(f"DESCRIBE DATABASE EXTENDED {name or spark.catalog.currentDatabase()}")
