"""Sensor-folder scan (A1-A3).

The reference listed the folder on the driver and built one reader per file,
then unioned them: the plan grows with the file count and each schema-less
read starts a job. Here the whole folder is ONE scan with a declared schema;
the asset id comes from each row's file name through the ``_metadata``
column, so file listing, splitting and reading are spread over executors.
"""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wrenchcast.functions.scalar import asset_from_file_name, day_text, parse_iso_day
from wrenchcast.schemas import READING_CSV, READINGS

# Fixed values of the sensor files: ';'-separated with a header row.
SENSOR_SEPARATOR = ";"
SENSOR_GLOB = "*.csv"


def read_raw_readings(spark: SparkSession, folder: str, asset_id: str | None = None,
                      recursive: bool = False) -> DataFrame:
    """Rows of every sensor CSV in ``folder`` with the file name attached.

    ``asset_id`` restricts the scan to that asset's files by name (A2) so the
    other files are never opened. A missing or empty folder gives an empty
    frame with the full schema (A3), never ``None``. ``recursive`` also reads
    sub-folders (for example one per day): millions of files are better kept
    in many folders, which Spark lists in parallel, than in one.
    """
    glob = f"*-{asset_id}.csv" if asset_id else SENSOR_GLOB
    reader = (spark.read.schema(READING_CSV)
              .option("header", True).option("sep", SENSOR_SEPARATOR)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
              .option("pathGlobFilter", glob).option("recursiveFileLookup", recursive))
    try:
        raw = reader.csv(folder)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
            raise
        empty = spark.createDataFrame([], READING_CSV)
        return empty.withColumn("file_name", F.lit(None).cast("string"))
    return raw.select("*", F.col("_metadata.file_name").alias("file_name"))


def normalise_readings(raw: DataFrame) -> DataFrame:
    """(asset_id, day, value) from raw rows.

    The day comes from the reading's own timestamp text (first 10 characters),
    never from the file name: files cross midnight and some names carry
    another date.
    """
    return raw.select(asset_from_file_name("file_name").alias("asset_id"),
                      parse_iso_day(day_text("date")).alias("day"),
                      F.col("value"))


def read_readings(spark: SparkSession, folder: str, asset_id: str | None = None, recursive: bool = False,
                  counts: Observation | None = None) -> DataFrame:
    """Readings of a sensor folder; rows without a value, a date or a well-formed
    file name are dropped here and counted by reason.

    ``counts`` is an ``Observation`` that the scan itself fills (``READING_COUNTS``):
    after the first action on the readings, ``observed_counts`` gives them, without
    another pass. ``reading_issues`` counts the same in a pass of its own.
    """
    raw = read_raw_readings(spark, folder, asset_id, recursive)
    if counts is not None:
        raw = raw.observe(counts, *_issue_counts())
    good = raw.where(~_bad_value())
    return normalise_readings(good).where("asset_id IS NOT NULL AND day IS NOT NULL").select([F.col(f.name).cast(f.dataType) for f in READINGS.fields])


def observed_counts(counts: Observation, seconds: float = 60.0) -> dict | None:
    """What the first action on the observed readings has counted; None if none reports within ``seconds``."""
    got: list[dict] = []
    waiting = threading.Thread(target=lambda: got.append(counts.get), daemon=True)
    waiting.start()
    waiting.join(seconds)
    return got[0] if got else None


def _bad_value():
    return F.col("_corrupt_record").isNotNull() | F.col("value").isNull()


def _issue_counts() -> list[Column]:
    bad = {"bad_file_name": asset_from_file_name("file_name").isNull(),
           "bad_date": parse_iso_day(day_text("date")).isNull(), "bad_value": _bad_value()}
    good = ~(bad["bad_file_name"] | bad["bad_date"] | bad["bad_value"])
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return [F.count(F.lit(1)).alias("n_rows"), count(good).alias("n_good"),
            *[count(c).alias(name) for name, c in bad.items()]]


def reading_issues(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """One row, from one pass: n_rows, n_good (what ``read_readings`` returns) and
    the rows with a bad_file_name, a bad_date and a bad_value. A row may have
    several issues and counts for each."""
    return read_raw_readings(spark, folder, recursive=recursive).agg(*_issue_counts())


def bad_reading_count(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Rows whose value is not a number: one row ``bad_rows``, counted by executors."""
    raw = read_raw_readings(spark, folder, recursive=recursive)
    return raw.agg(F.coalesce(F.sum(_bad_value().cast("int")), F.lit(0)).alias("bad_rows"))
