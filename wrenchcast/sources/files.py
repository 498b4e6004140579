"""CSV / JSON / Parquet readers, rows-to-frame, the stored matrix."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrenchcast.operators.matrix import cast_matrix
from wrenchcast.schemas import MATRIX, MATRIX_CSV
from wrenchcast.sources.store import MatrixStore


def read_csv(spark: SparkSession, path: str, header: bool = True, sep: str = ",",
             schema: T.StructType | str | None = None, infer_schema: bool = False,
             quote: str | None = None, escape: str | None = None) -> DataFrame:
    """CSV folder or file (A6-A9). Prefer a declared ``schema``: inference reads
    the data an extra time and filters are pushed to the scan only with one."""
    reader = spark.read.option("header", header).option("sep", sep)
    if quote is not None:
        reader = reader.option("quote", quote)
    if escape is not None:
        reader = reader.option("escape", escape)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(path)


def rows_to_frame(spark: SparkSession, rows: Iterable, schema: T.StructType | str | Sequence[str] | None = None) -> DataFrame:
    """Small literal data to a frame (A10): tuples, tuples with names, or dicts
    with missing keys (missing becomes null). For fixtures and lookups only."""
    rows = list(rows)
    if rows and isinstance(rows[0], dict) and schema is None:
        names = []
        for r in rows:
            for k in r:
                if k not in names:
                    names.append(k)
        rows = [tuple(r.get(k) for k in names) for r in rows]
        schema = names
    return spark.createDataFrame(rows, schema=list(schema) if isinstance(schema, tuple) else schema)


def read_matrix(spark: SparkSession, path: str, fmt: str = "parquet", days: tuple | None = None) -> DataFrame:
    """Reload the stored feature matrix with its types.

    Parquet keeps types and is partitioned by month. ``days=(first, last)``
    keeps those days and also filters the ``month`` partition column, so only
    the matching month folders are listed and read (Spark cannot derive a
    month filter from a day filter by itself). The reference's CSV layout
    (``aircraft id``, text ``date``) is read with a declared schema and renamed.
    Where ``path`` holds versions (``sources.store``), the current one is read.
    """
    if fmt == "parquet":
        store = MatrixStore(spark, path)
        df = spark.read.parquet(store.matrix_path() if store.exists() else path)
        if days is not None:
            first, last = (F.lit(d).cast("date") for d in days)
            df = df.where(F.col("month").between(F.date_format(first, "yyyy-MM"), F.date_format(last, "yyyy-MM"))
                          & F.col("day").between(first, last))
        return df.select(*[F.col(f.name).cast(f.dataType) for f in MATRIX.fields])
    df = spark.read.schema(MATRIX_CSV).option("header", True).csv(path)
    df = cast_matrix(df.withColumnsRenamed({"aircraft id": "asset_id", "date": "day"}))
    if days is not None:
        df = df.where(F.col("day").between(*(F.lit(d).cast("date") for d in days)))
    return df
