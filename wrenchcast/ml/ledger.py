"""A record of finished fits, from which an interrupted grid search goes on (I8, K2).

One row per (model, grid point, fold) in a Parquet table beside the runs. A search has a name; begun again under the same
name it reads what is recorded and fits only the rest. The rows carry a key of the training rows and of the options that
decide a fit, so a search is never continued on other data.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchcast.schemas import FITS

Point = tuple[int, int]  # depth, bins


def rows_key(rows: DataFrame, *options) -> str:
    """A checksum of the rows, whatever their order and partitions, and of the options: one aggregate."""
    each = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(each).alias("x"),
                     F.sum(F.shiftrightunsigned(each, 20)).alias("s")).first()
    return f"{found['n']}:{found['x']}:{found['s']}:{options!r}"


class FitLedger:
    def __init__(self, spark: SparkSession, root: str, search_id: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/fits"
        self.search_id = search_id
        self._writing = threading.Lock()  # appends to one folder must not overlap

    def fits(self) -> DataFrame:
        """The recorded fits of all searches; an empty table before the first one."""
        try:
            return self.spark.read.schema(FITS).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], FITS)

    def done(self, model: str, data_key: str) -> dict[tuple[Point, int], float]:
        """Accuracy by (grid point, fold) of this search's fits of one model; at most the grid times the folds."""
        rows = self.fits().where((F.col("search_id") == self.search_id) & (F.col("model") == model)).collect()
        if any(r["data_key"] != data_key for r in rows):
            raise ValueError(f"search {self.search_id!r} was begun with other rows or options; use another search_id")
        return {((r["max_depth"], r["max_bins"]), r["fold"]): r["accuracy"] for r in rows}

    def record(self, model: str, data_key: str, point: Point, fold: int, accuracy: float) -> None:
        row = (self.search_id, data_key, model, *point, fold, accuracy, dt.datetime.now())
        with self._writing:
            self.spark.createDataFrame([row], FITS).coalesce(1).write.mode("append").parquet(self.path)
