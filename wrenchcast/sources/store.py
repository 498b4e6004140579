"""The stored daily table and matrix as versioned pairs.

A management run writes both tables into a folder of its own and only then appends one row to the manifest. Readers
take the pair that the newest manifest row names, so they never see half a pair: a run that dies between the two writes
leaves files that no row names, and a reader that has opened a version keeps it while the next one is written.

    <root>/versions/<version>/daily     partitioned by day
    <root>/versions/<version>/matrix    partitioned by month
    <root>/manifest                     one Parquet row per committed version
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wrenchcast.schemas import MANIFEST, READING_COUNTS


class MatrixStore:
    """Versions of the daily table and the matrix under one shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def exists(self) -> bool:
        """Whether a version has ever been committed here."""
        fs, path = self._folder("manifest")
        return fs.exists(path)

    @staticmethod
    def new_version() -> str:
        return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def path(self, version: str, table: str) -> str:
        return f"{self.root}/versions/{version}/{table}"

    def manifest(self) -> DataFrame:
        """All committed versions; an empty table before the first one."""
        if not self.exists():
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")

    def commit(self, version: str, horizon_days: int, counts: dict | None = None) -> None:
        """Make ``version`` the current one; ``counts`` are those of the readings it was made from."""
        row = (version, dt.datetime.now(), horizon_days, *((counts or {}).get(c) for c in READING_COUNTS))
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")

    def current(self) -> Row:
        """The newest manifest row."""
        newest = self.manifest().orderBy(F.desc("committed_at"), F.desc("version")).head()
        if newest is None:
            raise LookupError(f"no version has been committed under {self.root}")
        return newest

    def daily(self, version: str | None = None) -> DataFrame:
        return self.spark.read.parquet(self.path(version or self.current()["version"], "daily"))

    def matrix_path(self, version: str | None = None) -> str:
        return self.path(version or self.current()["version"], "matrix")

    def expire(self, keep: int = 2, uncommitted: bool = False) -> list[str]:
        """Delete the folders of all but the newest ``keep`` committed versions, and return their names.

        Folders that no manifest row names belong to a run that is still writing or has died; they go only with
        ``uncommitted``. Manifest rows stay, as the record of what there was.
        """
        if keep < 1:
            raise ValueError("keep must be at least 1")
        fs, folder = self._folder("versions")
        if not fs.exists(folder):
            return []
        rows = self.manifest().orderBy(F.desc("committed_at"), F.desc("version")).select("version").collect()
        committed = [r["version"] for r in rows]  # one per management run
        there = sorted(s.getPath().getName() for s in fs.listStatus(folder))
        gone = [v for v in there if v not in committed[:keep] and (uncommitted or v in committed)]
        for version in gone:
            fs.delete(self._folder("versions", version)[1], True)
        return gone
