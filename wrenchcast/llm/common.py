"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..session import write_table as write_out  # noqa: F401  the operators' way to a written table

WORD_BREAK = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(col, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not ASCII white space; 0 for null."""
    runs = F.split(F.coalesce(text, F.lit("")), WORD_BREAK)
    empty_first = F.coalesce(text, F.lit("")).rlike("^" + WORD_BREAK) | (F.coalesce(text, F.lit("")) == "")
    empty_last = text.rlike(WORD_BREAK + "\\z")
    return (F.size(runs) - empty_first.cast("int") - F.coalesce(empty_last, F.lit(False)).cast("int")).cast("long")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="wrenchcast-")) / "wrenchcast_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Column names like ``names`` that collide with none of ``taken`` (case-insensitive, as Spark resolves)."""
    used = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark's own default of spark.sql.autoBroadcastJoinThreshold: a table is only broadcast by hint below this many bytes.
BROADCAST_BYTES = 10 << 20


def hint_broadcast(df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    """Broadcast ``df`` when its counted rows prove it small; else the join stays a shuffle join, split by AQE on skew."""
    return F.broadcast(df) if rows * bytes_per_row <= BROADCAST_BYTES else df
