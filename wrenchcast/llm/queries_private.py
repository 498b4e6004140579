"""Query of operator 12 over the whole table ``documents`` (no SQL: bootstrapping in rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .private_data import KINDS, as_text, find_private


def op12_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(read_table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(as_text("base").cast("binary"), 256).alias("base_sha256"), as_text("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_learned"))


QUERIES = {"op12_private_data": op12_private_data}
ORACLE: dict[str, str] = {}
