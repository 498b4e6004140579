"""Query of operator 13 over the whole table ``embeddings`` (no SQL: eigenvectors)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import read_table
from .whitening import whiten


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {"op13_whitening": op13_whitening}
ORACLE: dict[str, str] = {}
