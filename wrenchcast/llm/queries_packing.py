"""Query of operator 10 over the whole table ``documents`` (no SQL: tokenizer and dynamic program)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import read_table
from .packing import digest, pack_documents


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack_documents(read_table(spark, sf_dir, "documents")))


QUERIES = {"op10_packing": op10_packing}
ORACLE: dict[str, str] = {}
