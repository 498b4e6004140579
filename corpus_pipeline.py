"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, source mixing, packing.

Each stage takes the rows that its predecessor kept and returns the columns of ``documents``; the last returns the
pieces of the packed sequences. Stages are written as Parquet and read again as the next one's input by whoever runs
``STAGES`` one by one; ``run`` writes them to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchcast.llm.common import word_count, write_out
from wrenchcast.llm.line_dedup import drop_emptied
from wrenchcast.llm.mixing import emit_mix
from wrenchcast.llm.packing import digest, pack_documents
from wrenchcast.llm.quality import keep_good
from wrenchcast.llm.simhash import DISTANCE, SHINGLE, keep_one

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are no outliers of their language and source."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that they share with earlier ones; emptied documents go."""
    return drop_emptied(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest doc_id."""
    return keep_one(docs, SHINGLE, DISTANCE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return emit_mix(docs, word_count(F.col("text")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return digest(pack_documents(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources), ("packing", packing),
]
#: MCD estimates, patience alignment, near-duplicate components and the packing program are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = write_out(docs)
    return docs
