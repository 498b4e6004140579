"""Queries of operators 3, 5, 6 and 9 over the whole table ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .exact_dedup import exact_groups
from .line_dedup import dedup_lines
from .repeat_dedup import without_repeats
from .simhash import near_components


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_deleted", "n_partners",
                                    F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(read_table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read_table(spark, sf_dir, "documents")).drop("spans", "kept")


OP5_SQL = """
with t as (select doc_id, coalesce(text, '') as t from documents),
g as (select doc_id, t, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size from t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from g
"""

QUERIES = {"op3_line_dedup": op3_line_dedup, "op5_exact_dedup": op5_exact_dedup, 
           "op6_simhash_near_dedup": op6_simhash_near_dedup, "op9_suffix_array_dedup": op9_suffix_array_dedup}
ORACLE = {"op5_exact_dedup": OP5_SQL}
