"""Queries of operators 4 and 7 over the whole table ``documents`` (no SQL: exchange clustering, n-gram filters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import class_lm
from .common import read_table
from .language_id import held_out, identify, train


def op4_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), 5, 1).alias("held_out"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return class_lm.train_and_score(docs).drop("perplexity")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = docs.withColumn("held_out", held_out(F.col("doc_id"), 3, 1))
    model = train(rows.where("not held_out"))
    return identify(rows.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op4_class_lm": op4_class_lm, "op7_language_id": op7_language_id}
ORACLE: dict[str, str] = {}
