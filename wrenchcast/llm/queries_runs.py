"""Query of operator 11 over the whole table ``documents`` (no SQL: synchronising sets)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .word_runs import find_runs, with_periodic_tail


def greatest(runs: Column) -> Column:
    """The run of greatest exact exponent, the first of equal ones; null without runs."""
    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(more, run).otherwise(best)
    return F.when(F.size(runs) > 0, F.aggregate(runs, runs[0], better))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    found = find_runs(with_periodic_tail(docs)).withColumn("best", greatest(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        sha(listed).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
ORACLE: dict[str, str] = {}
