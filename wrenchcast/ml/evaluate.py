"""Classification metrics as aggregates.

The reference ran the model once per metric. Here one pass over the scored
rows gives per-class counts (a handful of rows), and every metric is derived
from them: accuracy, weighted recall (equal to accuracy by definition) and
the recall of each class, which is what a maintenance alert needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_class_counts(scored: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """label, support, correct, recall: one row per true class."""
    correct = (F.col(label_col).cast("double") == F.col(prediction_col).cast("double")).cast("int")
    return (scored.groupBy(F.col(label_col).alias("label"))
            .agg(F.count(F.lit(1)).alias("support"), F.sum(correct).alias("correct"))
            .withColumn("recall", F.round(F.col("correct") / F.col("support"), 6)))


def summary_metrics(scored: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
                    positive=1) -> DataFrame:
    """One row: n, accuracy, weighted_recall, recall_positive."""
    per = per_class_counts(scored, label_col, prediction_col)
    n = F.sum("support")
    return per.agg(
        F.coalesce(n, F.lit(0)).alias("n"),
        F.round(F.sum("correct") / n, 6).alias("accuracy"),
        F.round(F.sum(F.col("support") * (F.col("correct") / F.col("support"))) / n, 6).alias("weighted_recall"),
        F.round(F.max(F.when(F.col("label") == F.lit(positive), F.col("correct") / F.col("support"))), 6)
        .alias("recall_positive"))
