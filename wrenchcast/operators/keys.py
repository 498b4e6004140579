"""Row keys: a unique surrogate (B5) and a stable, consecutive row number by a
total order (used for ranks of sorted output, E1) without moving all rows into
one partition.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wrenchcast.operators.ranges import range_bucket
from wrenchcast.session import write_table

#: Ranges for each shuffle partition in ``add_row_number``: more ranges than tasks even out what hashing deals a task.
RANGES_PER_TASK = 2


def add_surrogate_key(df: DataFrame, name: str = "key") -> DataFrame:
    """Unique 64-bit id, not consecutive: partition index in the upper bits,
    row index inside the partition in the lower 33 bits (B5)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def add_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "row_num",
                   num_partitions: int | None = None) -> DataFrame:
    """1-based row number by ``order`` (must be a total order), distributed and lazy.

    ``row_number() OVER (ORDER BY ...)`` without PARTITION BY sorts every row in
    one task. Instead:
      1. ``range_bucket`` cuts the order into ranges of about equal counts, by
         split points that are a subquery of the plan;
      2. rows are counted per range (a partial aggregate, one row per range);
      3. prefix sums of these counts (as many rows as ranges, a proven bound)
         are broadcast;
      4. number = offset of the range + position inside it, the rows' only
         shuffle.
    Nothing runs or is written when the frame is built, and columns that a query
    does not need are not read. ``df`` is read once more than ``range_bucket``
    does; when it is costly to compute, or not the same on each read, write it
    first. ``num_partitions`` (the session's shuffle partitions without it) sets
    how many tasks the ranges are for; the numbers do not depend on it.
    """
    parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = range_bucket(df, order, RANGES_PER_TASK * parts, "_range")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    columns = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    return (ranged.select("*", inside.alias("_place")).join(F.broadcast(offsets), "_range", "left")
            .select(*columns, (F.col("_place") + F.col("_off")).alias(name)))


def value_ranks(df: DataFrame, column: str, name: str, written: bool = False) -> DataFrame:
    """Each distinct value of ``column`` with its rank by falling frequency, ties by ascending value, nulls last, as a
    DOUBLE from 0. Counts are a partial aggregate, ranks the distributed row number over them; ``written`` counts first,
    in a job of its own, so that a large ``df`` is read once."""
    counts = df.groupBy(F.col(column)).agg(F.count(F.lit(1)).alias("_n"))
    counts = write_table(counts) if written else counts
    order = [F.col(column).isNull().asc(), F.desc("_n"), F.asc(column)]
    return add_row_number(counts, order, "_rank").select(column, (F.col("_rank") - 1).cast("double").alias(name))


def frequency_index(df: DataFrame, column: str, name: str = "index") -> DataFrame:
    """Index of each value by descending frequency, ties by ascending text, as
    a DOUBLE from 0: the numbers ``StringIndexer(stringOrderType='frequencyDesc')``
    gives (I1), without bringing the vocabulary to the driver.

    The index (``value_ranks``) goes back to the rows with a join that AQE may
    broadcast when the vocabulary is small. Nulls get the index after the last
    value, like ``handleInvalid='keep'``.
    """
    text = F.col(column).cast("string")
    ranked = value_ranks(df.select(text.alias("_v")), "_v", name)
    out = df.withColumn("_value", text).join(ranked, F.col("_value").eqNullSafe(F.col("_v")), "left")
    return out.drop("_value", "_v")
