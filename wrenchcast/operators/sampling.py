"""Sampling, splits, folds and partition control (H1-H6).

``sample`` and ``randomSplit`` draw per partition, so the chosen rows change
with the partitioning of the input (and therefore after a re-plan or a lost
executor). The hash forms below decide per row from its key only: the same
rows are chosen on any cluster, any partitioning, and in the SQL oracle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wrenchcast.functions.scalar import hash_bucket

#: Bits of the hash that are compared with a fraction: what a double holds exactly.
HASH_BITS = 52


def seeded_uniform(key: Column | str, seed: int, method: str = "xxhash64") -> Column:
    """A hash of the key as a whole number in [0, 2^52), to be compared with ``threshold(fraction)``."""
    k = F.col(key) if isinstance(key, str) else key
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), k), 64 - HASH_BITS)
    if method == "md5":
        digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(k.cast("string"), F.lit(""))))
        return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")
    raise ValueError("method must be 'xxhash64' or 'md5'")


def threshold(fraction: float) -> int:
    return round(fraction * (1 << HASH_BITS))


def seeded_bucket(key: Column | str, seed: int, buckets: int, method: str = "xxhash64") -> Column:
    k = F.col(key) if isinstance(key, str) else key
    if method == "xxhash64":
        return F.pmod(F.xxhash64(F.lit(seed), k), F.lit(buckets))
    if method == "md5":
        return hash_bucket(F.concat(F.lit(f"{seed}:"), k.cast("string")), buckets)
    raise ValueError("method must be 'xxhash64' or 'md5'")


def hash_sample(df: DataFrame, key: Column | str, fraction: float, seed: int = 0,
                method: str = "xxhash64") -> DataFrame:
    """Bernoulli-like sample without replacement, reproducible per key (H1).

    52 bits of the hash are compared with the fraction, so fractions of a billionth still draw their share.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    return df.where(seeded_uniform(key, seed, method) < F.lit(threshold(fraction)))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int | None = None,
                     with_replacement: bool = False) -> DataFrame:
    """Spark's per-partition sample (H1 as in the reference). The chosen rows
    depend on the partitioning; ``hash_sample`` is the reproducible form."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def hash_split_column(df: DataFrame, key: Column | str, weights: Sequence[float] = (0.8, 0.2),
                      names: Sequence[str] = ("train", "test"), seed: int = 0,
                      name: str = "split", method: str = "xxhash64") -> DataFrame:
    """Label every row with its split (H2); no row is dropped."""
    if len(weights) != len(names) or not weights:
        raise ValueError("one name per weight, and at least one")
    if any(not 0.0 <= w < float("inf") for w in weights) or not sum(weights):
        raise ValueError("weights must be finite, not negative and not all zero")
    total = float(sum(weights))
    uniform = seeded_uniform(key, seed, method)
    expr, acc = None, 0.0
    for w, n in zip(weights[:-1], names[:-1]):
        acc += w / total
        cond = uniform < F.lit(threshold(acc))
        expr = F.when(cond, F.lit(n)) if expr is None else expr.when(cond, F.lit(n))
    expr = F.lit(names[-1]) if expr is None else expr.otherwise(F.lit(names[-1]))
    return df.withColumn(name, expr)


def hash_split(df: DataFrame, key: Column | str, weights: Sequence[float] = (0.8, 0.2),
               seed: int = 0, method: str = "xxhash64") -> list[DataFrame]:
    """``randomSplit`` that depends only on the key: disjoint, complete."""
    names = [f"s{i}" for i in range(len(weights))]
    tagged = hash_split_column(df, key, weights, names, seed, "_split", method)
    return [tagged.where(F.col("_split") == n).drop("_split") for n in names]


def hash_folds(df: DataFrame, key: Column | str, k: int = 3, seed: int = 0, name: str = "fold",
               method: str = "xxhash64") -> DataFrame:
    """Fold number in [0, k) per row for k-fold cross validation (I8 ``foldCol``)."""
    return df.withColumn(name, F.pmod(seeded_bucket(key, seed, 1 << 30, method), F.lit(k)).cast("int"))


def by_day_split(df: DataFrame, day_col: str, first_test_day) -> list[DataFrame]:
    """Split by time: train strictly before ``first_test_day``, test from it on.
    Avoids the leakage of adjacent days (which share labels) across sides."""
    d = F.col(day_col)
    cut = F.lit(first_test_day).cast("date")
    return [df.where(d < cut), df.where(d >= cut)]


def repartition_by(df: DataFrame, n: int | None = None, *cols: str) -> DataFrame:
    """Shuffle to ``n`` partitions, by columns when given (H3)."""
    if cols:
        return df.repartition(n, *cols) if n else df.repartition(*cols)
    return df.repartition(n)


def shrink_partitions(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions without a shuffle (H4)."""
    return df.coalesce(n)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition, computed by the executors (H5) instead of
    ``glom().collect()`` which brings every row to the driver."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
