"""Equal-count ranges of a total order, as one lazy column.

``range_bucket`` numbers the ranges of a frame's order from 0. Nothing runs when it is called: the split points are a
scalar subquery inside the plan, so every branch of a query that uses the column sees the same ranges. They come from a
sample chosen by a hash of the sort key, which depends on the rows alone, not on partitions or task order: a branch that
computes them anew, or a task that is repeated after a lost executor, gets the same points.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sampled rows for each range: with 16, the largest range has about twice its share.
OVERSAMPLE = 16
_BITS = 52
_UNROLLED = 64  # up to so many ranges the search is compiled
_LARGEST = 1.7976931348623157e308


@dataclass(frozen=True)
class SortKey:
    value: Column
    descending: bool = False
    nulls_last: bool = False

    @staticmethod
    def of(order: Column | str | SortKey) -> SortKey:
        """A column name, a column (ascending, nulls first), or one with ``.asc()``, ``.desc()`` and so on."""
        if isinstance(order, SortKey):
            return order
        if isinstance(order, str):
            return SortKey(F.col(order))
        node = order._jc.node()
        if not node.getClass().getName().endswith(".SortOrder"):
            return SortKey(order)
        return SortKey(_child(node), "Descending" in node.sortDirection().toString(),
                       "NullsLast" in node.nullOrdering().toString())

    def rising(self, kind: T.DataType) -> Column | None:
        """A column whose plain ascending order is this key's; None for a descending one without such a column."""
        value = self.value
        if self.descending:
            if isinstance(kind, T.IntegralType):
                value = F.bitwise_not(value)
            elif isinstance(kind, T.DateType):
                value = F.bitwise_not(F.unix_date(value))
            elif isinstance(kind, T.TimestampType):
                value = F.bitwise_not(F.unix_micros(value))
            elif isinstance(kind, T.DecimalType):
                value = -value
            elif isinstance(kind, T.FractionalType):  # NaN is the largest value, so the first one here
                value = (F.when(F.isnan(value), F.lit(float("-inf")))
                         .when(value == float("inf"), F.lit(-_LARGEST)).otherwise(-value))
            else:
                return None
        if not self.nulls_last:
            return value
        return F.struct(self.value.isNull().alias("n"), value.alias("v"))


def _child(node) -> Column:
    from pyspark import SparkContext
    return Column(SparkContext._active_spark_context._jvm.org.apache.spark.sql.Column(node.child()))


def _not_above(split: Column, key: Column, keys: Sequence[SortKey]) -> Column:
    """Whether the split point is not above the row's key, part by part (for descending text)."""
    below = F.lit(True)  # all parts equal
    for i, part in reversed(list(enumerate(keys))):
        its, mine = split[f"k{i}"], key[f"k{i}"]
        nearer = (its > mine) if part.descending else (its < mine)
        null_first = its.isNull() & mine.isNotNull() & F.lit(not part.nulls_last)
        null_last = mine.isNull() & its.isNotNull() & F.lit(part.nulls_last)
        below = F.coalesce(nearer, F.lit(False)) | null_first | null_last | (its.eqNullSafe(mine) & below)
    return below


def _tree(low: int, high: int) -> str:
    """The search as nested comparisons, which Spark compiles; a split point that is not there sends a row down."""
    if high - low == 1:
        return str(low)
    middle = (low + high) // 2
    return f"CASE WHEN get(_splits, {middle - 1}) <= _key THEN {_tree(middle, high)} ELSE {_tree(low, middle)} END"


def range_bucket(df: DataFrame, order: Sequence[Column | str | SortKey], buckets: int, name: str) -> DataFrame:
    """``df`` with ``name``: the number, below ``buckets``, of its range of ``order``.

    Rows of a lower number come before those of a higher one; rows with equal keys share their number, so keys should
    be (nearly) unique. The plan reads ``df`` three times: to count its rows, to sample ``OVERSAMPLE`` keys for each
    range, and for the result; it must give the same rows each time. The sample, and so what one task sorts and every
    task holds as split points, is bounded by ``buckets``, not by the rows. A row finds its range by log2(buckets)
    comparisons.
    """
    keys = [SortKey.of(o) for o in order]
    kinds = [f.dataType for f in df.select(*[k.value.alias(f"k{i}") for i, k in enumerate(keys)]).schema.fields]
    rising = [k.rising(kind) for k, kind in zip(keys, kinds)]
    plain = all(r is not None for r in rising)
    parts = [(r if plain else k.value).alias(f"k{i}") for i, (k, r) in enumerate(zip(keys, rising))]
    key = parts[0] if plain and len(parts) == 1 else F.struct(*parts)
    if plain:
        by = [F.col("_key").asc()]
    else:
        direction = {(False, False): "asc_nulls_first", (False, True): "asc_nulls_last",
                     (True, False): "desc_nulls_first", (True, True): "desc_nulls_last"}
        by = [getattr(F.col(f"_key.k{i}"), direction[k.descending, k.nulls_last])() for i, k in enumerate(keys)]
    total = df.agg(F.count(F.lit(1))).scalar()
    chosen = F.try_divide(F.lit(float(OVERSAMPLE * buckets * (1 << _BITS))), total)
    sample = df.select(key.alias("_key")).where(F.shiftrightunsigned(F.xxhash64("_key"), 64 - _BITS) < chosen)
    ranked = sample.select(F.struct(F.row_number().over(Window.orderBy(*by)).alias("rank"), F.col("_key").alias("key"))
                           .alias("at"), F.count(F.lit(1)).over(Window.partitionBy()).alias("size"))
    step = F.ceil(F.col("size") / F.lit(buckets))
    found = F.collect_list(F.when((F.col("at.rank") > 1) & ((F.col("at.rank") - 1) % step == 0), F.col("at")))
    splits = ranked.agg(F.transform(F.array_sort(found), lambda s: s["key"])).scalar()
    if plain and buckets <= _UNROLLED:
        at = F.expr(_tree(0, buckets))
    else:
        steps = F.array(*[F.lit(1 << k) for k in reversed(range((buckets - 1).bit_length()))])

        def further(at: Column, step: Column) -> Column:
            split = F.get("_splits", at + step - 1)
            within = (split <= F.col("_key")) if plain else _not_above(split, F.col("_key"), keys)
            return at + F.when((at + step <= F.size("_splits")) & within, step).otherwise(0)

        at = F.aggregate(steps, F.lit(0), further)
    if plain and len(parts) == 1:  # a null key is below every split point that is not null
        at = F.when(F.col("_key").isNull(), F.lit(0)).otherwise(at)
    return (df.select("*", key.alias("_key"), splits.alias("_splits"))
            .select(*[F.col(f"`{c}`") for c in df.columns], at.alias(name)))
