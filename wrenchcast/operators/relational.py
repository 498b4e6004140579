"""Everyday relational operators as small functions over DataFrames.

Each function takes and returns DataFrames and builds the plan with
DataFrame / SQL expressions only, so Catalyst can push filters and column
pruning down to the scan and keep the work in whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wrenchcast.functions.scalar import exact_sum
from wrenchcast.operators.ranges import range_bucket
from wrenchcast.session import write_table

# --------------------------------------------------------------------------
# Projections and columns
# --------------------------------------------------------------------------


def project(df: DataFrame, *cols) -> DataFrame:
    """``select`` by name, Column or ``*`` (B1, B2)."""
    return df.select(*cols)


def with_derived(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add computed columns in one projection."""
    return df.withColumns(dict(columns))


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column; the value is wrapped with ``lit`` (a bare value is not a Column)."""
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = True) -> DataFrame:
    """Cast named columns (B9). ``safe`` uses ``try_cast``: with ANSI mode a bad
    value would otherwise fail the whole job; here it becomes null."""
    out = []
    for c in df.columns:
        if c in types:
            col = F.col(c).try_cast(types[c]) if safe else F.col(c).cast(types[c])
            out.append(col.alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def presence_flag(df: DataFrame, name: str, column: str) -> DataFrame:
    """``CASE WHEN column IS NOT NULL THEN 1 ELSE 0 END`` as an int column."""
    return df.withColumn(name, F.expr(f"CASE WHEN `{column}` IS NOT NULL THEN 1 ELSE 0 END"))


def pack_struct(df: DataFrame, name: str, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Pack columns into one struct column."""
    return df.select(*keep, F.struct(*cols).alias(name))


def unpack_struct(df: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """Struct fields back to top-level columns."""
    return df.select(*keep, f"{name}.*")


def explode_positions(df: DataFrame, array_col: Column, keep: Sequence[str],
                      pos: str = "pos", value: str = "value", outer: bool = False) -> DataFrame:
    """One row per array element with its 0-based position."""
    gen = F.posexplode_outer(array_col) if outer else F.posexplode(array_col)
    return df.select(*keep, gen.alias(pos, value))


# --------------------------------------------------------------------------
# Filters and null handling
# --------------------------------------------------------------------------


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def filter_record(df: DataFrame, key_col: str, key, day_col: str | None = None, day=None) -> DataFrame:
    """Optional record filter: chained ``where`` on the key and the day.

    Catalyst merges the two predicates and pushes both to the scan."""
    out = df.where(F.col(key_col) == F.lit(key))
    if day_col is not None and day is not None:
        out = out.where(F.col(day_col) == F.lit(day))
    return out


def filter_sql(df: DataFrame, predicate: str) -> DataFrame:
    """SQL-text predicate; only rows where it is TRUE are kept."""
    return df.where(predicate)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    return df.na.drop(how=how, subset=list(subset) if subset else None)


def fill_nulls(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    """``fillna`` with one value on named columns, or a dict per column."""
    if isinstance(value, Mapping):
        return df.na.fill(dict(value))
    return df.na.fill(value, subset=list(subset) if subset else None)


def replace_values(df: DataFrame, to_replace: Sequence, value: Sequence, subset: Sequence[str]) -> DataFrame:
    """Replace listed values (never null) on a subset; a replacement may be null."""
    return df.na.replace(list(to_replace), list(value), subset=list(subset))


def enforce_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Declared schema on existing data (A11): cast every field, and fail the
    job (lazily, inside the plan) when a NOT NULL field holds a null.

    No RDD or driver round trip: the check is a Column expression.
    """
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    cols = []
    for field in schema.fields:
        c = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"field {field.name} is NOT NULL but got null"))
                       .cast(field.dataType)).otherwise(c)
        cols.append(c.alias(field.name))
    return df.select(*cols)


# --------------------------------------------------------------------------
# Joins (C1-C8)
# --------------------------------------------------------------------------


def equi_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join on column names or a list of conditions; null keys never match."""
    return left.join(right, on, how)


def lookup_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                how: str = "inner", dim_is_bounded: bool = False) -> DataFrame:
    """Fact-to-lookup join on one key.

    The broadcast is forced only when the caller vouches the lookup has a
    fixed size (a code table); otherwise Catalyst and AQE decide from
    statistics and the runtime size of the shuffled side, falling back to a
    sort-merge join when the lookup is large.
    """
    side = F.broadcast(dim) if dim_is_bounded else dim
    return fact.join(side, fact[fact_key] == side[dim_key], how)


def duplicate_keys(dim: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once in a lookup table, with their count.
    A join against such a table repeats fact rows (SQL semantics); run this
    to check a lookup before relying on one match per fact row."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_unique_keys(dim: DataFrame, *keys: str, show: int = 5) -> None:
    """Raise ValueError when a lookup key repeats; an explicit action that
    brings back at most ``show`` offending keys."""
    dupes = duplicate_keys(dim, *keys).orderBy(F.desc("n"), *keys).limit(show).collect()
    if dupes:
        raise ValueError(f"lookup keys {list(keys)} repeat: " + ", ".join(str(tuple(r)) for r in dupes))


def cross_product_count(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row count of the cross product (C6) without forming any pair:
    count(left) x count(right) from one aggregate over the tagged union of
    both inputs; no join and no pair is formed."""
    tagged = (left.select(F.lit(1).alias("_l"), F.lit(0).alias("_r"))
              .unionByName(right.select(F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    n = [F.coalesce(F.sum(c), F.lit(0)) for c in ("_l", "_r")]
    return tagged.agg((n[0] * n[1]).alias("n_pairs"))


# --------------------------------------------------------------------------
# Aggregations
# --------------------------------------------------------------------------


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per group; a null key is its own group (D3)."""
    return df.groupBy(*keys).count()


def group_max(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max(c).alias(f"max_{c}") for c in cols])


def count_star_and_col(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """``count(*)`` counts nulls, ``count(col)`` does not."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count(col).alias(f"n_{col}"))


def global_agg(df: DataFrame, *aggs: Column) -> DataFrame:
    """Aggregate without keys: one row."""
    return df.agg(*aggs) if aggs else df.agg(F.count(F.lit(1)).alias("count"))


def describe_stats(df: DataFrame, cols: Sequence[str], value_scale: int | None = None) -> DataFrame:
    """count, mean, stddev (sample), min, max per column as typed rows.

    One aggregation pass computes every statistic of every column; the wide
    row is then turned into one row per column (explode of an array of
    structs). Without ``value_scale`` mean and stddev are Spark's
    numerically stable ``avg`` / ``stddev_samp``. With ``value_scale`` (inputs
    with that many decimals) the sums of units and of their squares are exact
    DECIMALs, and the variance's numerator n*q - s*s is taken in DECIMAL too, so
    nothing cancels and nothing depends on task order; mean and stddev are
    rounded to 6 digits.
    """
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        if value_scale is None:
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"sd{i}")]
        else:
            d = F.col(c).cast(f"decimal(18,{value_scale})")
            units = (d * F.lit(10 ** value_scale)).cast("decimal(18,0)")
            aggs += [exact_sum(c, value_scale).alias(f"s{i}"), F.sum(units).cast("decimal(38,0)").alias(f"u{i}"),
                     F.sum(units * units).cast("decimal(38,0)").alias(f"q{i}")]
    wide = df.agg(*aggs)
    parts = []
    for i, c in enumerate(cols):
        n = F.col(f"n{i}")
        if value_scale is None:
            mean, std = F.col(f"m{i}"), F.col(f"sd{i}")
        else:
            mean = F.round(F.col(f"s{i}") / F.nullif(n, F.lit(0)), 6)
            # With s = whole * n + rest the sum of squared deviations is q - whole * (s + rest) - rest^2 / n,
            # whose first two terms are exact and of the size of the result.
            whole = F.floor(F.col(f"u{i}") / F.nullif(n, F.lit(0))).cast("decimal(38,0)")
            rest = F.col(f"u{i}") - whole * n
            spread = (F.col(f"q{i}") - whole * (F.col(f"u{i}") + rest)).cast("double") \
                - rest.cast("double") * rest.cast("double") / F.nullif(n, F.lit(0))
            std = F.when(n > 1, F.round(F.sqrt(spread / F.nullif(n - 1, F.lit(0))) / 10 ** value_scale, 6))
        parts.append(F.struct(F.lit(c).alias("column"), n.alias("count"), mean.alias("mean"),
                              std.alias("stddev"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max")))
    return wide.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def quartiles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, min, q1, median, q3, max per column as typed rows.

    Exact discrete quartiles: the smallest value at which at least a quarter,
    half, three quarters of the non-null values are reached. Values are counted
    per column first (a partial aggregate, so a value that fills a third of the
    rows is one row per task). The distinct values are cut into ranges of equal
    count, wherever they lie; the ranges' totals tell which of them hold a wanted
    rank, and only those (at most three of a column) get running sums, so no task
    sorts a whole column, far outliers or not.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"))
                                         for c in cols])).alias("r")).select("r.*").where("x IS NOT NULL")
    counts = write_table(long.groupBy("column", "x").agg(F.count(F.lit(1)).alias("n")))  # read again below
    ranges = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = range_bucket(counts, ["column", "x"], ranges, "bucket")
    totals = placed.groupBy("column", "bucket").agg(F.sum("n").alias("held"), F.min("x").alias("lo"),
                                                    F.max("x").alias("hi"))
    whole = Window.partitionBy("column")  # one row per range
    spans = totals.select(
        "column", "bucket", (F.sum("held").over(whole.orderBy("bucket")) - F.col("held")).alias("before"), "held",
        F.sum("held").over(whole).alias("all"), F.min("lo").over(whole).alias("min"), F.max("hi").over(whole).alias("max"))
    wanted = F.lit(False)
    for k in (1, 2, 3):
        rank = F.col("all") * k
        wanted = wanted | ((F.col("before") * 4 < rank) & ((F.col("before") + F.col("held")) * 4 >= rank))
    inside = Window.partitionBy("column", "bucket").orderBy("x")
    ranked = (placed.join(F.broadcast(spans.where(wanted)), ["column", "bucket"])
              .withColumn("reached", F.col("before") + F.sum("n").over(inside)))
    quarter = [F.min(F.when(F.col("reached") * 4 >= F.col("all") * k, F.col("x"))).alias(name)
               for k, name in ((1, "q1"), (2, "median"), (3, "q3"))]
    found = ranked.groupBy("column").agg(F.max("all").alias("count"), F.max("min").alias("min"), *quarter,
                                         F.max("max").alias("max"))
    names = df.sparkSession.createDataFrame([(c,) for c in dict.fromkeys(cols)], "column string")
    return names.join(found, "column", "left").select(
        "column", F.coalesce("count", F.lit(0)).alias("count"), "min", "q1", "median", "q3", "max")


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def fold_sum(df: DataFrame, col: str, name: str = "total") -> DataFrame:
    """``rdd.map(f).reduce(+)`` as a JVM-side aggregate."""
    return df.agg(F.sum(col).alias(name))


# --------------------------------------------------------------------------
# Sorts and limits
# --------------------------------------------------------------------------


def sort_rows(df: DataFrame, *order: Column | str) -> DataFrame:
    return df.orderBy(*order)


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """First ``k`` rows by a total order: each task keeps its own top ``k``,
    the driver merges at most ``k x tasks`` rows (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


# --------------------------------------------------------------------------
# Set operations (F1, F2)
# --------------------------------------------------------------------------


def union_all(frames: Iterable[DataFrame], by_name: bool = True) -> DataFrame:
    """UNION ALL of frames (F1, F2). By name by default, which is safe against
    column-order drift; the plan is one Union node, not a chain of jobs."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one frame")
    op = (lambda a, b: a.unionByName(b)) if by_name else (lambda a, b: a.union(b))
    return reduce(op, frames)


def append_rows(df: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Views are read-only (INSERT INTO a view is refused): new rows make a new
    frame (A18). Persist with ``write.mode('append')``."""
    return df.unionByName(new_rows)
