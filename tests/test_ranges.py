"""Equal-count ranges, the row number built on them, and quartiles of skewed columns."""

import datetime as dt
import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wrenchcast.operators import keys as ky
from wrenchcast.operators import relational as rel
from wrenchcast.operators.ranges import range_bucket

KEYED = "id long, s string, v double, d date, m decimal(9,2), t timestamp, i int"


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(5)
    maybe = lambda x: None if rng.random() < 0.1 else x
    numbers = [0.0, -0.0, 1.5, -7.25, float("nan"), float("inf"), float("-inf"), 1e300]
    rows = [(i, maybe(rng.choice(["", "a", "aa", "b", "é", "zz", "commonprefix1", "commonprefix2"])),
             maybe(rng.choice(numbers)), maybe(dt.date(2020, 1, 1) + dt.timedelta(rng.randint(-9, 9))),
             maybe(Decimal(rng.randint(-500, 500)) / 100), maybe(dt.datetime(2020, 1, 1) + dt.timedelta(seconds=rng.randint(-9, 9))),
             maybe(rng.choice([-2**31, 2**31 - 1, 0, 5]))) for i in range(1500)]
    return spark.createDataFrame(rows, KEYED).repartition(5).persist()


@pytest.mark.parametrize("column", ["s", "v", "d", "m", "t", "i"])
def test_row_numbers_in_every_direction(spark, mixed, column):
    """All four orders of a column, each numbered as by Spark's own single-task row number."""
    for how in ("asc", "asc_nulls_last", "desc", "desc_nulls_first"):
        order = [getattr(F.col(column), how)(), F.col("id").desc() if how == "asc" else F.col("id")]
        got = ky.add_row_number(mixed, order, "rn", num_partitions=7)
        bad = got.withColumn("own", F.row_number().over(Window.orderBy(*order))).where("rn <> own")
        assert bad.isEmpty(), (column, how)


@pytest.mark.parametrize("buckets", [1, 2, 33, 200])
def test_ranges_are_ordered_and_even(spark, buckets):
    """Ranges follow the order; none is far above its share, whatever the values' spread."""
    n = 20_000
    values = spark.range(n).select(F.when(F.col("id") == 0, F.lit(1e15)).otherwise(F.exp(F.col("id") / 700)).alias("x"))
    rows = (range_bucket(values.repartition(6), ["x"], buckets, "b").groupBy("b")
            .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("b").collect())
    assert all(a.hi < b.lo for a, b in itertools.pairwise(rows))
    assert len(rows) > 0.8 * buckets and max(r.n for r in rows) < max(2.5 * n / buckets, 1.01 * n * (buckets == 1))


def test_ranges_do_not_depend_on_partitions(spark, mixed):
    order = [F.col("s").desc(), F.col("id")]
    got = [{r.id: r.b for r in range_bucket(mixed.repartition(p), order, 20, "b").select("id", "b").collect()}
           for p in (1, 8)]
    assert got[0] == got[1] and len(set(got[0].values())) > 15


def test_nothing_runs_when_the_frame_is_built(spark, mixed):
    sc = spark.sparkContext
    sc.setJobGroup("build", "")
    frame = ky.add_row_number(mixed, ["id"], "rn")
    ky.frequency_index(mixed, "s")
    assert not sc.statusTracker().getJobIdsForGroup("build")
    assert frame.agg(F.max("rn")).first()[0] == 1500 and sc.statusTracker().getJobIdsForGroup("build")
    sc.setJobGroup("", "")


@pytest.mark.parametrize("parts", [3, 200])
def test_row_numbers_with_few_and_many_partitions(spark, parts):
    got = ky.add_row_number(spark.range(500).repartition(4), [F.col("id").desc()], "rn", num_partitions=parts)
    assert got.where("rn <> 500 - id").isEmpty() and got.count() == 500


def test_small_and_null_inputs(spark):
    empty = spark.createDataFrame([], "x long")
    assert range_bucket(empty, ["x"], 8, "b").count() == 0
    nulls = spark.createDataFrame([(None,), (None,), (1,)], "x long")
    assert {(r.x, r.b) for r in range_bucket(nulls, [F.col("x").asc_nulls_last()], 8, "b").collect()} >= {(1, 0)}


def test_quartiles_with_far_outliers(spark):
    """One value far beyond the others leaves ranges even, and the quartiles exact."""
    values = [float(k * k % 7919) for k in range(9000)] + [1e15, -1e15]
    frame = spark.createDataFrame([(v, 3.0) for v in values], "x double, y double").repartition(6)
    got = {r.column: tuple(r)[1:] for r in rel.quartiles(frame, ["x", "y"]).collect()}
    ordered = sorted(values)
    at = [ordered[-(-len(ordered) * k // 4) - 1] for k in (1, 2, 3)]
    assert got == {"x": (9002, -1e15, *at, 1e15), "y": (9002, 3.0, 3.0, 3.0, 3.0, 3.0)}
    counts = frame.groupBy("x").count()
    held = [r[1] for r in range_bucket(counts, ["x"], 32, "b").groupBy("b").count().collect()]
    assert max(held) < 3 * sum(held) / 32
