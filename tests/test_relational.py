"""Relational operators on a small frame: null semantics and plan shapes."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from wrenchcast.operators import keys as ky
from wrenchcast.operators import relational as rel
from wrenchcast.operators import rows as rw
from wrenchcast.operators import sampling as smp


def test_projection_keeps_the_asked_columns(fleet_df):
    assert rel.project(fleet_df, "hours", "reg").columns == ["hours", "reg"]
    assert rel.project(fleet_df, "*").columns == ["reg", "legs", "hours", "wet"]


def test_constant_column(fleet_df):
    assert {r.base for r in rel.with_constant(fleet_df, "base", "QQX").collect()} == {"QQX"}


def test_join_drops_null_keys(fleet_df):
    other = rel.rename(fleet_df, {c: f"o_{c}" for c in fleet_df.columns})
    out = rel.equi_join(fleet_df, other, [fleet_df.reg == other.o_reg, fleet_df.hours == other.o_hours])
    assert out.count() == 5  # of six rows one has no hours


def test_count_star_against_count_col(fleet_df):
    got = {r.wet: (r.n_rows, r.n_wet) for r in rel.count_star_and_col(fleet_df, ["wet"], "wet").collect()}
    assert got == {True: (2, 2), False: (3, 3), None: (1, 0)}
    assert {r.wet: r["count"] for r in rel.group_count(fleet_df, "wet").collect()} == {True: 2, False: 3, None: 1}


def test_sort_nulls(fleet_df):
    rows = rel.sort_rows(fleet_df, F.asc("wet"), F.desc("legs")).collect()
    assert [(r.wet, r.legs) for r in rows] == [(None, 21), (False, 40), (False, 34), (False, 8), (True, 55), (True, 13)]


def test_sql_text_predicates(fleet_df):
    assert [r.reg for r in rel.filter_sql(fleet_df, "NOT wet AND hours IS NULL").collect()] == ["zk-d"]
    assert rel.filter_sql(fleet_df, "hours IS NOT NULL").count() == 5
    assert sorted(r.reg for r in rel.drop_nulls(fleet_df).collect()) == ["zk-a", "zk-b", "zk-e", "zk-f"]


def test_fill_and_replace(fleet_df):
    filled = {r.reg: (r.hours, r.wet) for r in rel.fill_nulls(fleet_df, 0.5, ["hours"]).collect()}
    assert filled["zk-d"] == (0.5, False) and filled["zk-c"] == (6.25, None)
    both = {r.reg: (r.hours, r.wet) for r in rel.fill_nulls(fleet_df, {"hours": 0.5, "wet": True}).collect()}
    assert both["zk-c"] == (6.25, True)
    rep = [r.legs for r in rel.replace_values(fleet_df, [8, 13], [80, None], ["legs"]).orderBy("reg").collect()]
    assert rep == [80, None, 21, 34, 55, 40]


def test_describe(fleet_df):
    stats = {r.column: r for r in rel.describe_stats(fleet_df, ["legs", "hours"], value_scale=2).collect()}
    legs = [8, 13, 21, 34, 55, 40]
    assert stats["legs"]["count"] == 6 and stats["hours"]["count"] == 5
    assert stats["legs"].mean == 28.5 and (stats["legs"]["min"], stats["legs"]["max"]) == (8.0, 55.0)
    assert stats["legs"].stddev == pytest.approx(statistics.stdev(legs), abs=1e-6)


@pytest.mark.parametrize("scale", [None, 2])
def test_describe_of_no_rows(fleet_df, scale):
    row = rel.describe_stats(fleet_df.limit(0), ["hours"], value_scale=scale).first()
    assert (row["count"], row.mean, row.stddev, row["min"]) == (0, None, None, None)


def test_describe_of_large_means_with_a_small_spread(spark):
    values = [10_000_000_000.25 + k / 100 for k in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = rel.describe_stats(df, ["v"], value_scale=2).first()
    assert got.stddev == pytest.approx(statistics.stdev(k / 100 for k in range(1000)), abs=1e-6)


def test_quartiles_are_exact(spark):
    rng = random.Random(4)
    values = [rng.choice([3.0, 3.0, rng.uniform(-1e6, 1e6)]) for _ in range(3001)] + [None] * 5
    df = spark.createDataFrame([(v, 7) for v in values], "v double, c int").repartition(5)
    got = {r.column: tuple(r)[1:] for r in rel.quartiles(df, ["v", "c"]).collect()}
    ordered = sorted(v for v in values if v is not None)
    at = lambda k: ordered[-(-k * len(ordered) // 4) - 1]
    assert got["v"] == (3001, ordered[0], at(1), at(2), at(3), ordered[-1])
    assert got["c"] == (3006, 7.0, 7.0, 7.0, 7.0, 7.0)
    assert tuple(rel.quartiles(df.where("v IS NULL"), ["v"]).first()) == ("v", 0, None, None, None, None, None)


def test_distinct_and_dedup(fleet_df):
    assert rel.distinct_rows(fleet_df, "wet").count() == 3
    from wrenchcast.operators.matrix import first_row_per_key
    got = {r.wet: r.reg for r in first_row_per_key(fleet_df, ["wet"], ["reg"]).collect()}
    assert got == {True: "zk-b", False: "zk-a", None: "zk-c"}


def test_fold_and_global(fleet_df):
    assert rel.fold_sum(fleet_df, "legs").first().total == 171
    assert rel.global_agg(fleet_df).first()["count"] == 6


def test_struct_round_trip(fleet_df):
    keyed = ky.add_surrogate_key(fleet_df, "Key")
    packed = rel.pack_struct(keyed, "Value", fleet_df.columns, keep=["Key"])
    back = rel.unpack_struct(packed, "Value", keep=["Key"]).drop("Key")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, fleet_df.collect()), key=str)


def test_surrogate_key_unique(spark):
    df = spark.range(0, 5000, numPartitions=7)
    keyed = ky.add_surrogate_key(df, "k")
    assert keyed.select("k").distinct().count() == 5000


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_row_number_is_global_and_consecutive(spark, parts):
    df = spark.range(0, 3000, numPartitions=5).select((F.col("id") * 7919 % 3001).alias("v"), "id")
    got = ky.add_row_number(df, [F.desc("v"), F.asc("id")], "rn", num_partitions=parts).collect()
    expected = sorted(((r.v, r.id) for r in df.collect()), key=lambda t: (-t[0], t[1]))
    assert sorted((r.rn, r.v, r.id) for r in got) == [(i + 1, v, k) for i, (v, k) in enumerate(expected)]


@pytest.mark.parametrize("name", ["sql_join_group_order", "sql_avg_group"])
def test_sql_order_by_is_the_order_of_the_rows(spark, name):
    from wrenchcast.plans.registry import QUERIES
    from .conftest import SF_SMALL
    numbers = [r.row_num for r in QUERIES[name](spark, SF_SMALL).collect()]
    assert numbers == list(range(1, len(numbers) + 1)) and len(numbers) > 3


def test_small_fractions_draw_their_share(spark):
    df = spark.range(0, 2_000_000)
    for fraction in (1e-3, 1e-4, 4e-5, 5e-6):
        for method in ("xxhash64", "md5"):
            n = smp.hash_sample(df, "id", fraction, seed=5, method=method).count()
            mean = 2_000_000 * fraction
            assert abs(n - mean) < 6 * mean ** 0.5 + 1, (fraction, method, n)
    assert smp.threshold(1e-7) > 0
    test = smp.hash_split_column(df, "id", (0.99996, 0.00004), seed=1).where("split = 'test'").count()
    assert 40 < test < 140


@pytest.mark.parametrize("weights", [(), (0.0, 0.0), (1.0, -0.5), (float("nan"), 1.0), (float("inf"), 1.0)])
def test_split_weights_are_checked(spark, weights):
    with pytest.raises(ValueError):
        smp.hash_split_column(spark.range(3), "id", weights, [f"s{i}" for i in range(len(weights))])


def test_cross_count_of_empty_inputs(spark):
    empty = spark.range(0)
    assert rel.cross_product_count(empty, empty).first().n_pairs == 0
    assert rel.cross_product_count(empty, spark.range(5)).first().n_pairs == 0


def test_top_k_is_bounded(spark):
    df = spark.range(0, 1000, numPartitions=4)
    out = rel.top_k(df, [F.desc("id")], 3)
    assert [r.id for r in out.collect()] == [999, 998, 997]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_cross_filter_is_planned_as_equi_join(spark):
    a = spark.range(0, 50).withColumnRenamed("id", "a")
    b = spark.range(0, 50).withColumnRenamed("id", "b")
    crossed = a.crossJoin(b)
    plan = crossed.where(crossed.a == crossed.b)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert rel.cross_product_count(a, b).first().n_pairs == 2500


def test_union_by_name(spark):
    x = spark.createDataFrame([(1, "a")], "k int, v string")
    y = spark.createDataFrame([("b", 2)], "v string, k int")
    assert sorted(map(tuple, rel.union_all([x, y]).collect())) == [(1, "a"), (2, "b")]
    assert rel.append_rows(x, y).count() == 2


def test_enforce_schema(spark):
    df = spark.createDataFrame([("1", "2024-01-02"), ("2", None)], "k string, d string")
    out = rel.enforce_schema(df, "k BIGINT NOT NULL, d DATE")
    assert out.schema.simpleString() == "struct<k:bigint,d:date>"
    assert out.count() == 2
    with pytest.raises(Exception):
        rel.enforce_schema(df, "k BIGINT, d DATE NOT NULL").collect()


def test_safe_cast(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    assert [r.v for r in rel.cast_columns(df, {"v": "int"}).collect()] == [1, None]


def test_rows_transforms_match_python(fleet_df):
    rows = fleet_df.orderBy("reg").collect()
    then = [F.col("reg"), F.col("legs") + 5, F.col("legs") * 3, F.col("wet")]
    other = [None, "none", "dry", "-"]
    mapped = rw.map_rows(fleet_df, F.col("wet"), then, other, ["c1", "c2", "c3", "c4"],
                         keep=["reg"]).orderBy("reg").collect()
    py = [(r.reg, str(r.legs + 5), str(r.legs * 3), "true") if r.wet else tuple(other) for r in rows]
    assert [(m.c1, m.c2, m.c3, m.c4) for m in mapped] == py
    nullable = rw.map_rows_nullable(fleet_df, F.col("wet"), then, ["c1", "c2", "c3", "c4"], keep=["reg"]) \
        .orderBy("reg").collect()
    assert [m.row is None for m in nullable] == [not r.wet for r in rows]
    flat = rw.flat_map(fleet_df, F.col("wet"), [F.col("reg"), F.col("reg")], keep=["reg"]).collect()
    assert sorted(f.value for f in flat) == sorted(x for r in rows if r.wet for x in (r.reg, r.reg))


def test_hash_split_is_a_partition_independent_of_layout(spark):
    df = spark.range(0, 4000, numPartitions=3)
    a1, b1 = smp.hash_split(df, "id", (0.8, 0.2), seed=69)
    a2, b2 = smp.hash_split(df.repartition(11), "id", (0.8, 0.2), seed=69)
    s1, t1 = {r.id for r in a1.collect()}, {r.id for r in b1.collect()}
    assert s1 == {r.id for r in a2.collect()} and t1 == {r.id for r in b2.collect()}
    assert s1.isdisjoint(t1) and len(s1 | t1) == 4000
    assert 0.75 < len(s1) / 4000 < 0.85


def test_hash_folds_and_sample(spark):
    df = spark.range(0, 3000)
    folds = smp.hash_folds(df, "id", 3, seed=1).groupBy("fold").count().collect()
    assert sorted(r.fold for r in folds) == [0, 1, 2] and sum(r["count"] for r in folds) == 3000
    s = smp.hash_sample(df, "id", 0.4, seed=666)
    assert 0.35 < s.count() / 3000 < 0.45
    assert {r.id for r in s.collect()} == {r.id for r in smp.hash_sample(df.repartition(5), "id", 0.4, 666).collect()}
    assert df.sample(withReplacement=False, fraction=0.4, seed=666).count() > 0


def test_partition_control(spark):
    df = spark.range(0, 1000, numPartitions=4)
    assert smp.repartition_by(df, 5).rdd.getNumPartitions() == 5
    assert smp.shrink_partitions(df, 1).rdd.getNumPartitions() == 1
    sizes = smp.partition_sizes(df).collect()
    assert sum(r.rows for r in sizes) == 1000 and len(sizes) == 4


def test_bounded_actions(fleet_df):
    cached = fleet_df.cache()
    try:
        assert cached.first().reg == "zk-a"
        assert [r.reg for r in cached.take(2)] == ["zk-a", "zk-b"]
        assert [r.reg for r in cached.head(2)] == ["zk-a", "zk-b"]
        assert [r.reg for r in cached.tail(2)] == ["zk-e", "zk-f"]
        assert len(cached.collect()) == 6
        assert not cached.isEmpty()
    finally:
        cached.unpersist()


def test_frequency_index_equals_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer
    rows = [(i, v) for i, v in enumerate(["b", "a", "b", "c", None, "a", "d", "e", "d", "c", "z", None])]
    df = spark.createDataFrame(rows, "id int, v string")
    ours = {r.id: r.idx for r in ky.frequency_index(df, "v", "idx").collect()}
    model = StringIndexer(inputCol="v", outputCol="idx", handleInvalid="keep", stringOrderType="frequencyDesc").fit(df)
    theirs = {r.id: r.idx for r in model.transform(df).collect()}
    assert ours == theirs


def test_keys_on_empty_input(spark):
    empty = spark.createDataFrame([], "v string")
    assert ky.add_row_number(empty, [F.col("v")], "rn").isEmpty()
    assert ky.frequency_index(empty, "v", "i").isEmpty()


def test_lookup_with_repeated_key_fans_out_and_is_detected(spark):
    flights = spark.createDataFrame([("Big", 10), ("SEA", 5)], "origin string, delay int")
    airports = spark.createDataFrame([("Big", "A"), ("Big", "B"), ("Big", "C"), ("SEA", "Seattle")],
                                     "IATA string, City string")
    joined = rel.lookup_join(flights, airports, "origin", "IATA")
    assert joined.count() == 4  # SQL semantics: the flight from 'Big' matches three airports
    assert [tuple(r) for r in rel.duplicate_keys(airports, "IATA").collect()] == [("Big", 3)]
    with pytest.raises(ValueError, match="Big"):
        rel.check_unique_keys(airports, "IATA")
    rel.check_unique_keys(flights, "origin")
