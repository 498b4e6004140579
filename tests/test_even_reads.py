"""JDBC parts planned from counts, and the production hash of samples and splits."""

import datetime as dt
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from wrenchcast.operators import sampling as sm
from wrenchcast.sources import jdbc

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
URL = "jdbc:derby:memory:wrenchcast_even;create=true"


def table(spark, name, rows):
    frame = spark.createDataFrame([(i, d, "?" if a is None else a) for i, d, a in rows], "id long, day date, asset string")
    (frame.write.format("jdbc").options(url=URL, dbtable=name, createTableColumnTypes="asset VARCHAR(16)", **DERBY)
     .mode("overwrite").save())
    connection = spark._jvm.java.sql.DriverManager.getConnection(URL)  # Spark cannot write a null VARCHAR to Derby
    connection.createStatement().executeUpdate(f"UPDATE {name} SET \"asset\" = NULL WHERE \"asset\" = '?'")
    connection.close()


@pytest.fixture(scope="module")
def skewed(spark):
    """A day with two thirds of the rows, few rows on the others, and nulls."""
    rng = random.Random(4)
    hot = dt.date(2024, 3, 1)
    rows = [(i, hot if i % 3 else hot + dt.timedelta(rng.randint(-300, 300)), f"XY-'{rng.randint(0, 60):02d}")
            for i in range(3000)]
    rows = [(i, None if i % 97 == 0 else d, None if i % 89 == 0 else a) for i, d, a in rows]
    table(spark, "SKEWED", rows)
    return rows


def sizes(spark, name, parts):
    frame = jdbc.read_table(spark, URL, name, DERBY, predicates=parts)
    assert frame.rdd.getNumPartitions() == len(parts)
    by_part = frame.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return [r["count"] for r in by_part], sorted(r.id for r in frame.collect())


def test_a_hot_day_is_split_by_asset(spark, skewed):
    parts = jdbc.plan_predicates(spark, URL, "SKEWED", "day", 12, DERBY, split_column="asset")
    held, ids = sizes(spark, "SKEWED", parts)
    assert ids == list(range(3000))  # every row once
    assert max(held) < 1.5 * 3000 / 12 and 12 <= len(parts) <= 16
    guessed = jdbc.read_table(spark, URL, "SKEWED", DERBY, "day", "2023-05-06", "2024-12-25", 12)
    assert max(r["count"] for r in guessed.groupBy(F.spark_partition_id()).count().collect()) > 0.6 * 3000


def test_without_a_second_column_the_hot_day_is_one_part(spark, skewed):
    parts = jdbc.plan_predicates(spark, URL, "SKEWED", "day", 12, DERBY)
    held, ids = sizes(spark, "SKEWED", parts)
    assert ids == list(range(3000)) and sorted(held)[-2] < 1.5 * 3000 / 12


def test_text_keys_with_quotes(spark, skewed):
    parts = jdbc.plan_predicates(spark, URL, "SKEWED", "asset", 7, DERBY)
    held, ids = sizes(spark, "SKEWED", parts)
    assert ids == list(range(3000)) and max(held) < 2 * 3000 / 7


@pytest.mark.parametrize("rows, parts", [([], 1), ([(1, None, None)], 2), ([(1, dt.date(2024, 1, 1), "a")] * 5, 3)])
def test_small_tables(spark, rows, parts):
    name = f"SMALL{len(rows)}"
    table(spark, name, rows)
    planned = jdbc.plan_predicates(spark, URL, name, "day", 4, DERBY, split_column="asset")
    assert len(sizes(spark, name, planned)[1]) == len(rows) and len(planned) >= parts
    with pytest.raises(ValueError):
        jdbc.plan_predicates(spark, URL, name, "day", 0, DERBY)


def test_rows_added_after_planning_are_read(spark):
    table(spark, "GROWING", [(i, dt.date(2024, 1, 1), "a") for i in range(40)])
    parts = jdbc.plan_predicates(spark, URL, "GROWING", "day", 4, DERBY, split_column="asset")
    table(spark, "GROWING", [(i, dt.date(2024, 1, 1 + i % 3), "b" if i % 2 else None) for i in range(60)])
    assert sizes(spark, "GROWING", parts)[1] == list(range(60))


def unsigned(key, seed):
    """XXH64 as Spark chains it: the seed's four bytes with 42, then the key's bytes with that."""
    first = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
    return xxhash.xxh64_intdigest(struct.pack("<q", key) if isinstance(key, int) else key.encode(), first)


@pytest.mark.parametrize("seed", [0, 69, -7])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_production_samples_and_splits_row_by_row(spark, seed, kind):
    rng = random.Random(seed)
    keys = ([rng.randint(-2**63, 2**63 - 1) for _ in range(3000)] if kind == "long" else
            ["".join(rng.choices("abcé|-0123456789", k=rng.randint(0, 70))) + str(i) for i in range(3000)])
    frame = spark.createDataFrame([(k,) for k in keys], f"k {kind}")
    place = {k: unsigned(k, seed) >> 12 for k in keys}  # 52 bits
    limit = lambda fraction: round(fraction * 2**52)
    for fraction in (0.0, 0.001, 0.3, 1.0):
        got = {r.k for r in sm.hash_sample(frame, "k", fraction, seed).collect()}
        assert got == {k for k in keys if place[k] < limit(fraction)}
    train, test, rest = (
        {r.k for r in part.collect()} for part in sm.hash_split(frame, "k", (0.5, 0.3, 0.2), seed))
    assert train == {k for k in keys if place[k] < limit(0.5)}
    assert test == {k for k in keys if limit(0.5) <= place[k] < limit(0.8)}
    assert rest == set(keys) - train - test
    signed = lambda h: h - 2**64 if h >= 2**63 else h
    folds = {r.k: r.fold for r in sm.hash_folds(frame, "k", 3, seed).collect()}
    assert folds == {k: signed(unsigned(k, seed)) % (1 << 30) % 3 for k in keys}
