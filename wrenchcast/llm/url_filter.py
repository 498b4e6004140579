"""Operator 1: URL filters with a Bloom filter cascade.

Prefix rules decide first (longest fitting rule); what no rule covers is decided by exact membership of the url's
host in a list of blocked keys. Membership is read from a cascade of Bloom filters: level 0 encodes the listed keys,
level 1 those other keys of the universe that level 0 takes for listed, level 2 the listed keys that level 1 takes
for one of these, and so on until a level errs on no key. The first level that denies a key tells its side, so every
key of the universe is answered exactly, without a join of the pages with the list.

A level is an array of 64-bit words, built by ``bit_or`` per word and read as a scalar subquery; its size is known
before it is built. Lists whose levels would pass ``max_level_bits`` (a few MB, as a level is gathered in one task and
goes with the tasks that read it) are cut into shards by key hash, and each shard's pages are judged by that shard's
cascade. Then the pages' hosts and paths are written once, sorted by shard in parts of even size, and each cascade reads
the row groups of its shard.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is allowed unless the
empty host is listed; null listed keys are ignored; repeated urls get equal verdicts; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, lower_ascii, write_out


@dataclass(frozen=True)
class Rule:
    verdict: str
    rule: str  # host suffix and path prefix, such as "example.org/es/"

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return lower_ascii(host), path


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Rule string and verdict of the longest rule that fits; null, null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.rule), len(r.host), r.rule)):  # later ones win: the longest is outermost
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, F.lit(r.rule)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` is a scalar subquery over its 64-bit words."""
    words: Column
    bits: int
    hashes: int
    seed: int

    def positions(self, key: Column) -> list[Column]:
        one, two = F.xxhash64(key, F.lit(2 * self.seed)), F.xxhash64(key, F.lit(2 * self.seed + 1))
        # double hashing on 31 bits each, so that the sums cannot overflow
        one, two = F.shiftrightunsigned(one, 33), F.shiftrightunsigned(two, 33)
        return [(one + two * F.lit(i)) % F.lit(self.bits) for i in range(self.hashes)]

    def contains(self, key: Column) -> Column:
        hit = [F.get(self.words, (p / 64).cast("int")).bitwiseAND(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), (p % 64).cast("int"))) != 0
            for p in self.positions(key)]
        return reduce(lambda a, b: a & b, hit)


def build_level(keys: DataFrame, n_keys: int, bits_per_key: float, seed: int) -> Level:
    """Bloom filter of the ``key`` column of ``keys``."""
    bits = 64 * max(1, math.ceil(n_keys * bits_per_key / 64))
    hashes = max(1, round(bits / max(1, n_keys) * math.log(2)))
    level = Level(F.lit(None), bits, min(hashes, 16), seed)
    spark = keys.sparkSession
    set_bits = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("p"))
    word = set_bits.select((F.col("p") / 64).cast("bigint").alias("i"),
                           F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                           (F.col("p") % 64).cast("int")).alias("w"))
    zeros = spark.range(bits // 64).select(F.col("id").alias("i"), F.lit(0).cast("bigint").alias("w"))
    dense = cut(word.unionByName(zeros).groupBy("i").agg(F.bit_or("w").alias("w")))
    # bits / 64 rows, a size fixed above, so gathering them into one array is bounded
    array = dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda s: s["w"]).alias("words"))
    return Level(array.scalar(), bits, level.hashes, seed)


def build_cascade(universe: DataFrame, first_bits_per_key: float | None = None, later_bits_per_key: float = 1.5,
                  seed: int = 0) -> Cascade:
    """Cascade over ``universe`` (key string, listed boolean; keys distinct and not null)."""
    n_in, n_out = (universe.agg(F.coalesce(F.sum(F.col("listed").cast("long")), F.lit(0)),
                                F.coalesce(F.sum((~F.col("listed")).cast("long")), F.lit(0))).first())
    if n_in == 0:
        return Cascade([])
    if first_bits_per_key is None:  # false-positive rate listed / (sqrt(2) * unlisted) keeps the whole cascade smallest
        rate = min(0.5, n_in / (math.sqrt(2) * max(n_out, 1)))
        first_bits_per_key = max(1.5, math.log2(1 / rate) / math.log(2))
    inside, outside = universe.where("listed").select("key"), universe.where("not listed").select("key")
    levels, n, bits_per_key = [], n_in, first_bits_per_key
    while True:
        level = build_level(inside, n, bits_per_key, seed + len(levels))
        levels.append(level)
        wrong = cut(outside.where(level.contains(F.col("key"))))
        n = wrong.count()
        if n == 0:
            return Cascade(levels)
        inside, outside, bits_per_key = wrong, inside, later_bits_per_key


@dataclass(frozen=True)
class Cascade:
    levels: list[Level]

    def listed(self, key: Column) -> Column:
        """Whether ``key``, a key of the universe, is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)  # in every level: the side that the last one encodes
        for i, level in reversed(list(enumerate(self.levels))):
            answer = F.when(~level.contains(key), F.lit(i % 2 == 1)).otherwise(answer)
        return answer


def url_verdicts(pages: DataFrame, rules: list[Rule], listed: DataFrame, url: str = "url",
                 max_level_bits: int = 1 << 26) -> DataFrame:
    """``pages`` columns named in the result: page_id, host, path, rule, verdict, listed.

    ``listed`` has one string column of blocked hosts. The universe is every host of ``pages`` with the listed ones.
    """
    host, path = host_and_path(F.col(url))
    rule, ruled = longest_rule(F.col("host"), F.col("path"), rules)
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    listed = listed.toDF("key").where("key is not null").select("key", F.lit(True).alias("listed"))
    universe = cut(judged.select(F.col("host").alias("key"), F.lit(False).alias("listed")).unionByName(listed)
                   .groupBy("key").agg(F.max("listed").alias("listed")))
    n_listed = universe.where("listed").count()
    shards = max(1, math.ceil(n_listed * 64 / max_level_bits))  # 64 bits a key is far above what a level takes
    if shards == 1:
        out = judged.withColumn("listed", build_cascade(universe).listed(F.col("host")))
    else:
        shard = lambda key: F.pmod(F.xxhash64(F.lit(-1), key), F.lit(shards)).alias("shard")
        universe = write_out(universe.select("*", shard(F.col("key"))).sortWithinPartitions("shard"))
        # by ranges of shard and row, so that a shard with a host of very many pages is written by many tasks
        rows = judged.select("*", shard(F.col("host")))
        rows = write_out(rows.repartitionByRange("shard", F.xxhash64("page_id", "path")).sortWithinPartitions("shard"))
        parts = []
        for s in range(shards):
            cascade = build_cascade(universe.where(F.col("shard") == s).drop("shard"))
            parts.append(rows.where(F.col("shard") == s).drop("shard").withColumn("listed", cascade.listed(F.col("host"))))
        out = reduce(DataFrame.unionByName, parts)
    return (out.withColumn("rule", rule)
            .withColumn("verdict", F.coalesce(ruled, F.when(F.col("listed"), "block").otherwise("allow")))
            .select("page_id", "host", "path", "rule", "verdict", "listed"))
