"""Queries of operators 2 and 8 over the whole table ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read_table, word_count
from .mixing import mixed, source_targets
from .quality import judge


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    sizes = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return mixed(sizes, source_targets(sizes)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents"))


OP2_SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents),
per as (select source, sum(size)::hugeint as source_size from sized group by source),
weighed as (
  select source, source_size, [3, 1, 2][1 + (row_number() over (order by source is null, source) - 1) % 3] as weight
  from per),
-- Sources reach their limit in the order of size / weight: the first that stays below it ends the limited ones.
ordered as (
  select *, row_number() over w as k,
    3 * sum(source_size) over () - 4 * coalesce(sum(source_size) over (w rows between unbounded preceding and 1 preceding), 0) as over_,
    2 * (sum(weight) over () - coalesce(sum(weight) over (w rows between unbounded preceding and 1 preceding), 0)) as under_
  from weighed window w as (order by source_size::double / weight, source is null, source)),
first_free as (
  select * from ordered where weight * over_ <= 2 * source_size * under_ order by k limit 1),
targets as (
  select o.source, o.source_size::bigint as source_size,
    case when o.k < f.k then (2 * o.source_size)::double else (o.weight * f.over_)::double / f.under_::double end as target
  from ordered o, first_free f),
rated as (
  select s.doc_id, s.size, t.source_size, t.target,
    case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
    ('0x' || md5(coalesce(s.doc_id::varchar, 'null') || ':mix')[1:13])::bigint / 4503599627370496.0 as u
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (floor(rate) + case when u < rate - floor(rate) then 1 else 0 end)::bigint * size as taken
from rated
"""

QUERIES = {"op2_mix_sources": op2_mix_sources, "op8_quality_rules": op8_quality_rules}
ORACLE = {"op2_mix_sources": OP2_SQL}
