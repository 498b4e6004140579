"""Registered queries of the relational operators (sections A11, A16, A18, B-J).

Each query runs over whole driver tables. Where the tutorial used a tiny
in-memory frame, the same operator is applied to a driver table with the same
traits (nulls are injected by a key rule, see ``tables.nullable_orders``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchcast.functions import scalar as sc
from wrenchcast.operators import keys as ky
from wrenchcast.operators import relational as rel
from wrenchcast.operators import rows as rw
from wrenchcast.operators import sampling as smp
from wrenchcast.plans import tables as tb
from wrenchcast.plans.tables import NULLABLE_ORDERS_SQL as NULLABLE


def _t(spark, sf_dir, name):
    return tb.table(spark, sf_dir, name)


def _nullable(spark, sf_dir):
    return tb.nullable_orders(_t(spark, sf_dir, "orders"))


# ----------------------------------------------------------------- sources
def schema_enforce(spark, sf_dir):
    schema = ("o_orderkey BIGINT NOT NULL, o_custkey BIGINT NOT NULL, o_orderstatus STRING, "
              "o_totalprice DOUBLE, o_orderdate DATE NOT NULL, o_orderpriority STRING")
    return rel.enforce_schema(_t(spark, sf_dir, "orders"), schema)


def append_rows(spark, sf_dir):
    people = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"))
    new_rows = _t(spark, sf_dir, "supplier").select(
        (-F.col("s_suppkey") - 1).alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    return rel.append_rows(people, new_rows)


# ----------------------------------------------------------------- projections
def project(spark, sf_dir):
    return rel.project(_t(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", "o_totalprice")


def project_star(spark, sf_dir):
    return rel.project(_t(spark, sf_dir, "customer"), "*")


def derive_column(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return rel.with_derived(li, {"derived": F.col("l_quantity") * 2,
                                 "line_minus_one": F.col("l_linenumber") - 1})


def constant_column(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return rel.with_constant(li, "constant", 58)


def surrogate_key(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return ky.add_row_number(orders, [F.col("o_orderkey")], "row_num")


def rename_columns(spark, sf_dir):
    return rel.rename(_t(spark, sf_dir, "customer"), {"c_custkey": "key", "c_name": "name"})


def drop_columns(spark, sf_dir):
    return rel.drop_columns(_t(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate")


def cast_columns(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
        F.substring("o_orderpriority", 1, 1).alias("priority_code"))
    return rel.cast_columns(orders, {"o_orderkey": "string", "o_custkey": "int", "o_orderstatus": "int",
                                     "o_orderdate": "date", "priority_code": "int"})


def case_label(spark, sf_dir):
    df = _nullable(spark, sf_dir).select("o_orderkey", "o_totalprice")
    return rel.presence_flag(df, "has_price", "o_totalprice")


def struct_roundtrip(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer")
    packed = rel.pack_struct(cust, "Value", ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
                             keep=["c_custkey"])
    return rel.unpack_struct(packed, "Value", keep=["c_custkey"])


def array_explode(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    return rel.explode_positions(part, F.split("p_name", " "), keep=["p_partkey"], pos="pos", value="word")


# ----------------------------------------------------------------- filters and nulls
def filter_eq(spark, sf_dir):
    return rel.filter_eq(_t(spark, sf_dir, "events"), "event_type", "error")


# Fixed record of the record-filter example: one asset on one day.
RECORD = (7, "2024-01-05")


def filter_record(spark, sf_dir):
    k = tb.kpis(_t(spark, sf_dir, "events"))
    return rel.filter_record(k, "asset_id", RECORD[0], "day", F.lit(RECORD[1]).cast("date"))


def filter_sql_text(spark, sf_dir):
    return rel.filter_sql(_nullable(spark, sf_dir),
                          "(o_orderstatus = 'F' AND o_totalprice IS NULL) "
                          "OR (o_orderpriority = '1-URGENT' AND o_totalprice IS NOT NULL)")


def dropna(spark, sf_dir):
    return rel.drop_nulls(_nullable(spark, sf_dir))


def fillna(spark, sf_dir):
    df = rel.fill_nulls(_nullable(spark, sf_dir), 0.5, ["o_totalprice"])
    return rel.fill_nulls(df, {"o_orderstatus": "U"})


def replace_values(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return rel.replace_values(li, [2, 5, 7], [20, None, 70], ["l_linenumber"])


def _sql(spark, sf_dir, template: str, *names: str):
    """SQL text over driver tables; each ``{name}`` placeholder is bound to
    the DataFrame of that table (no session-wide temp view is created)."""
    return spark.sql(template, **{n: _t(spark, sf_dir, n) for n in names})


def _as_tables(template: str, *names: str) -> str:
    """The same SQL text for the oracle, reading the views of the same names."""
    return template.format(**{n: n for n in names})


def sql_join_group_order(spark, sf_dir):
    return _sql(spark, sf_dir, SQL_JOIN_GROUP_ORDER, "orders", "customer", "nation")


# row_num is the place that ORDER BY gives a row (a test compares it with the order of the collected rows).
SQL_JOIN_GROUP_ORDER = """
    SELECT *, CAST(row_number() OVER (ORDER BY total_price DESC, nation, segment) AS BIGINT) AS row_num FROM (
        SELECT n.n_name AS nation, c.c_mktsegment AS segment,
               CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
               count(*) AS n_orders
        FROM {orders} o
        JOIN {customer} c ON c.c_custkey = o.o_custkey
        JOIN {nation} n ON n.n_nationkey = c.c_nationkey
        WHERE n.n_regionkey = 1
        GROUP BY n.n_name, c.c_mktsegment) g
    ORDER BY total_price DESC, nation, segment"""


# ----------------------------------------------------------------- joins
def join_null_keys(spark, sf_dir):
    a = _nullable(spark, sf_dir).select("o_orderkey", "o_totalprice")
    b = rel.rename(a, {"o_orderkey": "r_orderkey", "o_totalprice": "r_totalprice"})
    return rel.equi_join(a, b, [a.o_orderkey == b.r_orderkey, a.o_totalprice == b.r_totalprice])


def join_lookup(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return rel.lookup_join(li, part, "l_partkey", "p_partkey").drop("l_partkey", "p_partkey")


def cross_join(spark, sf_dir):
    return rel.cross_product_count(_t(spark, sf_dir, "customer").select("c_custkey"),
                                   _t(spark, sf_dir, "supplier").select("s_suppkey"))


def cross_filter_join(spark, sf_dir):
    """Cross product filtered by key equality: Catalyst plans it as an
    equi-join; written here directly with the join condition."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select("o_orderkey", "c_name")


# ----------------------------------------------------------------- aggregations
SQL_AVG_GROUP = """
    SELECT *, CAST(row_number() OVER (ORDER BY o_orderpriority, o_orderstatus) AS BIGINT) AS row_num FROM (
        SELECT o_orderpriority, o_orderstatus,
               round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice), 6) AS avg_price
        FROM {orders} GROUP BY o_orderpriority, o_orderstatus) g
    ORDER BY o_orderpriority, o_orderstatus"""


def sql_avg_group(spark, sf_dir):
    return _sql(spark, sf_dir, SQL_AVG_GROUP, "orders")


def group_count(spark, sf_dir):
    return rel.group_count(_nullable(spark, sf_dir), "o_orderstatus")


def group_max(spark, sf_dir):
    return rel.group_max(_nullable(spark, sf_dir), ["o_orderstatus"], ["o_custkey", "o_totalprice"])


def count_nulls(spark, sf_dir):
    return rel.count_star_and_col(_nullable(spark, sf_dir), ["o_orderstatus"], "o_totalprice")


def global_agg(spark, sf_dir):
    return rel.global_agg(_t(spark, sf_dir, "lineitem"), F.count(F.lit(1)).alias("count"),
                          F.sum("l_quantity").alias("sum_qty"))


def describe_stats(spark, sf_dir):
    return rel.describe_stats(_nullable(spark, sf_dir), ["o_totalprice", "o_custkey"], value_scale=2)


def quartiles(spark, sf_dir):
    return rel.quartiles(_nullable(spark, sf_dir), ["o_totalprice", "o_custkey"])


def distinct_rows(spark, sf_dir):
    return rel.distinct_rows(_nullable(spark, sf_dir), "o_orderstatus", "o_orderpriority")


def fold_sum(spark, sf_dir):
    return rel.fold_sum(_t(spark, sf_dir, "lineitem"), "l_linenumber", "total")


# ----------------------------------------------------------------- sorts and limits
def sort_mixed(spark, sf_dir):
    df = _nullable(spark, sf_dir).select("o_orderkey", "o_orderstatus", "o_totalprice")
    return ky.add_row_number(df, [F.asc("o_orderstatus"), F.desc("o_totalprice"), F.asc("o_orderkey")],
                             "row_num")


def limit_rows(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return rel.top_k(cust, [F.col("c_custkey")], 5)


# ----------------------------------------------------------------- set operations
def _names(spark, sf_dir):
    return [
        _t(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"),
                                             F.col("c_name").alias("name")),
        _t(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"),
                                             F.col("s_name").alias("name")),
        _t(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("key"),
                                         F.col("p_name").alias("name")),
    ]


def union_all(spark, sf_dir):
    return rel.union_all(_names(spark, sf_dir)[:2])


def union_many(spark, sf_dir):
    return rel.union_all(_names(spark, sf_dir))


# ----------------------------------------------------------------- scalar functions
def substring_day(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", sc.day_text("ts").alias("day_text"))


def _day_texts(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    bad = F.col("event_id") % 50 == 0
    return ev.select("event_id", F.when(bad, F.lit("not-a-day")).otherwise(sc.day_text("ts")).alias("day_text"))


def parse_date(spark, sf_dir):
    return _day_texts(spark, sf_dir).select("event_id", "day_text", sc.parse_date("day_text").alias("day"))


def split_key(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    name = F.concat(F.concat_ws("-", F.lit("070324"), F.lit("QQX"), F.lit("QQY"),
                                F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0"),
                                F.upper(F.substring("p_type", 1, 2)),
                                F.upper(F.substring("p_name", 1, 3))), F.lit(".csv"))
    # Some names are not of the fixed form: an extension or a part is missing, or there is a part too many.
    kind = F.col("p_partkey") % 11
    name = (F.when(kind == 3, F.regexp_replace(name, "[.]csv$", "")).when(kind == 5, F.substring_index(name, "-", -2))
            .when(kind == 7, F.concat(F.lit("x-"), name)).otherwise(name))
    return part.select("p_partkey", name.alias("file_name")).withColumn(
        "asset_id", sc.asset_from_file_name("file_name"))


def _request_texts(spark, sf_dir):
    """Typed requests built from events: most well formed, some not."""
    ev = _t(spark, sf_dir, "events")
    eid = F.col("event_id")
    day = F.when(eid % 13 == 0, F.regexp_replace(sc.day_text("ts"), "-", "/")) \
        .when(eid % 17 == 0, F.lit("20X5-AA-01")).otherwise(sc.day_text("ts"))
    asset = F.when(eid % 11 == 0, F.concat(F.lit("X-"), F.col("user_id").cast("string"))) \
        .otherwise(F.concat(F.lit("AC-"), F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0")))
    return ev.select(eid.alias("request_id"), day.alias("day"), asset.alias("asset"))


def validate_request(spark, sf_dir):
    req = _request_texts(spark, sf_dir)
    return req.withColumn("valid", sc.valid_request("day", "asset"))


def decode_prediction(spark, sf_dir):
    lab = _t(spark, sf_dir, "labels")
    return lab.select("doc_id", sc.decode_prediction(F.col("toxic").cast("double")).alias("prediction_text"))


# ----------------------------------------------------------------- sampling
def hash_sample(spark, sf_dir):
    return smp.hash_sample(_t(spark, sf_dir, "orders"), "o_orderkey", 0.4, seed=58, method="md5")


def hash_split(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id")
    return smp.hash_split_column(ev, "event_id", (0.8, 0.2), ("train", "test"), seed=69, method="md5")


# Fractions far below one in ten thousand: the usual case on very large tables.
SMALL_FRACTION, SMALL_SEED = 0.00009, 3


def _line_keys(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return li.withColumn("line_key", F.concat_ws("/", "l_orderkey", "l_linenumber"))


def hash_sample_small(spark, sf_dir):
    return smp.hash_sample(_line_keys(spark, sf_dir), "line_key", SMALL_FRACTION, seed=SMALL_SEED, method="md5")


def hash_split_small(spark, sf_dir):
    return smp.hash_split_column(_line_keys(spark, sf_dir), "line_key", (1 - SMALL_FRACTION, SMALL_FRACTION),
                                 ("train", "test"), seed=SMALL_SEED, method="md5").groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("line_key").alias("first_key"))


def hash_folds(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id")
    return smp.hash_folds(ev, "event_id", k=3, seed=69, method="md5")


# ----------------------------------------------------------------- row transforms
def _urgent():
    return F.col("o_orderpriority") == "1-URGENT"


def _then():
    return [F.col("o_orderstatus"), F.col("o_custkey") - 1, F.col("o_custkey") * 2, _urgent()]


def map_rows(spark, sf_dir):
    return rw.map_rows(_t(spark, sf_dir, "orders"), _urgent(), _then(), [None, "none", "dry", "-"],
                       ["c1", "c2", "c3", "c4"], keep=["o_orderkey"])


def map_rows_nullable(spark, sf_dir):
    out = rw.map_rows_nullable(_t(spark, sf_dir, "orders"), _urgent(), _then(), ["c1", "c2", "c3", "c4"],
                               name="row", keep=["o_orderkey"])
    return out.select("o_orderkey", "row.*", F.col("row").isNull().alias("row_is_null"))


def flat_map(spark, sf_dir):
    return rw.flat_map(_t(spark, sf_dir, "orders"), _urgent(), [F.col("o_orderstatus"), F.col("o_orderstatus")],
                       name="value", keep=["o_orderkey"])


QUERIES = {
    "schema_enforce": schema_enforce, "append_rows": append_rows,
    "project": project, "project_star": project_star, "derive_column": derive_column,
    "constant_column": constant_column, "surrogate_key": surrogate_key, "rename_columns": rename_columns,
    "drop_columns": drop_columns, "cast_columns": cast_columns, "case_label": case_label,
    "struct_roundtrip": struct_roundtrip, "array_explode": array_explode,
    "filter_eq": filter_eq, "filter_record": filter_record, "filter_sql_text": filter_sql_text,
    "dropna": dropna, "fillna": fillna, "replace_values": replace_values,
    "sql_join_group_order": sql_join_group_order,
    "join_null_keys": join_null_keys, "join_lookup": join_lookup, "cross_join": cross_join,
    "cross_filter_join": cross_filter_join,
    "sql_avg_group": sql_avg_group, "group_count": group_count, "group_max": group_max,
    "count_nulls": count_nulls, "global_agg": global_agg, "describe_stats": describe_stats,
    "quartiles": quartiles,
    "distinct_rows": distinct_rows, "fold_sum": fold_sum,
    "sort_mixed": sort_mixed, "limit_rows": limit_rows,
    "union_all": union_all, "union_many": union_many,
    "substring_day": substring_day, "parse_date": parse_date, "split_key": split_key,
    "validate_request": validate_request, "decode_prediction": decode_prediction,
    "hash_sample": hash_sample, "hash_sample_small": hash_sample_small, "hash_split": hash_split,
    "hash_split_small": hash_split_small, "hash_folds": hash_folds,
    "map_rows": map_rows, "map_rows_nullable": map_rows_nullable, "flat_map": flat_map,
}


def _uniform_sql(key_sql: str, seed: int) -> str:
    return f"(('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 13))::BIGINT)"


_LINE_KEYS_SQL = "(SELECT l_orderkey, l_linenumber, l_orderkey || '/' || l_linenumber AS line_key FROM lineitem)"


def _bucket_sql(key_sql: str, seed: int) -> str:
    return f"(('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 8))::BIGINT)"


_NAMES_SQL = [
    "SELECT 'customer' AS kind, c_custkey AS key, c_name AS name FROM customer",
    "SELECT 'supplier' AS kind, s_suppkey AS key, s_name AS name FROM supplier",
    "SELECT 'part' AS kind, p_partkey AS key, p_name AS name FROM part",
]

_DESCRIBE_COL = """SELECT '{c}' AS "column", n{i} AS "count", round(s{i} / n{i}, 6) AS mean,
       round(sd{i}, 6) AS stddev, lo{i} AS "min", hi{i} AS "max" FROM w"""


def _describe_sql(cols):
    aggs = []
    for i, c in enumerate(cols):
        d = f"CAST({c} AS DECIMAL(18,2))"
        aggs.append(f"count({c}) AS n{i}, CAST(sum({d}) AS DOUBLE) AS s{i}, "
                    f"stddev_samp(CAST({c} AS DOUBLE)) AS sd{i}, "
                    f"CAST(min({c}) AS DOUBLE) AS lo{i}, CAST(max({c}) AS DOUBLE) AS hi{i}")
    body = " UNION ALL ".join(_DESCRIBE_COL.format(c=c, i=i) for i, c in enumerate(cols))
    return f"WITH w AS (SELECT {', '.join(aggs)} FROM {NULLABLE} t) {body}"


_QUARTILE_COL = """SELECT '{c}' AS "column", count({c}) AS "count", min({c})::DOUBLE AS "min",
       quantile_disc({c}::DOUBLE, 0.25) AS q1, quantile_disc({c}::DOUBLE, 0.5) AS median,
       quantile_disc({c}::DOUBLE, 0.75) AS q3, max({c})::DOUBLE AS "max" FROM {t} t"""

_THEN_SQL = ["o_orderstatus", "CAST(o_custkey - 1 AS VARCHAR)", "CAST(o_custkey * 2 AS VARCHAR)",
             "CAST(o_orderpriority = '1-URGENT' AS VARCHAR)"]

_REQUEST_TEXTS_SQL = """(SELECT event_id AS request_id,
        CASE WHEN event_id % 13 = 0 THEN replace(substring(CAST(ts AS VARCHAR), 1, 10), '-', '/')
             WHEN event_id % 17 = 0 THEN '20X5-AA-01'
             ELSE substring(CAST(ts AS VARCHAR), 1, 10) END AS day,
        CASE WHEN event_id % 11 = 0 THEN 'X-' || CAST(user_id AS VARCHAR)
             ELSE 'AC-' || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') END AS asset
        FROM events)"""

ORACLE = {
    "schema_enforce": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders""",
    "append_rows": """SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey FROM customer
        UNION ALL SELECT -s_suppkey - 1, s_name, s_nationkey FROM supplier""",
    "project": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "project_star": "SELECT * FROM customer",
    "derive_column": """SELECT l_orderkey, l_linenumber, l_quantity, l_quantity * 2 AS derived,
        l_linenumber - 1 AS line_minus_one FROM lineitem""",
    "constant_column": "SELECT l_orderkey, l_linenumber, 58 AS constant FROM lineitem",
    "surrogate_key": "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS row_num FROM orders",
    "rename_columns": """SELECT c_custkey AS key, c_name AS name, c_nationkey, c_acctbal, c_mktsegment
        FROM customer""",
    "drop_columns": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "cast_columns": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, TRY_CAST(o_custkey AS INTEGER) AS o_custkey,
        TRY_CAST(o_orderstatus AS INTEGER) AS o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate,
        TRY_CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS priority_code FROM orders""",
    "case_label": f"""SELECT o_orderkey, o_totalprice,
        CASE WHEN o_totalprice IS NOT NULL THEN 1 ELSE 0 END AS has_price FROM {NULLABLE} t""",
    "struct_roundtrip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "array_explode": """SELECT p_partkey, CAST(pos AS INTEGER) AS pos, word FROM (
        SELECT p_partkey, unnest(range(len(string_split(p_name, ' ')))) AS pos,
               unnest(string_split(p_name, ' ')) AS word FROM part) t""",
    "filter_eq": "SELECT * FROM events WHERE event_type = 'error'",
    "filter_record": f"""SELECT * FROM {tb.KPIS_SQL} k
        WHERE asset_id = {RECORD[0]} AND day = DATE '{RECORD[1]}'""",
    "filter_sql_text": f"""SELECT * FROM {NULLABLE} t
        WHERE (o_orderstatus = 'F' AND o_totalprice IS NULL)
           OR (o_orderpriority = '1-URGENT' AND o_totalprice IS NOT NULL)""",
    "dropna": f"""SELECT * FROM {NULLABLE} t WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL
        AND o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL
        AND o_orderpriority IS NOT NULL""",
    "fillna": f"""SELECT o_orderkey, o_custkey, coalesce(o_orderstatus, 'U') AS o_orderstatus,
        coalesce(o_totalprice, 0.5) AS o_totalprice, o_orderdate, o_orderpriority FROM {NULLABLE} t""",
    "replace_values": """SELECT l_orderkey, CASE l_linenumber WHEN 2 THEN 20 WHEN 5 THEN NULL WHEN 7 THEN 70
        ELSE l_linenumber END AS l_linenumber FROM lineitem""",
    "sql_join_group_order": _as_tables(SQL_JOIN_GROUP_ORDER, "orders", "customer", "nation"),
    "join_null_keys": f"""SELECT a.o_orderkey, a.o_totalprice, b.o_orderkey AS r_orderkey, b.o_totalprice AS r_totalprice
        FROM {NULLABLE} a JOIN {NULLABLE} b ON a.o_orderkey = b.o_orderkey AND a.o_totalprice = b.o_totalprice""",
    "join_lookup": """SELECT l_orderkey, l_linenumber, p_name, p_brand
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "cross_join": "SELECT (SELECT count(*) FROM customer) * (SELECT count(*) FROM supplier) AS n_pairs",
    "cross_filter_join": """SELECT o_orderkey, c_name FROM orders, customer WHERE o_custkey = c_custkey""",
    "sql_avg_group": _as_tables(SQL_AVG_GROUP, "orders"),
    "group_count": f"SELECT o_orderstatus, count(*) AS count FROM {NULLABLE} t GROUP BY o_orderstatus",
    "group_max": f"""SELECT o_orderstatus, max(o_custkey) AS max_o_custkey, max(o_totalprice) AS max_o_totalprice
        FROM {NULLABLE} t GROUP BY o_orderstatus""",
    "count_nulls": f"""SELECT o_orderstatus, count(*) AS n_rows, count(o_totalprice) AS n_o_totalprice
        FROM {NULLABLE} t GROUP BY o_orderstatus""",
    "global_agg": "SELECT count(*) AS count, sum(l_quantity) AS sum_qty FROM lineitem",
    "quartiles": " UNION ALL ".join(_QUARTILE_COL.format(c=c, t=NULLABLE) for c in ("o_totalprice", "o_custkey")),
    "describe_stats": _describe_sql(["o_totalprice", "o_custkey"]),
    "distinct_rows": f"SELECT DISTINCT o_orderstatus, o_orderpriority FROM {NULLABLE} t",
    "fold_sum": "SELECT CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem",
    "sort_mixed": f"""SELECT o_orderkey, o_orderstatus, o_totalprice,
        row_number() OVER (ORDER BY o_orderstatus ASC NULLS FIRST, o_totalprice DESC NULLS LAST, o_orderkey)
        AS row_num FROM {NULLABLE} t""",
    "limit_rows": "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 5",
    "union_all": " UNION ALL ".join(_NAMES_SQL[:2]),
    "union_many": " UNION ALL ".join(_NAMES_SQL),
    "substring_day": "SELECT event_id, substring(CAST(ts AS VARCHAR), 1, 10) AS day_text FROM events",
    "parse_date": """SELECT event_id, day_text, CAST(TRY_STRPTIME(day_text, '%Y-%m-%d') AS DATE) AS day FROM (
        SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'not-a-day'
               ELSE substring(CAST(ts AS VARCHAR), 1, 10) END AS day_text FROM events) t""",
    "split_key": """SELECT p_partkey, file_name,
        CASE WHEN len(string_split(file_name, '-')) = 6 AND ends_with(file_name, '.csv')
                  AND length(split_part(file_name, '-', 5)) = 2
                  AND length(split_part(split_part(file_name, '-', 6), '.', 1)) = 3
             THEN split_part(file_name, '-', 5) || '-' || split_part(split_part(file_name, '-', 6), '.', 1)
        END AS asset_id
        FROM (SELECT p_partkey, CASE p_partkey % 11 WHEN 3 THEN replace(whole, '.csv', '')
                  WHEN 5 THEN split_part(whole, '-', 5) || '-' || split_part(whole, '-', 6)
                  WHEN 7 THEN 'x-' || whole ELSE whole END AS file_name
              FROM (SELECT p_partkey, concat_ws('-', '070324', 'QQX', 'QQY',
                  lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0'), upper(substring(p_type, 1, 2)),
                  upper(substring(p_name, 1, 3))) || '.csv' AS whole FROM part) n) t""",
    "validate_request": f"""SELECT request_id, day, asset,
        coalesce(regexp_full_match(day, '[^-]{{4}}-[^-]{{2}}-[^-]{{2}}'), false)
        AND coalesce(regexp_full_match(asset, '[^-]{{2}}-[^-]{{3}}'), false) AS valid
        FROM {_REQUEST_TEXTS_SQL} r""",
    "decode_prediction": """SELECT doc_id, CASE WHEN CAST(toxic AS DOUBLE) = 0.0 THEN 'No maintenance'
        WHEN toxic IS NOT NULL THEN 'Maintenance' END AS prediction_text FROM labels""",
    "hash_sample": f"SELECT * FROM orders WHERE {_uniform_sql('o_orderkey', 58)} < {smp.threshold(0.4)}",
    "hash_sample_small": f"""SELECT * FROM {_LINE_KEYS_SQL} t
        WHERE {_uniform_sql('line_key', SMALL_SEED)} < {smp.threshold(SMALL_FRACTION)}""",
    "hash_split_small": f"""SELECT split, count(*) AS n, min(line_key) AS first_key FROM (
        SELECT line_key, CASE WHEN {_uniform_sql('line_key', SMALL_SEED)} < {smp.threshold(1 - SMALL_FRACTION)}
                              THEN 'train' ELSE 'test' END AS split FROM {_LINE_KEYS_SQL} t) GROUP BY split""",
    "hash_split": f"""SELECT event_id, CASE WHEN {_uniform_sql('event_id', 69)} < {smp.threshold(0.8)}
        THEN 'train' ELSE 'test' END AS split FROM events""",
    "hash_folds": f"""SELECT event_id, CAST(({_bucket_sql('event_id', 69)} % 1073741824) % 3 AS INTEGER) AS fold
        FROM events""",
    "map_rows": f"""SELECT o_orderkey,
        CASE WHEN o_orderpriority = '1-URGENT' THEN {_THEN_SQL[0]} ELSE NULL END AS c1,
        CASE WHEN o_orderpriority = '1-URGENT' THEN {_THEN_SQL[1]} ELSE 'none' END AS c2,
        CASE WHEN o_orderpriority = '1-URGENT' THEN {_THEN_SQL[2]} ELSE 'dry' END AS c3,
        CASE WHEN o_orderpriority = '1-URGENT' THEN {_THEN_SQL[3]} ELSE '-' END AS c4 FROM orders""",
    "map_rows_nullable": f"""SELECT o_orderkey,
        CASE WHEN o_orderpriority = '1-URGENT' THEN {_THEN_SQL[0]} END AS c1,
        CASE WHEN o_orderpriority = '1-URGENT' THEN {_THEN_SQL[1]} END AS c2,
        CASE WHEN o_orderpriority = '1-URGENT' THEN {_THEN_SQL[2]} END AS c3,
        CASE WHEN o_orderpriority = '1-URGENT' THEN {_THEN_SQL[3]} END AS c4,
        NOT (o_orderpriority = '1-URGENT') AS row_is_null FROM orders""",
    "flat_map": """SELECT o_orderkey, CAST(i AS INTEGER) AS item, o_orderstatus AS value
        FROM orders, (VALUES (0), (1)) v(i) WHERE o_orderpriority = '1-URGENT'""",
}
