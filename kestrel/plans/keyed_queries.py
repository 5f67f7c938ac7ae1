"""Catalogue: keyed-table operators (nation as base table, the same table
with keys shifted by 10 as updates), counters, first match, ordered fold,
and the ratio / quarantine jobs on lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keyed as K
from ..operators import quality as Q
from ..sources.tables import table
from .registry import query

SHIFT = 10
# The accumulator operator op(x, y) = 2x + y and its
# identity 1.  The modulus is ours, against overflow.
FOLD_MULT, FOLD_INIT = 2, 1
MODULUS = 1_000_003
FOLD_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]

_KV = f"""base AS (SELECT CAST(n_nationkey AS BIGINT) AS k, n_name AS v FROM nation),
upd AS (SELECT CAST(n_nationkey + {SHIFT} AS BIGINT) AS k, 'NEW_' || n_name AS v FROM nation)"""


def _base(spark, sf):
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"),
                                             F.col("n_name").alias("v"))


def _updates(spark, sf):
    return table(spark, sf, "nation").select(
        (F.col("n_nationkey") + SHIFT).cast("bigint").alias("k"),
        F.concat(F.lit("NEW_"), F.col("n_name")).alias("v"))


@query("upsert_if_absent", f"""
WITH {_KV}
SELECT k, v FROM base UNION ALL SELECT k, v FROM upd WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.k = upd.k)""",
       ids="JN-7")
def upsert_if_absent(spark, sf):
    return K.upsert_if_absent(_base(spark, sf), _updates(spark, sf), "k")


@query("upsert_merge", f"""
WITH {_KV}
SELECT coalesce(base.k, upd.k) AS k,
       CASE WHEN base.v IS NOT NULL AND upd.v IS NOT NULL THEN upd.v || ' was ' || base.v
            ELSE coalesce(upd.v, base.v) END AS v
FROM base FULL OUTER JOIN upd ON base.k = upd.k""", ids="JN-8, FN-12")
def upsert_merge(spark, sf):
    return K.upsert_merge(_base(spark, sf), _updates(spark, sf), "k", "v")


@query("lookup_default", f"""
WITH {_KV}
SELECT upd.k, coalesce(base.v, 'none') AS v FROM upd LEFT JOIN base ON base.k = upd.k""",
       ids="JN-9")
def lookup_default(spark, sf):
    return K.lookup_default(_updates(spark, sf), _base(spark, sf), "k", "v", "none")


@query("replace_all", """
SELECT CAST(n_nationkey AS BIGINT) AS k, CASE WHEN n_regionkey = 2 THEN 'd3' ELSE n_name END AS v,
       n_regionkey FROM nation""", ids="FN-11")
def replace_all(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"),
                                          F.col("n_name").alias("v"), "n_regionkey")
    return K.replace_where(n, F.col("n_regionkey") == 2, "v", "d3")


@query("counter_totals", """
SELECT CAST(count(*) AS BIGINT) AS increments, CAST(2 * count(*) AS BIGINT) AS plus_two_total,
       CAST(sum(event_id) AS BIGINT) AS sum_of_i FROM events""", ids="AG-25, ST-1")
def counter_totals(spark, sf):
    return K.counter_totals(table(spark, sf, "events"), "event_id")


@query("kv_concat", """
SELECT n_regionkey, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS BIGINT) AS position,
       CAST(n_nationkey AS VARCHAR) || '=' || n_name AS kv
FROM nation""", ids="FN-12")
def kv_concat(spark, sf):
    return K.kv_entries(table(spark, sf, "nation"), "n_regionkey", "n_nationkey", "n_name")


@query("kv_string", """
SELECT n_regionkey, string_agg(CAST(n_nationkey AS VARCHAR) || '=' || n_name, ', ' ORDER BY n_nationkey) AS text
FROM nation GROUP BY n_regionkey""", ids="AG-27, FN-12")
def kv_string(spark, sf):
    return K.kv_text(table(spark, sf, "nation"), "n_regionkey", "n_nationkey", "n_name")


# Many updates per key: the totals of a customer's orders, in order of date.
@query("upsert_merge_orders", """
WITH u AS (SELECT o_custkey AS k, string_agg(CAST(o_orderkey AS VARCHAR), ' was ' ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS v
           FROM orders GROUP BY 1)
SELECT coalesce(c_custkey, u.k) AS k, CASE WHEN u.v IS NULL THEN c_mktsegment WHEN c_mktsegment IS NULL THEN u.v
       ELSE u.v || ' was ' || c_mktsegment END AS v
FROM customer FULL OUTER JOIN u ON c_custkey = u.k""", ids="JN-8")
def upsert_merge_orders(spark, sf):
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    updates = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").cast("string").alias("v"), "o_orderdate")
    return K.upsert_merge(base, updates, "k", "v", order="o_orderdate")


@query("search_first", """
SELECT c_mktsegment, min(c_custkey) AS c_custkey, arg_min(c_name, c_custkey) AS c_name,
       arg_min(c_acctbal, c_custkey) AS c_acctbal
FROM customer WHERE c_acctbal > 9000 GROUP BY c_mktsegment""", ids="AG-28")
def search_first(spark, sf):
    c = table(spark, sf, "customer")
    return K.search_first(c, "c_mktsegment", F.col("c_acctbal") > 9000, "c_custkey",
                          ["c_custkey", "c_name", "c_acctbal"])


@query("ordered_fold", f"""
SELECT l_orderkey, CAST(list_reduce(list_prepend(CAST(1 AS BIGINT),
         list(CAST(l_quantity AS BIGINT) ORDER BY {", ".join(FOLD_ORDER)})),
         lambda acc, x: (2 * acc + x) % {MODULUS}) AS BIGINT) AS fold
FROM lineitem GROUP BY l_orderkey""", ids="AG-26")
def ordered_fold(spark, sf):
    li = table(spark, sf, "lineitem")
    return K.ordered_fold(li, "l_orderkey", FOLD_ORDER, "l_quantity",
                          init=FOLD_INIT, mult=FOLD_MULT, modulus=MODULUS)


@query("floor_ratio_sum", """
SELECT CAST(sum(floor(l_quantity / l_linenumber)) AS BIGINT) AS total FROM lineitem""",
       ids="PRJ-13")
def floor_ratio_sum(spark, sf):
    return Q.floor_ratio_sum(table(spark, sf, "lineitem"), "l_quantity", "l_linenumber")


@query("quarantine_bad_rows", """
SELECT coalesce(error, 'ok') AS status, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CASE WHEN error IS NULL THEN floor(a / b) END) AS BIGINT) AS total
FROM (SELECT l_quantity AS a, l_linenumber - 1 AS b,
             CASE WHEN l_quantity IS NULL OR l_linenumber IS NULL THEN 'null_input'
                  WHEN l_linenumber - 1 = 0 THEN 'divide_by_zero' END AS error
      FROM lineitem) t
GROUP BY 1""", ids="PRJ-14")
def quarantine_bad_rows(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("a"),
                                             (F.col("l_linenumber") - 1).alias("b"))
    return Q.ratio_with_quarantine(li, "a", "b")


@query("zip_ratio_sum", f"""
WITH a AS (SELECT l_quantity AS a, row_number() OVER (ORDER BY {", ".join(["l_orderkey"] + FOLD_ORDER)}) AS pos
           FROM lineitem),
     b AS (SELECT p_size AS b, row_number() OVER (ORDER BY p_partkey) AS pos FROM part)
SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(floor(a / b)) AS BIGINT) AS total
FROM a JOIN b ON a.pos = b.pos""", ids="PRJ-13")
def zip_ratio_sum(spark, sf):
    # two sequences - line-item quantities in key order, part sizes in
    # part-key order - zipped by position (stops at the shorter), then
    # sum(a // b)
    li = table(spark, sf, "lineitem").select("l_orderkey", *FOLD_ORDER, F.col("l_quantity").alias("a"))
    pt = table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("b"))
    z = Q.zip_by_position(li, pt, ["l_orderkey", *FOLD_ORDER], ["p_partkey"])
    return z.agg(F.count(F.lit(1)).alias("n"), F.sum(Q.floor_ratio("a", "b")).alias("total"))
