"""Catalogue: nested records (orders + line items as account-like records)
and grouping operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arith import round_half_away
from ..operators import groups as G
from ..operators import records as R
from ..sources.tables import account_heads, account_rows, nested, nested_stats, table
from .registry import query

# The nested view in SQL: one record per order and file (l_partkey % 4),
# orders without line items as one record with an empty list in file 0.
_REC = """
li AS (SELECT l_orderkey AS id, l_partkey % 4 AS file, CAST(l_linenumber AS BIGINT) AS transaction_id,
              l_extendedprice AS amount FROM lineitem),
rec AS (SELECT o.o_orderkey AS id, coalesce(li.file, 0) AS file, o.o_orderpriority AS name,
               count(li.id) AS n_tx, coalesce(sum(li.amount), 0) AS total, max(li.amount) AS max_amount
        FROM orders o LEFT JOIN li ON li.id = o.o_orderkey GROUP BY 1, 2, 3)"""

URGENT = "1-URGENT"


@query("pluck_field", f"WITH {_REC} SELECT id, file, name FROM rec", ids="PRJ-2")
def pluck_field(spark, sf):
    return R.pluck(nested(spark, sf), "id", "file", "name")


@query("nested_count", f"WITH {_REC} SELECT id, file, name, CAST(n_tx AS BIGINT) AS n FROM rec",
       ids="PRJ-10, FN-8")
def nested_count(spark, sf):
    return nested_stats(spark, sf, n=F.count(F.lit(1))).select("id", "file", "name", F.coalesce("n", F.lit(0)).alias("n"))


@query("flatten_nested", f"WITH {_REC} SELECT transaction_id, amount FROM li", ids="PRJ-11")
def flatten_nested(spark, sf):
    heads, rows = account_heads(table(spark, sf, "orders")), account_rows(table(spark, sf, "lineitem"))
    return R.flatten_rows(heads, rows, "id", ["transaction_id", "amount"])


@query("denormalize", f"""
WITH {_REC}
SELECT o.o_orderkey AS id, o.o_orderpriority AS name, li.transaction_id, li.amount
FROM li JOIN orders o ON li.id = o.o_orderkey""", ids="PRJ-12, UD-4")
def denormalize(spark, sf):
    heads, rows = account_heads(table(spark, sf, "orders")), account_rows(table(spark, sf, "lineitem"))
    return R.denormalize_rows(heads, rows, "id", ["id", "name"], ["transaction_id", "amount"])


@query("bag_to_frame", f"""
WITH {_REC}
SELECT id, file, name, CAST(n_tx AS BIGINT) AS n_tx, round(total, 2) AS total FROM rec""",
       ids="SRC-13")
def bag_to_frame(spark, sf):
    return R.to_frame(nested_stats(spark, sf, n=F.count(F.lit(1)), total=F.sum("amount")), {
        "id": F.col("id"), "file": F.col("file"), "name": F.col("name"),
        "n_tx": F.coalesce("n", F.lit(0)), "total": round_half_away(F.coalesce("total", F.lit(0.0)), 2)})


@query("nested_mean", f"""
WITH {_REC} SELECT round(avg(li.amount), 6) AS mean
FROM li JOIN orders o ON li.id = o.o_orderkey WHERE o.o_orderpriority = '{URGENT}'""",
       ids="AG-10")
def nested_mean(spark, sf):
    rec = nested_stats(spark, sf, n=F.count("amount"), total=F.sum("amount")).filter(F.col("name") == URGENT)
    return rec.agg(round_half_away(F.try_divide(F.sum("total"), F.sum("n")), 6).alias("mean"))


@query("nested_count_mean", f"""
WITH {_REC} SELECT round(avg(n_tx), 6) AS mean_count FROM rec WHERE name = '{URGENT}'""",
       ids="AG-11")
def nested_count_mean(spark, sf):
    rec = nested_stats(spark, sf, n=F.count(F.lit(1))).filter(F.col("name") == URGENT)
    return rec.agg(round_half_away(F.avg(F.coalesce("n", F.lit(0))), 6).alias("mean_count"))


@query("fold_count", f"""
WITH {_REC} SELECT name, CAST(count(*) AS BIGINT) AS n FROM rec GROUP BY name""", ids="AG-14")
def fold_count(spark, sf):
    return R.fold_by(nested_stats(spark, sf, n=F.count(F.lit(1))), "name", {"n": F.count(F.lit(1))})


@query("fold_max", f"""
WITH {_REC} SELECT name, max(max_amount) AS max_amount FROM rec GROUP BY name""", ids="AG-14")
def fold_max(spark, sf):
    return R.fold_by(nested_stats(spark, sf, largest=F.max("amount")), "name", {"max_amount": F.max("largest")})


@query("fold_nested_sum", f"""
WITH {_REC} SELECT name, round(sum(total), 2) AS total FROM rec GROUP BY name""", ids="AG-14")
def fold_nested_sum(spark, sf):
    return R.fold_by(nested_stats(spark, sf, amount=F.sum("amount")), "name",
                     {"total": F.coalesce(F.sum("amount"), F.lit(0.0))}) \
        .select("name", round_half_away("total", 2).alias("total"))


@query("group_collect", """
SELECT CAST(length(n_name) AS BIGINT) AS key, n_name,
       CAST(count(*) OVER (PARTITION BY length(n_name)) AS BIGINT) AS group_size
FROM nation""", ids="AG-12")
def group_collect(spark, sf):
    n = table(spark, sf, "nation")
    return G.group_members(n, F.length("n_name").cast("bigint"), "n_name")


@query("group_max", """
SELECT CAST(o_orderkey % 2 AS BIGINT) AS key, max(o_orderkey) AS max, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY 1""", ids="AG-13")
def group_max(spark, sf):
    o = table(spark, sf, "orders")
    return G.group_reduce(o, F.pmod("o_orderkey", F.lit(2)).cast("bigint"),
                          {"max": F.max("o_orderkey"), "n": F.count(F.lit(1))})


# Every 50th record is cut short: it comes back in the reject column.
@query("json_parse", """
SELECT event_id, event_type, CASE WHEN event_id % 50 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_id % 50 = 0 THEN props[1:5] END AS rejected FROM events""", ids="SRC-3, FN-10")
def json_parse(spark, sf):
    text = F.when(F.col("event_id") % 50 == 0, F.substring("props", 1, 5)).otherwise(F.col("props"))
    e = table(spark, sf, "events").select("event_id", "event_type", text.alias("props"))
    return R.parse_json_records(e, "props", "k BIGINT", corrupt_col="rejected")