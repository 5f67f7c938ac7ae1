"""Catalogue: tabular operators on the ``account`` view (customer) and on
orders / lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arith import round_half_away
from ..operators import frame as FR
from ..operators.copartition import co_partition
from ..sources.tables import account, table
from .registry import query

_ACCOUNT = "account AS (SELECT c_custkey AS id, c_mktsegment AS names, c_acctbal AS amount FROM customer)"


@query("elementwise", f"""
WITH {_ACCOUNT}
SELECT id, round(amount + 1, 6) AS plus_one, round(amount * 2, 6) AS times_two,
       round(pow(amount, 2), 6) AS squared,
       CAST(floor((id - 750) / 7) AS BIGINT) AS floordiv,
       CAST((((id - 750) % 7) + 7) % 7 AS BIGINT) AS mod
FROM account""", ids="PRJ-1, FN-7")
def elementwise(spark, sf):
    a = account(spark, sf)
    x = F.col("id") - 750
    ops = FR.python_ops(x, 7)
    return FR.arithmetic(a, ["id"], {
        "plus_one": round_half_away(F.col("amount") + 1, 6),
        "times_two": round_half_away(F.col("amount") * 2, 6),
        "squared": round_half_away(F.pow("amount", 2), 6),
        "floordiv": ops["floordiv"], "mod": ops["mod"].cast("bigint")})


@query("filter_pos_neg", f"""
WITH {_ACCOUNT}
SELECT id, names, amount, CASE WHEN amount > 0 THEN 'pos' ELSE 'neg' END AS side
FROM account WHERE amount <> 0""", ids="PRJ-3")
def filter_pos_neg(spark, sf):
    a = account(spark, sf)
    return FR.where(a, F.col("amount") != 0).withColumn(
        "side", F.when(F.col("amount") > 0, "pos").otherwise("neg"))


@query("filter_isin", """
SELECT c_custkey AS id, c_mktsegment AS names, c_acctbal AS amount, c_nationkey
FROM customer WHERE c_nationkey IN (1, 2, 3)""", ids="PRJ-4")
def filter_isin(spark, sf):
    c = table(spark, sf, "customer")
    return FR.isin(c, "c_nationkey", [1, 2, 3]).select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("names"),
        F.col("c_acctbal").alias("amount"), "c_nationkey")


@query("loc_label", f"""
WITH {_ACCOUNT} SELECT id, names, amount FROM account WHERE names = 'BUILDING'""", ids="PRJ-6")
def loc_label(spark, sf):
    return FR.loc(account(spark, sf), "names", "BUILDING")


@query("loc_range", f"""
WITH {_ACCOUNT} SELECT id, names, amount FROM account WHERE amount BETWEEN 1000.0 AND 2000.5""",
       ids="PRJ-7")
def loc_range(spark, sf):
    return FR.loc_range(account(spark, sf), "amount", 1000.0, 2000.5)


@query("head_n", f"""
WITH {_ACCOUNT} SELECT id, names, amount FROM account ORDER BY id LIMIT 5""", ids="SL-1")
def head_n(spark, sf):
    return FR.head(account(spark, sf), 5, ["id"])


@query("distinct_rows", """
SELECT DISTINCT c_mktsegment AS names, c_nationkey FROM customer""", ids="AG-19")
def distinct_rows(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("names"), "c_nationkey")
    return FR.distinct_rows(c)


@query("distinct_values", f"""
WITH {_ACCOUNT} SELECT DISTINCT names FROM account""", ids="AG-19")
def distinct_values(spark, sf):
    return FR.distinct_values(account(spark, sf), "names")


@query("value_counts", """
SELECT c_nationkey, CAST(count(*) AS BIGINT) AS n FROM customer
WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey ORDER BY n DESC, c_nationkey""", ids="AG-18")
def value_counts(spark, sf):
    return FR.value_counts(table(spark, sf, "customer"), "c_nationkey")


@query("sorted_counts", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders
GROUP BY o_orderstatus ORDER BY o_orderstatus""", ids="SL-2")
def sorted_counts(spark, sf):
    return FR.count_by(table(spark, sf, "orders"), "o_orderstatus")


@query("group_mean", f"""
WITH {_ACCOUNT} SELECT names, round(avg(amount), 6) AS mean FROM account
WHERE names IS NOT NULL GROUP BY names""", ids="AG-15")
def group_mean(spark, sf):
    return FR.group_mean(account(spark, sf), "names", "amount") \
        .select("names", round_half_away("mean", 6).alias("mean"))


@query("group_mean_filtered", f"""
WITH {_ACCOUNT} SELECT names, round(avg(amount), 6) AS mean FROM account
WHERE amount < 0 AND names IS NOT NULL GROUP BY names""", ids="AG-16, PRJ-3")
def group_mean_filtered(spark, sf):
    return FR.group_mean(account(spark, sf), "names", "amount", F.col("amount") < 0) \
        .select("names", round_half_away("mean", 6).alias("mean"))


@query("group_count", f"""
WITH {_ACCOUNT} SELECT names, CAST(count(id) AS BIGINT) AS n, max(amount) AS max
FROM account GROUP BY names""", ids="AG-17")
def group_count(spark, sf):
    return FR.group_count_max(account(spark, sf), "names", "id", "amount")


@query("topk_group_mean", """
SELECT o_custkey, round(mean, 6) AS mean FROM (
  SELECT o_custkey, avg(o_totalprice) AS mean FROM orders GROUP BY o_custkey
  ORDER BY mean DESC, o_custkey LIMIT 10) t""", ids="SL-3")
def topk_group_mean(spark, sf):
    return FR.topk_group_mean(table(spark, sf, "orders"), "o_custkey", "o_totalprice", 10) \
        .select("o_custkey", round_half_away("mean", 6).alias("mean"))


@query("global_stats", f"""
WITH {_ACCOUNT}
SELECT CAST(count(amount) AS BIGINT) AS n, round(sum(amount), 4) AS total,
       round(avg(amount), 6) AS mean, min(amount) AS min, max(amount) AS max,
       round(var_pop(amount), 4) AS var, round(stddev_pop(amount), 6) AS std
FROM account""", ids="AG-9")
def global_stats(spark, sf):
    s = FR.global_stats(account(spark, sf), "amount")
    return s.select("n", round_half_away("total", 4).alias("total"),
                    round_half_away("mean", 6).alias("mean"), "min", "max",
                    round_half_away("var", 4).alias("var"), round_half_away("std", 6).alias("std"))


@query("join_on_column", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment, o.o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""", ids="JN-1")
def join_on_column(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                            "c_name", "c_mktsegment")
    return FR.join_on(o, c, "o_custkey")


@query("join_on_index", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice, o.o_orderdate, o.o_orderpriority
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""", ids="JN-2")
def join_on_index(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                             "l_extendedprice")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                          "o_orderdate", "o_orderpriority")
    return co_partition(li, o, "l_orderkey").join(spark)


@query("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year,
       CAST(month(o_orderdate) AS BIGINT) AS month, CAST(day(o_orderdate) AS BIGINT) AS day
FROM orders""", ids="PRJ-9, FN-9")
def date_parts(spark, sf):
    return FR.date_parts(table(spark, sf, "orders"), "o_orderdate", ["o_orderkey"])
