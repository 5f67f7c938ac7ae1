"""Catalogue: the Python escape hatch (pandas UDFs, chunked group apply,
two-phase fold, generated sub-frames) and cached reuse."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions.arith import round_half_away
from ..operators import udf as U
from ..operators.selection import group_quantile
from .cache import cut_lineage, persisted
from ..sources.tables import account, nested, table
from .registry import query

_ACCOUNT = "account AS (SELECT c_custkey AS id, c_mktsegment AS names, c_acctbal AS amount FROM customer)"


def _positive(s: pd.Series) -> pd.Series:
    return s > 0


def _inc_twice(s: pd.Series) -> pd.Series:
    return s * 2 + 1


@query("udf_map", f"""
WITH {_ACCOUNT} SELECT id, amount * 2 + 1 AS y FROM account WHERE amount > 0""", ids="UD-1")
def udf_map(spark, sf):
    a = U.filter_values(account(spark, sf), "amount", _positive)
    f = U.map_values(_inc_twice, "double")
    return a.select("id", f(F.col("amount")).alias("y"))


def _center(pdf: pd.DataFrame) -> pd.DataFrame:
    centered = pdf["amount"] - pdf["group_mean"]
    return pd.DataFrame({"id": pdf["id"], "names": pdf["names"], "centered": centered,
                         "z": centered / pdf["group_std"]})


@query("group_apply", f"""
WITH {_ACCOUNT}
SELECT id, names, round(amount - avg(amount) OVER (PARTITION BY names), 6) AS centered,
       round((amount - avg(amount) OVER (PARTITION BY names)) / stddev_pop(amount) OVER (PARTITION BY names), 6) AS z
FROM account""", ids="UD-2")
def group_apply(spark, sf):
    out = U.apply_in_chunks(account(spark, sf), ["names"], _center,
                            "id long, names string, centered double, z double",
                            context={"group_mean": F.avg("amount"),
                                     "group_std": F.stddev_pop("amount")})
    return out.select("id", "names", round_half_away("centered", 6).alias("centered"),
                      round_half_away("z", 6).alias("z"))


@query("udaf_fold", """
SELECT CAST(o_orderkey % 2 AS BIGINT) AS key, max(o_orderkey) AS value FROM orders GROUP BY 1""",
       ids="UD-3, AG-14")
def udaf_fold(spark, sf):
    o = table(spark, sf, "orders")
    return U.fold_by(o, F.pmod("o_orderkey", F.lit(2)).cast("bigint"), "o_orderkey",
                     np.maximum, np.iinfo(np.int64).min, value_type="bigint")


def _incr(count, _):
    return count + 1


def _add(a, b):
    return a + b


def _add_amounts(total, amounts):
    return total + float(sum(amounts))


_NESTED = """li AS (SELECT l_orderkey AS id, l_partkey % 4 AS file, l_extendedprice AS amount FROM lineitem)"""


@query("udaf_fold_count", f"""
WITH {_ACCOUNT} SELECT names AS key, CAST(count(*) AS BIGINT) AS value FROM account GROUP BY names""", ids="UD-3, AG-14")
def udaf_fold_count(spark, sf):
    return U.fold_by(account(spark, sf), "names", "amount", _incr, 0, _add, 0, value_type="bigint")


@query("udaf_fold_amounts", f"""
WITH {_NESTED}
SELECT o.o_orderpriority AS key, round(coalesce(sum(li.amount), 0), 2) AS value
FROM orders o LEFT JOIN li ON li.id = o.o_orderkey GROUP BY 1""", ids="UD-3, AG-14")
def udaf_fold_amounts(spark, sf):
    amounts = F.transform("transactions", lambda t: t["amount"])
    return U.fold_by(nested(spark, sf), "name", amounts, _add_amounts, 0.0, _add, 0.0) \
        .select("key", round_half_away("value", 2).alias("value"))


@query("group_median", f"""
WITH {_ACCOUNT} SELECT names, round(median(amount), 6) AS median FROM account WHERE amount IS NOT NULL GROUP BY names""",
       ids="UD-2")
def group_median(spark, sf):
    return group_quantile(account(spark, sf), ["names"], "amount", 0.5, "median") \
        .select("names", round_half_away("median", 6).alias("median"))


def _transaction_rows(batch):
    return U.unnest(batch, "transactions", ["id", "name"])


@query("flat_map_records", """
SELECT o.o_orderkey AS id, o.o_orderpriority AS name, CAST(l.l_linenumber AS BIGINT) AS transaction_id,
       l.l_extendedprice AS amount
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""", ids="UD-4")
def flat_map_records(spark, sf):
    return U.flat_map_arrow(nested(spark, sf).select("id", "name", "transactions"), _transaction_rows,
                            "id long, name string, transaction_id long, amount double")


def _day_hours(args: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"day": args["day"].repeat(24), "hour": np.tile(np.arange(24, dtype=np.int64), len(args))})


@query("gen_from_functions", """
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
grid AS (SELECT day, CAST(unnest(range(24)) AS BIGINT) AS hour FROM days),
c AS (SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) AS BIGINT) AS hour, count(*) AS n FROM events GROUP BY 1, 2)
SELECT g.day, g.hour, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN c ON g.day = c.day AND g.hour = c.hour""", ids="SRC-6")
def gen_from_functions(spark, sf):
    e = table(spark, sf, "events")
    days = e.select(F.to_date("ts").alias("day")).distinct()
    grid = U.from_functions(days, _day_hours, "day date, hour long", batched=True)
    counts = e.groupBy(F.to_date("ts").alias("day"), F.hour("ts").cast("bigint").alias("hour")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, ["day", "hour"], "left") \
        .select("day", "hour", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@query("cached_reuse", f"""
WITH {_ACCOUNT}
SELECT names, round(avg(amount), 6) AS mean, CAST(count(*) AS BIGINT) AS n FROM account GROUP BY names
UNION ALL
SELECT 'ALL' AS names, round(avg(amount), 6) AS mean, CAST(count(*) AS BIGINT) AS n FROM account""",
       ids="MT-1, MT-3")
def cached_reuse(spark, sf):
    # the account frame is cached while both aggregates read it, the result is
    # pinned with a reliable checkpoint (shared folder), and the cache is
    # released before returning, so later queries never see a stale cache
    with persisted(account(spark, sf)) as a:
        per = a.groupBy("names").agg(F.avg("amount").alias("mean"), F.count(F.lit(1)).alias("n"))
        tot = a.agg(F.lit("ALL").alias("names"), F.avg("amount").alias("mean"),
                    F.count(F.lit(1)).alias("n"))
        out = cut_lineage(per.unionByName(tot).select("names", round_half_away("mean", 6).alias("mean"), "n"))
    return out
