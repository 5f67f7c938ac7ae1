"""Hot keys: one key holding a third of all rows must not build an unbounded
record, group or task input, and results stay whole."""

import pandas as pd
from pyspark.sql import functions as F

from kestrel.operators import records as R
from kestrel.operators import udf as U
from kestrel.sources.tables import account_heads, account_rows, nested_from, table

SF = "/root/testdata/sf0.01"


def skewed_lineitem(spark):
    li = table(spark, SF, "lineitem")
    # a third of the rows move to order 0, keeping their (repeating) line numbers
    return li.withColumn("l_orderkey", F.when(F.pmod(F.xxhash64("l_partkey", "l_suppkey",
                                                                "l_extendedprice"), F.lit(3)) == 0,
                                              F.lit(0).cast("bigint"))
                         .otherwise(F.col("l_orderkey")))


def test_hot_order_records_are_whole(spark):
    li = skewed_lineitem(spark)
    hot_rows = li.filter(F.col("l_orderkey") == 0).count()
    assert hot_rows > 15_000
    rec = nested_from(table(spark, SF, "orders"), li)
    hot = R.with_size(rec, "transactions").filter(F.col("id") == 0)
    assert hot.count() == 4                                # one record per file, whatever its size
    assert hot.agg(F.sum("n")).first()[0] == hot_rows      # nothing dropped
    assert R.flatten(rec, "transactions").count() == li.count()
    stats = R.record_stats(account_heads(table(spark, SF, "orders")), account_rows(li), "id", ["file"],
                           {"n": F.count(F.lit(1))}).filter(F.col("id") == 0)
    assert sorted((r["file"], r["n"]) for r in stats.collect()) == sorted((r["file"], r["n"]) for r in hot.collect())


def test_hot_group_chunked_apply(spark):
    li = skewed_lineitem(spark).select("l_orderkey", "l_quantity", "l_linenumber", "l_partkey",
                                       "l_suppkey", "l_extendedprice")

    def demean(pdf):
        return pd.DataFrame({"k": pdf["l_orderkey"], "d": pdf["l_quantity"] - pdf["m"],
                             "rows": len(pdf)})

    out = U.apply_in_chunks(li, ["l_orderkey"], demean, "k long, d double, rows long",
                            context={"m": F.avg("l_quantity")})
    agg = out.groupBy("k").agg(F.sum("d").alias("s"), F.max("rows").alias("rows"),
                               F.count(F.lit(1)).alias("n"))
    assert agg.agg(F.max("rows")).first()[0] <= 10_000      # at most one Arrow batch
    assert agg.agg(F.sum("n")).first()[0] == li.count()
    assert agg.agg(F.max(F.abs("s"))).first()[0] < 1e-6


def test_hot_customer_join_is_split_by_aqe(spark):
    from kestrel.plans.cache import plan_text
    from kestrel.plans.joins import join_small
    o = table(spark, SF, "orders").select(
        F.when(F.pmod("o_orderkey", F.lit(3)) == 0, F.lit(7).cast("bigint"))
         .otherwise(F.col("o_custkey")).alias("o_custkey"), "o_orderkey", "o_totalprice") \
        .repartition(8)        # several map tasks, as any large scan has (AQE splits by map blocks)
    c = table(spark, SF, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # max_bytes=-1: the customer side counts as too big to broadcast, as at scale
        j = join_small(o, c, "o_custkey", max_bytes=-1)
        n = j.count()
        j.collect()
        plan = plan_text(j)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert n == o.count()                                  # every order found its customer
    assert "skew=true" in plan                             # the hot key's partition was split
