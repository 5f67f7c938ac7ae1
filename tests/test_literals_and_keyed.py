"""Exact expectations from the reference's literals, keyed-map operators,
quarantine, and brute-force checks for the fold operators."""

import functools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.functions.arith import floor_div, ieee_divide, int_floor_div, nansum, py_mod
from kestrel.operators import groups as G
from kestrel.operators import grid as GR
from kestrel.operators import keyed as K
from kestrel.operators import quality as Q
from kestrel.operators import udf as U

NAMES = ["Alice", "Bob", "Charlie", "Dan", "Edith", "Frank"]


def test_evens_squared(spark):
    df = spark.range(1, 11)
    got = df.filter(py_mod("id", 2) == 0).select(F.pow("id", 2).cast("long")).collect()
    assert sorted(r[0] for r in got) == [4, 16, 36, 64, 100]


def test_inc_sum(spark):
    df = spark.createDataFrame([(15,), (30,)], "x long")
    assert df.agg(F.sum(F.col("x") + 1)).first()[0] == 47


def test_names_by_length(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    got = sorted(tuple(r) for r in G.ordered_members(df, F.length("name"), "name").collect())
    assert got == [(3, 1, "Bob"), (3, 2, "Dan"), (5, 1, "Alice"), (5, 2, "Edith"), (5, 3, "Frank"), (7, 1, "Charlie")]
    long_form = G.group_members(df, F.length("name"), "name").collect()
    assert sorted((r["key"], r["name"], r["group_size"]) for r in long_form)[:2] == \
        [(3, "Bob", 2), (3, "Dan", 2)]
    nulls = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k long, m string")
    assert sorted((r["key"] or 0, r["m"], r["group_size"]) for r in G.group_members(nulls, F.col("k"), "m").collect()) == \
        [(0, "a", 2), (0, "b", 2), (1, "c", 1)]


def test_parity_max_three_ways(spark):
    df = spark.range(10)
    by_agg = G.group_reduce(df, py_mod("id", 2), {"max": F.max("id")}).collect()
    assert sorted((r["key"], r["max"]) for r in by_agg) == [(0, 8), (1, 9)]
    folded = U.fold_by(df.repartition(3), py_mod("id", 2), "id", np.maximum,
                       np.iinfo(np.int64).min, value_type="bigint").collect()
    assert sorted((r["key"], r["value"]) for r in folded) == [(0, 8), (1, 9)]
    py = U.fold_by(df.repartition(4), py_mod("id", 2), "id", lambda a, b: max(a, b), -1,
                   value_type="bigint").collect()
    assert sorted((r["key"], r["value"]) for r in py) == [(0, 8), (1, 9)]


def test_fold_count_and_sum(spark):
    df = spark.range(1000)
    c = U.fold_by(df.repartition(5), F.lit(1), "id", np.add, 0, value_type="bigint").first()
    assert c["value"] == 499500


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_fold_by_accumulator_of_another_type(spark, parts):
    rows = [("Alice", 1.5), ("Bob", None), ("Alice", 2.5), (None, 4.0), ("Bob", 1.0)] * 5
    df = spark.createDataFrame(rows, "name string, amount double").repartition(parts)
    count = U.fold_by(df, "name", "amount", lambda n, _: n + 1, 0, lambda a, b: a + b, 0, value_type="bigint")
    assert {r["key"]: r["value"] for r in count.collect()} == {"Alice": 10, "Bob": 10, None: 5}
    total = U.fold_by(df, "name", "amount", lambda t, x: t + (x or 0.0), 0.0, lambda a, b: a + b, 0.0)
    assert {r["key"]: r["value"] for r in total.collect()} == {"Alice": 20.0, "Bob": 5.0, None: 20.0}


def test_exact_division_and_rounding_at_the_edges(spark):
    from kestrel.functions.arith import round_half_away
    big = spark.createDataFrame([(9007199254740993, 1)], "a long, b long")
    assert Q.floor_ratio_sum(big, "a", "b").first()[0] == 9007199254740993
    x = spark.createDataFrame([(1e15,), (4e36,), (2.5,), (float("nan"),)], "x double")
    got = [r[0] for r in x.select(round_half_away("x", 4)).collect()]
    assert got[:3] == [1e15, 4e36, 2.5] and got[3] != got[3]


def test_ratio_sum_and_error(spark):
    good = spark.createDataFrame([(5, 5), (25, 5), (30, 6)], "a long, b long")
    assert Q.floor_ratio_sum(good, "a", "b").first()[0] == 11
    bad = spark.createDataFrame([(5, 5), (25, 0), (30, 6)], "a long, b long")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|divide"):
        Q.floor_ratio_sum(bad, "a", "b").collect()
    summary = {r["status"]: (r["n"], r["total"]) for r in
               Q.ratio_with_quarantine(bad, "a", "b").collect()}
    assert summary == {"ok": (2, 6), "divide_by_zero": (1, None)}


def test_quarantine_write_one_job(spark, scratch):
    df = spark.createDataFrame([(5, 5), (25, 0), (None, 6)], "a long, b long")
    tagged = Q.quarantine(df, Q.zero_divisor_checks("a", "b"))
    Q.write_quarantined(tagged, scratch + "/q")
    back = spark.read.parquet(scratch + "/q")
    got = sorted((r["status"], r["a"]) for r in back.collect())
    assert got == [("divide_by_zero", 25), ("null_input", None), ("ok", 5)]


def test_python_division_semantics(spark):
    df = spark.createDataFrame([(-7, 2), (7, -2), (7, 2)], "a long, b long")
    rows = df.select(floor_div("a", "b").cast("long"), py_mod("a", "b")).collect()
    assert [tuple(r) for r in rows] == [(-4, 1), (-4, -1), (3, 1)]
    big = spark.createDataFrame([(2**62 + 3,), (-5,)], "x long")
    assert [r[0] for r in big.select(int_floor_div("x", 2)).collect()] == [2**61 + 1, -3]
    d = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (3.0, 2.0)], "a double, b double")
    vals = [r[0] for r in d.select(ieee_divide("a", "b")).collect()]
    assert vals[0] == float("inf") and vals[1] == float("-inf") and vals[2] != vals[2] \
        and vals[3] == 1.5


def test_stride_and_nansum(spark):
    df = spark.range(1, 8).select(F.col("id").alias("idx"), F.col("id").cast("double").alias("v"))
    got = GR.strided_slice(df, "idx", 3, start=1).orderBy("idx").collect()
    assert [r["idx"] for r in got] == [1, 4, 7] and [r["new_idx"] for r in got] == [0, 1, 2]
    n = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,), (None,)], "v double")
    assert n.agg(nansum("v")).first()[0] == 3.0
    assert n.agg(F.sum("v")).first()[0] != n.agg(F.sum("v")).first()[0]   # NaN


def test_counter_totals(spark):
    r = K.counter_totals(spark.range(1000), "id").first()
    assert (r["increments"], r["plus_two_total"], r["sum_of_i"]) == (1000, 2000, 499500)


def kv(spark, rows):
    return spark.createDataFrame(rows, "k string, v string")


def test_keyed_map_operations(spark):
    base = kv(spark, [("foo", "bar"), ("han", "solo"), ("r2", "d2"), ("c3", "p0")])
    merged = dict(K.upsert_merge(base, kv(spark, [("foo", "boo")]), "k", "v").collect())
    assert merged["foo"] == "boo was bar" and merged["han"] == "solo"
    replaced = dict(K.replace_where(base, F.col("k") == "r2", "v", "d3").collect())
    assert replaced["r2"] == "d3" and replaced["foo"] == "bar"
    absent = dict(K.upsert_if_absent(base, kv(spark, [("c3", "XX"), ("new", "n")]), "k").collect())
    assert absent["c3"] == "p0" and absent["new"] == "n" and len(absent) == 5
    look = dict(K.lookup_default(kv(spark, [("han", None), ("zz", None)]), base, "k", "v",
                                 "none").collect())
    assert look == {"han": "solo", "zz": "none"}
    entries = sorted((r["position"], r["kv"]) for r in K.kv_entries(base.withColumn("g", F.lit(1)), "g", "k", "v").collect())
    assert entries == [(1, "c3=p0"), (2, "foo=bar"), (3, "han=solo"), (4, "r2=d2")]
    twice = spark.createDataFrame([("foo", "x", 2), ("foo", "y", 1), ("new", "p", 2), ("new", "q", 1)],
                                  "k string, v string, at long")
    merged = K.upsert_merge(base, twice, "k", "v", order="at").collect()
    assert len(merged) == 5 and dict(merged)["foo"] == "x was y was bar" and dict(merged)["new"] == "p was q"
    absent = K.upsert_if_absent(base, twice, "k", order="at").collect()
    assert len(absent) == 5 and dict(absent)["new"] == "q" and dict(absent)["foo"] == "bar"
    first = K.search_first(base.withColumn("g", F.lit(1)), "g", F.length("v") > 3, "k",
                           ["k", "v"]).first()
    assert (first["k"], first["v"]) == ("han", "solo")


def brute_fold(values, init=1, mult=2, m=1_000_003):
    return functools.reduce(lambda a, x: (mult * a + x) % m, values, init)


def test_ordered_fold_hot_key_across_partitions(spark):
    rnd = random.Random(7)
    rows = []
    # one hot key with a third of the rows, plus many small keys
    for i in range(3000):
        rows.append((0, i, rnd.randint(-50, 50)))
    for k in range(1, 700):
        for i in range(rnd.randint(1, 12)):
            rows.append((k, i, rnd.randint(0, 50)))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, o long, v long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        got = {r["k"]: r["fold"] for r in
               K.ordered_fold(df, "k", ["o"], "v", partitions=7).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expect = {}
    for k in {r[0] for r in rows}:
        vals = [v for _, _, v in sorted(r for r in rows if r[0] == k)]
        expect[k] = brute_fold(vals)
    assert got == expect


def test_modpow_column(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (10**12 + 7,)], "e long")
    got = [r[0] for r in df.select(K.modpow(F.lit(2), F.col("e"), 1_000_003)).collect()]
    assert got == [pow(2, e, 1_000_003) for e in [0, 1, 5, 10**12 + 7]]


def test_zip_by_position_ratio(spark):
    a = spark.createDataFrame([(0, 5), (1, 25), (2, 30)], "i long, a long")
    b = spark.createDataFrame([(10, 5), (11, 5), (12, 6), (13, 99)], "j long, b long")
    z = Q.zip_by_position(a, b, ["i"], ["j"])
    assert sorted((r["a"], r["b"]) for r in z.collect()) == [(5, 5), (25, 5), (30, 6)]
    assert Q.floor_ratio_sum(z, "a", "b").first()[0] == 11


def test_flat_map_denormalize(spark):
    import pandas as pd
    df = spark.createDataFrame([(1, "Alice", [1.0, 2.0]), (2, "Bob", [])],
                               "id long, name string, amounts array<double>")

    def denorm(pdf):
        rows = [(i, n, x) for i, n, xs in zip(pdf["id"], pdf["name"], pdf["amounts"]) for x in xs]
        return pd.DataFrame(rows, columns=["id", "name", "amount"])

    out = U.flat_map(df, denorm, "id long, name string, amount double")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "Alice", 1.0), (1, "Alice", 2.0)]


def test_fold_by_small_batches_many_keys(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 40), rnd.randint(-1000, 1000)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        u = {r["key"]: r["value"] for r in U.fold_by(df, "k", "v", np.add, 0,
                                                       value_type="bigint").collect()}
        p = {r["key"]: r["value"] for r in U.fold_by(df, "k", "v", lambda a, b: max(a, b),
                                                       -10**9, value_type="bigint").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sums, maxes = {}, {}
    for k, v in rows:
        sums[k] = sums.get(k, 0) + v
        maxes[k] = max(maxes.get(k, -10**9), v)
    assert u == sums and p == maxes


def test_ordered_fold_default_partitions_hot_key(spark):
    rnd = random.Random(17)
    rows = [(5, i, rnd.randint(0, 99)) for i in range(4000)]
    rows += [(k, i, rnd.randint(0, 99)) for k in range(6, 400) for i in range(rnd.randint(1, 9))]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, o long, v long").repartition(6)
    got = {r["k"]: r["fold"] for r in K.ordered_fold(df, "k", ["o"], "v").collect()}
    expect = {}
    for k in {r[0] for r in rows}:
        expect[k] = brute_fold([v for _, _, v in sorted(r for r in rows if r[0] == k)])
    assert got == expect
