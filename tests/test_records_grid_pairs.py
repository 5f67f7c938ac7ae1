"""Nested JSON records, blocked arrays, and pairs within a radius vs brute force."""

import gzip
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators import grid as GR
from kestrel.operators import neighbours as N
from kestrel.operators import records as R

TX = T.ArrayType(T.StructType([T.StructField("transaction-id", T.LongType()),
                               T.StructField("amount", T.DoubleType())]))
ACCOUNT = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                        T.StructField("transactions", TX)])


@pytest.fixture()
def accounts(spark, scratch):
    recs = [
        [{"id": 1, "name": "Alice", "transactions": [{"transaction-id": 1, "amount": 1.0}]},
         {"id": 2, "name": "Bob", "transactions": []}],
        [{"id": 1, "name": "Alice", "transactions": [{"transaction-id": 2, "amount": 2.0},
                                                     {"transaction-id": 3}]},
         {"id": 3, "name": "Alice", "transactions": [{"transaction-id": 4, "amount": 10.0}]}],
    ]
    for i, part in enumerate(recs):
        with gzip.open(os.path.join(scratch, f"accounts.{i}.json.gz"), "wt") as f:
            for r in part:
                f.write(json.dumps(r) + "\n")
            if i == 1:
                f.write("{not json\n")
    return R.read_json_records(spark, os.path.join(scratch, "accounts.*.json.gz"), ACCOUNT)


def test_json_records(accounts):
    rows = accounts.collect()
    assert len(rows) == 5
    assert sum(r["_corrupt_record"] is not None for r in rows) == 1


def test_nested_operators(accounts):
    good = accounts.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    sizes = sorted(r["n"] for r in R.with_size(good, "transactions").collect())
    assert sizes == [0, 1, 1, 2]
    flat = R.flatten(good, "transactions")
    assert flat.count() == 4                       # the empty list contributes nothing
    den = R.denormalize(good, ["id", "name"], "transactions")
    assert den.filter(F.col("name") == "Alice").count() == 4
    alice1 = good.filter(F.col("id") == 1)
    assert R.nested_mean(alice1, "transactions", "amount").first()[0] == 1.5   # 1 and 2
    sums = {r["name"]: r["total"] for r in R.fold_by(
        good, "name", {"total": F.sum(R.list_sum("transactions", "amount"))}).collect()}
    assert sums == {"Alice": 13.0, "Bob": 0.0}
    counts = {r["name"]: r["n"] for r in R.fold_by(good, "name", {"n": F.count("id")}).collect()}
    assert counts == {"Alice": 3, "Bob": 1}


def test_blocked_mean_equals_mean(spark):
    df = spark.range(0, 10_007).select(F.col("id").alias("idx"),
                                       (F.col("id") % 13 * 0.5).alias("value"))
    m = GR.blocked_mean(df, "idx", "value", 1000).first()[0]
    assert abs(m - df.agg(F.avg("value")).first()[0]) < 1e-12
    s = {r["chunk"]: r["chunk_sum"] for r in GR.blocked_sum(df, "idx", "value", 1000).collect()}
    assert len(s) == 12 and abs(s[None] - sum(v for k, v in s.items() if k is not None)) < 1e-6


def test_stack_files_and_anomaly(spark, scratch):
    paths = []
    for day in range(3):
        p = os.path.join(scratch, f"day{day}.parquet")
        spark.createDataFrame([(c, float(day * 10 + c)) for c in range(4)],
                              "cell long, value double").write.parquet(p)
        paths.append(p)
    st = GR.stack_files(spark, paths, "day")
    assert sorted(r["day"] for r in st.select("day").distinct().collect()) == [0, 1, 2]
    an = {r["cell"]: r["anomaly"] for r in GR.anomaly(st, "day", ["cell"]).collect()}
    assert an == {c: -10.0 for c in range(4)}       # day 0 minus mean of 0, 10, 20


def test_explode_vectors_step(spark):
    df = spark.createDataFrame([(1, [float(x) for x in range(10)])], "id long, v array<double>")
    got = [(r["j"], r["value"]) for r in GR.explode_vectors(df, "id", "v", step=4).collect()]
    assert got == [(0, 0.0), (4, 4.0), (8, 8.0)]


def test_pairs_within_match_brute_force(spark):
    """Every pair once, copies and tiny distances included, whatever the salts."""
    rng = np.random.default_rng(1981)
    pts = rng.normal(0, 2, (400, 3)) - 0.5
    pts[10] = pts[3]                                 # identical points: r2 = 0
    pts[20] = pts[5] + np.array([3e-4, 0, 0])        # 0 < r2 <= 1e-6
    pts[200:300] = rng.normal(0, 0.2, (100, 3))      # a hot cell
    rows = [(i, *map(float, p)) for i, p in enumerate(pts)]
    rows += [(3, 9e9, 0.0, 0.0), (None, 0.0, 0.0, 0.0), (900, None, 0.0, 0.0), (901, float("nan"), 0.0, 0.0), (902, 0.0, float("inf"), 0.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double, z double")
    r2 = ((pts[:, None] - pts[None]) ** 2).sum(-1)
    iu = [(i, j) for i in range(400) for j in range(i + 1, 400) if r2[i, j] <= 0.64]
    for cell_rows in (None, 7):
        got = {(r["a"], r["b"]): r["r2"] for r in N.pairs_within(df, "id", ["x", "y", "z"], 0.8, cell_rows=cell_rows).collect()}
        assert sorted(got) == iu and all(abs(got[p] - r2[p]) < 1e-12 for p in iu)
    assert N.pairs_within(df, "id", ["x", "y", "z"], 0.8).count() == len(iu)          # none twice
    masked = N.pairs_within(df, "id", ["x", "y", "z"], 0.8, above=1e-6)
    assert sorted((r["a"], r["b"]) for r in masked.collect()) == [p for p in iu if r2[p] > 1e-6]
    st = {r["id"]: r for r in N.near_stats(df, "id", ["x", "y", "z"], 0.8).collect()}
    near = r2 + np.diag(np.full(400, np.inf))
    for i in range(400):
        own = near[i][near[i] <= 0.64]
        assert st[i]["n_near"] == len(own) and (len(own) == 0 or abs(st[i]["nearest_r2"] - own.min()) < 1e-12)
    assert (st[900]["n_near"], st[900]["nearest_r2"]) == (0, None) and None in st
    with pytest.raises(ValueError):
        N.pairs_within(df, "id", ["x"], 0.0)


def test_pairs_within_plan(spark):
    """An equi-join on the cells; the visiting side has half of the neighbours."""
    from kestrel.plans.cache import plan_text
    df = spark.range(100).select("id", F.rand(1).alias("x"), F.rand(2).alias("y"))
    plan = plan_text(N.pairs_within(df, "id", ["x", "y"], 0.1))
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan and "InArrow" not in plan
    assert len(N.half_neighbourhood(2)) == 5 and len(N.half_neighbourhood(3)) == 14


def test_empty_and_null_edges(spark):
    from kestrel.operators import keyed as K
    empty = spark.createDataFrame([(1, "x", [])], ACCOUNT_SIMPLE)
    assert R.nested_mean(empty, "transactions", "amount").first()[0] is None
    df = spark.createDataFrame([(1, 1, 3), (1, 2, None), (1, 3, 4)], "k long, o long, v long")
    assert K.ordered_fold(df, "k", ["o"], "v").first()["fold"] == ((1 * 2 + 3) * 2 + 4)
    v = spark.createDataFrame([(0, None)], "idx long, value double")
    assert GR.blocked_mean(v, "idx", "value", 10).first()[0] is None


ACCOUNT_SIMPLE = "id long, name string, transactions array<struct<transaction_id:long, amount:double>>"


def test_stack_slices_and_pluck_list(spark, scratch):
    a = spark.createDataFrame([(0, 1.0), (1, 2.0)], "j long, value double")
    b = spark.createDataFrame([(0, 3.0), (1, 4.0)], "j long, value double")
    st = GR.stack([a, b], "k")
    assert sorted(tuple(r) for r in st.select("k", "j", "value").collect()) == \
        [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)]
    means = {r["j"]: r["mean"] for r in GR.axis_mean(st, ["j"]).collect()}
    assert means == {0: 2.0, 1: 3.0}
    rec = spark.createDataFrame([(1, "x", [(1, 2.5), (2, None)])], ACCOUNT_SIMPLE)
    got = rec.select(R.pluck_list_field("transactions", "amount")).first()[0]
    assert got == [2.5, None]
    assert rec.select(R.list_max("transactions", "amount")).first()[0] == 2.5


def test_count_per_file(spark, scratch):
    from kestrel.operators import text as T
    for i in range(3):
        with open(os.path.join(scratch, f"part{i}.txt"), "w") as f:
            f.write("\n".join(["line"] * (i + 1)) + "\n")
    got = sorted(r["n_rows"] for r in T.count_per_file(T.read_lines(
        spark, os.path.join(scratch, "part*.txt"))).collect())
    assert got == [1, 2, 3]
    assert T.row_count(T.read_lines(spark, os.path.join(scratch, "part*.txt"))).first()[0] == 6
