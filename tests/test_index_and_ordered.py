"""Indexes with kept divisions, folds in order, counter-based normals, records in long form."""

import functools
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kestrel.operators import index as IX
from kestrel.operators import keyed as K
from kestrel.operators import ordered as O
from kestrel.operators import quality as Q
from kestrel.operators import records as R
from kestrel.operators import udf as U
from kestrel.plans.cache import plan_text
from kestrel.sources.files import normal_at


# ---------------------------------------------------------------------- index

def folders(path):
    return {d for d in os.listdir(path) if d.startswith("_part=")}


@pytest.mark.parametrize("kind", ["long", "string", "date", "double"])
def test_index_parts_are_even_and_ordered(spark, scratch, kind):
    n, parts = 6000, 5
    rng = np.random.default_rng(2)
    key = {"long": F.col("v").cast("long"), "double": F.col("v"), "date": F.date_add(F.lit("2000-01-01"), F.col("v").cast("int")),
           "string": F.concat(F.lit("Customer#"), F.lpad(F.col("v").cast("long").cast("string"), 9, "0"))}[kind]
    values = np.abs(rng.lognormal(6, 1, n)).round(3)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i long, v double").select("i", key.alias("k")).repartition(3)
    path = IX.write_index(df, "k", f"{scratch}/{kind}", parts)
    kept = IX.divisions(spark, path).orderBy("_part").collect()
    assert [r["_part"] for r in kept] == list(range(parts)) and sum(r["n"] for r in kept) == n
    assert all(a["hi"] <= b["lo"] for a, b in zip(kept, kept[1:]))
    assert max(r["n"] for r in kept) < 1.35 * n / parts
    lo, hi = kept[1]["lo"], kept[1]["hi"]
    got = IX.loc(spark, path, "k", lo, hi)
    want = df.filter(F.col("k").between(F.lit(lo), F.lit(hi)))
    assert got.columns == ["i", "k"] and sorted(r["i"] for r in got.collect()) == sorted(r["i"] for r in want.collect())
    opened = {os.path.basename(os.path.dirname(f)) for (f,) in got.select(F.input_file_name()).distinct().collect()}
    assert opened < folders(path) and IX.read_index(spark, path).count() == n


def test_index_hot_and_null_keys(spark, scratch):
    df = spark.range(9000).select(F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("k"), "id")
    path = IX.write_index(df, "k", f"{scratch}/hot", 9)
    kept = {r["_part"]: r for r in IX.divisions(spark, path).collect()}
    assert kept[-1]["n"] == 900 and kept[-1]["lo"] is None
    own = [r["n"] for p, r in kept.items() if p >= 0]
    assert sum(own) == 8100 and max(own) < 1.5 * 8100 / 9            # the hot value spans parts
    assert IX.loc(spark, path, "k", 500).count() == df.filter("k = 500").count()
    assert IX.loc(spark, path, "k", 5000).collect() == [] and IX.loc(spark, path, "k", -3, 10 ** 9).count() == 8100
    assert "PartitionFilters: [" in plan_text(IX.loc(spark, path, "k", 3))


def test_index_edges(spark, scratch):
    empty = spark.createDataFrame([], "k string, v long")
    assert IX.loc(spark, IX.write_index(empty, "k", f"{scratch}/e", 3), "k", "a").collect() == []
    one = spark.createDataFrame([("a", 1), ("a", 2), ("", 3), (None, 4)], "k string, v long")
    path = IX.write_index(one, "k", f"{scratch}/o", 1)
    assert sorted(r["v"] for r in IX.loc(spark, path, "k", "a").collect()) == [1, 2]
    assert [r["v"] for r in IX.loc(spark, path, "k", "").collect()] == [3]


# -------------------------------------------------------------- folds in order

@pytest.fixture()
def tiny_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def entries(spark):
    rows = [("hot", i, f"h{i}") for i in range(400)] + [(f"k{i % 30}", i, f"v{i}") for i in range(300)]
    rows += [(None, 2, "n2"), (None, 1, "n1"), ("gap", 1, None), ("gap", 2, "g"), ("void", 1, None)]
    return rows, spark.createDataFrame(rows, "k string, at long, v string").repartition(5)


def expected(rows, fn):
    groups = {}
    for k, _, v in sorted(rows, key=lambda r: r[1]):
        if v is not None:
            groups.setdefault(k, []).append(v)
    return {k: fn(vs) for k, vs in groups.items()}


def test_ordered_concat(spark, tiny_batches):
    rows, df = entries(spark)
    got = {r["k"]: r["text"] for r in O.ordered_concat(df, "k", ["at"], "v", "|").collect()}
    assert got == expected(rows, "|".join)
    back = {r["k"]: r["text"] for r in O.ordered_concat(df, "k", ["at"], "v", "|", falling=True).collect()}
    assert back == expected(rows, lambda vs: "|".join(vs[::-1]))
    plan = plan_text(O.ordered_concat(df, "k", ["at"], "v"))
    assert "rangepartitioning(_k" in plan and "collect_list" not in plan
    assert O.ordered_concat(df.limit(0), "k", ["at"], "v").collect() == []


def test_fold_in_order(spark, tiny_batches):
    rows, df = entries(spark)
    step = lambda a, b: f"({a}{b})"[:40]                                              # noqa: E731  not to be grouped
    got = {r["k"]: r["fold"] for r in O.fold_in_order(df, "k", ["at"], "v", step).collect()}
    assert got == expected(rows, lambda vs: functools.reduce(step, vs))
    join = lambda a, b: a + "." + b                                                   # noqa: E731
    got = {r["k"]: r["fold"] for r in O.fold_in_order(df, "k", ["at"], "v", join, associative=True).collect()}
    assert got == expected(rows, ".".join)


def test_a_hot_key_is_folded_by_several_tasks(spark):
    """All rows are one key: the segments of the first pass come from many partitions."""
    df = spark.range(0, 40_000, 1, 8).select(F.lit("hot").alias("k"), F.col("id").alias("at"), F.col("id").cast("string").alias("v"))
    spread = O._sorted_runs(df, "k", [F.col("at")], "v", spread=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 6 and max(sizes) < 12_000
    assert O.ordered_concat(df, "k", ["at"], "v", ",").first()["text"] == ",".join(map(str, range(40_000)))


@pytest.mark.parametrize("associative", [True, False])
def test_upsert_merge_with_a_function(spark, associative):
    base = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("d", None)], "k string, v long")
    updates = spark.createDataFrame([("a", 5), ("a", 9), ("c", 4), ("e", 1), ("e", 1), ("b", None)], "k string, v long")
    got = dict(K.upsert_merge(base, updates, "k", "v", combine=lambda new, old: new + old, associative=associative).collect())
    assert got == {"a": 15, "b": 2, "c": 4, "d": None, "e": 2}


def test_upsert_merge_order_matters(spark):
    base = spark.createDataFrame([("a", 1)], "k string, v long")
    updates = spark.createDataFrame([("a", 3, 2), ("a", 10, 1)], "k string, v long, at long")
    got = K.upsert_merge(base, updates, "k", "v", combine=lambda new, old: 2 * old + new, order="at").first()["v"]
    assert got == 2 * (2 * 1 + 10) + 3


# ------------------------------------------------------- normals, records, zip

def test_normals_depend_on_the_cell_alone(spark):
    cells = spark.range(200_000)
    values = lambda df, seed=5: dict(df.select("id", normal_at(F.col("id"), seed, 10.0, 0.1).alias("v")).collect())
    a, b = values(cells), values(cells.repartition(7))
    assert a == b and values(cells.limit(50), 6) != values(cells.limit(50))
    v = np.array([a[i] for i in range(200_000)])
    z = (v - 10) / 0.1
    assert abs(z.mean()) < 0.01 and abs(z.std() - 1) < 0.01 and abs((z ** 3).mean()) < 0.03 and abs((z ** 4).mean() - 3) < 0.1
    assert abs(np.corrcoef(z[:-1], z[1:])[0, 1]) < 0.01 and len(np.unique(v)) > 199_000
    assert abs((np.abs(z) < 1).mean() - 0.6827) < 0.005 and abs((z > 2).mean() - 0.02275) < 0.002


def test_records_in_long_form(spark):
    heads = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, name string")
    rows = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (9, 90)], "id long, amount long")
    assert sorted(tuple(r) for r in R.denormalize_rows(heads, rows, "id", ["id", "name"], ["amount"]).collect()) == \
        [(1, "a", 10), (1, "a", 11), (3, "c", 30)]
    assert sorted(r["amount"] for r in R.flatten_rows(heads, rows, "id", ["amount"]).collect()) == [10, 11, 30]


def test_unnest_batches():
    kind = pa.list_(pa.struct([("x", pa.int64())]))
    b = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([[{"x": 5}, {"x": None}], None, []], kind)], names=["id", "l"])
    assert U.unnest(b, "l", ["id"]).to_pydict() == {"id": [1, 1], "x": [5, None]}
    assert U.unnest(b.slice(1), "l", ["id"]).num_rows == 0 and U.unnest(b.slice(0, 1), "l", ["id"]).num_rows == 2


def test_zip_ranks_only_the_leading_rows(spark):
    long = spark.range(10_000).select((F.col("id") * 7 % 10_000).alias("i"))
    head = Q.leading_rows(long, ["i"], 100, 10_000)
    assert 100 <= head.count() < 1000 and head.filter("i < 100").count() == 100
    z = Q.zip_by_position(long, spark.range(50).withColumnRenamed("id", "j"), ["i"], ["j"])
    assert sorted((r["i"], r["j"]) for r in z.collect()) == [(k, k) for k in range(50)]
    names = spark.createDataFrame([(f"n{k}",) for k in range(9)], "s string")
    assert Q.leading_rows(names, ["s"], 3, 9) is names
