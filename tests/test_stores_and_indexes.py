"""Co-partitioned joins, the keyed array store, stacks of slices."""

import os
import threading

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from kestrel.operators import grid as GR
from kestrel.operators.array_store import ArrayStore
from kestrel.operators.copartition import co_partition
from kestrel.plans.cache import plan_text

QUERIES = E.queries()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


# ------------------------------------------------------- co-partitioned join

def test_join_on_index_has_no_exchange(spark):
    plan = final_plan(QUERIES["join_on_index"](spark, SF_SMALL))
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2


def test_co_partition_splits_hot_keys(spark):
    """Half of the left and a third of the right rows hold one key."""
    left = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.col("id") % 400).alias("k"), "id")
    right = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 300).alias("k"), F.col("id").alias("r"))
    pair = co_partition(left, right, "k", buckets=16)
    got = pair.join(spark)
    assert sorted(got.columns) == ["id", "k", "r"]
    want = left.join(right, "k")
    assert got.select("k", "id", "r").exceptAll(want.select("k", "id", "r")).isEmpty()
    assert got.count() == want.count()
    sizes = [r["count"] for r in spark.table(pair.left).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 0.5 * sum(sizes)                        # the hot key's rows lie in many buckets
    salts = spark.table(pair.left).filter("k = 7").select("_salt_left").distinct().count()
    assert salts >= 8
    pair.drop(spark)
    assert not spark.catalog.tableExists(pair.left)


def test_co_partition_empty(spark):
    left = spark.createDataFrame([(None, 1)], "k long, a long")
    assert co_partition(left, left.select("k", F.col("a").alias("b")), "k", buckets=4).join(spark).collect() == []


# --------------------------------------------------------------- array store

def grid(spark, rows, cols, f):
    return spark.createDataFrame([(i, j, float(f(i, j))) for i in rows for j in cols], "i long, j long, value double")


def test_array_store_regions(spark, scratch):
    store = ArrayStore(spark, f"{scratch}/store")
    assert store.keys() == []
    store.write("/x", [(0, 6), (0, 4)], grid(spark, range(6), range(4), lambda i, j: i * 10 + j), ["i", "j"])
    store.write("x", [(2, 4), (1, 3)], grid(spark, [2], [1, 2], lambda i, j: -1), ["i", "j"])       # row 3 of the region becomes absent
    want = {(i, j): i * 10 + j for i in range(6) for j in range(4)}
    want = {c: v for c, v in want.items() if not (2 <= c[0] < 4 and 1 <= c[1] < 3)} | {(2, 1): -1, (2, 2): -1}
    read = lambda *a, **k: {(r["i"], r["j"]): r["value"] for r in store.read("x", *a, **k).collect()}      # noqa: E731
    assert read() == want and store.keys() == ["x"]
    assert read([(2, 5), (0, 2)]) == {c: v for c, v in want.items() if 2 <= c[0] < 5 and c[1] < 2}
    assert len(read(version=1)) == 24                                                # an earlier version is still there
    assert read([(90, 99), (0, 4)]) == {}
    assert store.compact("x") == 3 and read() == want and len(store.manifest("x")["parts"]) == 1
    store.vacuum("x")
    assert read() == want and len([f for f in os.listdir(f"{scratch}/store/x") if f.startswith("part-")]) == 1
    store.write("x", [(0, 100), (0, 100)], grid(spark, [1], [1], lambda i, j: 5), ["i", "j"])
    assert read() == {(1, 1): 5.0} and len(store.manifest("x")["parts"]) == 1        # covered regions leave the manifest


def test_array_store_refuses(spark, scratch):
    store = ArrayStore(spark, scratch)
    cells = grid(spark, [1], [1], lambda i, j: 5)
    with pytest.raises(ValueError, match="outside"):
        store.write("x", [(0, 1), (0, 1)], cells, ["i", "j"])
    with pytest.raises(KeyError):
        store.read("x")
    store.write("x", [(0, 2), (0, 2)], cells, ["i", "j"])
    with pytest.raises(ValueError, match="other dimensions"):
        store.write("x", [(0, 2)], cells.drop("j"), ["i"])
    assert len([f for f in os.listdir(f"{scratch}/x") if f.startswith("part-")]) == 1


def test_array_store_concurrent_writers(spark, scratch):
    """Both writes are published, whoever comes first."""
    store = ArrayStore(spark, scratch)
    errors = []

    def put(k):
        try:
            store.write("x", [(k, k + 1)], spark.createDataFrame([(k, float(k))], "i long, value double"), ["i"])
        except Exception as e:                                                       # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=put, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and sorted(r["i"] for r in store.read("x").collect()) == [0, 1, 2, 3]
    assert store._version("x") == 4 and not store._commit("x", 4, {})                # a taken version is not overwritten


def test_array_store_slice_reaches_the_files(spark, scratch):
    store = ArrayStore(spark, scratch)
    store.write("x", [(0, 100)], spark.range(100).select(F.col("id").alias("i"), F.lit(1.0).alias("value")), ["i"])
    store.write("x", [(50, 60)], spark.range(50, 60).select(F.col("id").alias("i"), F.lit(2.0).alias("value")), ["i"])
    plan = plan_text(store.read("x", [(10, 20)]))
    assert plan.count("PushedFilters") == 1 and "GreaterThanOrEqual(i,10), LessThan(i,20)" in plan


# --------------------------------------------------------------------- stack

def test_stack_opens_one_folder(spark, scratch):
    df = spark.range(30).select((F.col("id") % 3).alias("day"), F.col("id").alias("v"))
    path = GR.write_slices(df, "day", f"{scratch}/s")
    GR.add_slice(spark.createDataFrame([(9, 77)], "day long, v long"), "day", 3, path)
    st = GR.stack_files(spark, path, "day", df.schema)
    assert st.count() == 31 and st.filter("day = 3").first()["v"] == 77
    one = st.filter(F.col("day") == 1)
    assert "PartitionFilters: [isnotnull(day" in plan_text(one) and {os.path.basename(os.path.dirname(f)) for f in one.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {"day=1"}
    with pytest.raises(Exception, match="already exists"):
        GR.add_slice(df, "day", 1, path)


def test_stack_query_prunes(spark):
    assert "day#" in plan_text(QUERIES["grid_stack_slice"](spark, SF_SMALL)).split("PartitionFilters:")[1].splitlines()[0]
