"""Exact order statistics, inferred CSV types with rejects, read-and-reset streams."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators.selection import group_quantile
from kestrel.plans.cache import plan_text
from kestrel.sources import inference as I
from kestrel.streaming import reset as RR


# ------------------------------------------------------------------ selection

@pytest.mark.parametrize("few", [None, 20])
@pytest.mark.parametrize("q", [0.0, 0.37, 0.5, 1.0])
def test_group_quantile_matches_numpy(spark, q, few):
    """A group with 90 % of the rows, heavy ties, extremes, a null key and few values."""
    rng = np.random.default_rng(4)
    groups = {"hot": np.concatenate((rng.lognormal(0, 9, 5000), np.full(4000, 2.5))), "ties": np.array([1.0, 1.0, 1.0, 2.0]),
              "one": np.array([7.0]), None: rng.normal(0, 1, 301), "wide": np.array([-1e300, -1.0, 0.0, 1e-300, 1e300] * 30)}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("hot", None), ("void", None), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(8)
    got = {r["k"]: r["m"] for r in group_quantile(df, ["k"], "v", q, "m", few=few).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        s = np.sort(vs)
        at = (len(s) - 1) * q
        a, b = s[int(np.floor(at))], s[int(np.ceil(at))]
        assert got[k] == pytest.approx(a + (b - a) * (at - np.floor(at)), rel=1e-12, abs=1e-300), k


def test_group_quantile_ranks_few_values(spark):
    """What is ranked at the end is narrowed to the bounds first: one pass of partial aggregates, no sort of a group."""
    df = spark.range(200_000).select(F.lit("g").alias("k"), (F.hash("id") * 1.0).alias("v"))
    out = group_quantile(df, ["k"], "v", 0.5, "m", few=100)
    plan = plan_text(out)
    assert plan.index("Window") < plan.index("(v#") and "partial_count(1)" in plan and "SortMergeJoin" not in plan
    want = sorted(r[0] for r in df.select("v").collect())
    assert out.first()["m"] == (want[99_999] + want[100_000]) / 2
    assert group_quantile(df.limit(0), ["k"], "v").collect() == []
    with pytest.raises(ValueError):
        group_quantile(df, ["k"], "v", 1.5)


# ------------------------------------------------------------------ inference

def test_infer_csv_and_rejects(spark, scratch):
    head = "id,flag,price,day,at,note,blank,`odd\n"
    good = "{0},{1},{0}.5,2024-01-0{2},2024-01-02 03:04:0{2},note {0},,x\n"
    with open(f"{scratch}/a.csv", "w") as f:
        f.write(head + "".join(good.format(i, "true" if i % 2 else "false", i % 9 + 1) for i in range(40)))
    with open(f"{scratch}/b.csv", "w") as f:
        f.write(head + "99999999999999999999,true,1e3,2024-02-30,2024-01-01T00:00:00Z,big id and no such day,,x\n"
                + "7,true,8\n" + "8,true,1,2024-01-01,2024-01-01 00:00:00,too many,,x,y,z\n" + "9,,,,,,,\n")
    kinds = {f.name: f.dataType.simpleString() for f in I.infer_csv(spark, f"{scratch}/*.csv")}
    assert kinds == {"id": "double", "flag": "boolean", "price": "double", "day": "string", "at": "timestamp", "note": "string",
                     "blank": "string", "`odd": "string"}
    schema = I.infer_csv(spark, f"{scratch}/*.csv", reject_share=0.05)
    assert [f.dataType.simpleString() for f in schema][:5] == ["bigint", "boolean", "double", "date", "timestamp"]
    split = I.read_csv_split(spark, f"{scratch}/*.csv", schema)
    assert split.typed.count() == 41 and split.typed.schema == schema
    assert split.typed.filter("id = 3").first()["day"] == dt.date(2024, 1, 4)
    bad = {r["_record"] for r in split.rejected.collect()}
    assert len(bad) == 3 and "7,true,8" in bad and any(b.startswith("99999999999999999999") for b in bad)
    assert all(r["_file"].endswith("b.csv") for r in split.rejected.select("_file").collect())


def test_narrowest():
    zero = dict.fromkeys(I.SHAPES, 0)
    assert I.narrowest(0, zero, 0.0) == "string"
    assert I.narrowest(10, zero | {"bigint": 4, "double": 6}, 0.0) == "double"
    assert I.narrowest(10, zero | {"bigint": 9, "boolean": 1}, 0.1) == "bigint"
    assert I.narrowest(10, zero | {"date": 4, "timestamp": 6}, 0.0) == "timestamp"
    assert I.narrowest(10, zero | {"date": 4, "bigint": 6}, 0.0) == "string"


# --------------------------------------------------------------- read and reset

def test_read_and_reset_two_runs(spark, scratch):
    """Closed, open and late rows of two runs add up to the input; nothing is read twice."""
    schema = "ts timestamp, k string, v double"
    hour = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)                                 # noqa: E731
    first = [(hour(h, m), k, 1.0) for h in range(5) for m in (0, 30) for k in ("a", "b")] + [(hour(1, 5), None, 2.0), (None, "a", 9.0)]
    second = [(hour(0, 10), "a", 5.0), (hour(4, 40), "a", 7.0), (hour(9), "b", None)]
    src, out = f"{scratch}/in", f"{scratch}/out"
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{src}/1")
    run = lambda: RR.run_read_and_reset(spark, f"{src}/*", spark.createDataFrame([], schema).schema, "ts", "k", "v",
                                        every_seconds=3600, lateness="1 hour", salts=2, output_path=out)
    table = lambda r: {(x["kind"], x["key"], x["period_start"].hour): (x["n"], x["total"]) for x in RR.totals(spark, r).collect()}
    got = table(run())
    assert {c[0] for c in got} == {"closed", "open"} and sum(n for n, _ in got.values()) == 21
    assert got["closed", None, 1] == (1, 2.0) and got["closed", "a", 0] == (2, 2.0) and got["open", "a", 4] == (2, 2.0)
    spark.createDataFrame(second, schema).coalesce(1).write.parquet(f"{src}/2")
    got = table(run())
    assert got["late", "a", 0] == (1, 5.0) and got["closed", "a", 0] == (2, 2.0)        # the total read before stays as it was
    assert got["closed", "a", 4] == (3, 9.0) and got["open", "b", 9] == (1, 0.0)
    assert sum(n for n, _ in got.values()) == 24
    os.rename(out + "-checkpoint", out + "-elsewhere")
    with pytest.raises(ValueError, match="checkpoint"):
        run()
