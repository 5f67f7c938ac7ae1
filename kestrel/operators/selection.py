"""Exact order statistics of groups of any size, by distributed selection.

No group is sorted.  Per group the wanted ranks are enclosed by two values:
a mergeable quantile sketch of the rows between the present bounds names
tighter ones, and an exact count of the rows below and between them (partial
aggregates, so a group that holds most of the rows is work for all tasks)
proves that the ranks lie inside.  A round narrows a group to a few
hundredths of its rows; values that many rows share become bounds themselves.
When few values are left strictly between the bounds of every group, those are
counted per value and ranked.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.cache import written
from ..plans.joins import broadcast_if_small

GRID = 256                 # quantiles asked of a sketch
ACCURACY = 10_000          # of the sketch: rank error below 1 / ACCURACY
FEW = 10_000               # rows strictly between the bounds of a group that are ranked at once
ROUNDS = 40


def _same(keys: Sequence[str]):
    return functools.reduce(lambda a, b: a & b, [F.col(f"_g{i}").eqNullSafe(F.col(f"_k{i}")) for i, _ in enumerate(keys)], F.lit(True))


def group_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float = 0.5, out: str = "quantile",
                   few: int | None = None) -> DataFrame:
    """``(keys..., out)``: the exact ``q`` quantile of ``value`` per group,
    linear between the two nearest ranks (``q = 0.5`` is the median).

    Null and NaN values do not count; a null key is a group; groups without
    values are left out.  Ties are exact."""
    if not 0 <= q <= 1:
        raise ValueError("a quantile lies between 0 and 1")
    few = FEW if few is None else few
    own, new = [f"_g{i}" for i in range(len(keys))], [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(g) for k, g in zip(keys, own)], F.col(value).cast("double").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    at = (F.col("n") - 1) * F.lit(float(q))
    state = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    state = state.select(*[F.col(g).alias(k) for g, k in zip(own, new)], F.floor(at).alias("r1"), F.ceil(at).alias("r2"),
                         (at - F.floor(at)).alias("part"), "lo", "hi", F.col("n").alias("inside"), F.lit(0).cast("bigint").alias("below"),
                         F.col("n").alias("between"))
    state = written(state, "selection")

    def bounded(state):
        return rows.join(broadcast_if_small(state), _same(keys)).filter("v >= lo AND v <= hi")

    for _ in range(ROUNDS):
        most = state.agg(F.max("between")).first()[0]
        if most is None or most <= few:
            break
        grid = F.expr(f"percentile_approx(v, array({','.join(repr(i / GRID) for i in range(GRID + 1))}), {ACCURACY})")
        sketch = bounded(state).groupBy(*new).agg(grid.alias("grid")) \
            .select(*[F.col(k).alias(g) for k, g in zip(new, own)], "grid")
        place = lambda rank, step, shift: F.greatest(F.lit(1), F.least(F.lit(GRID + 1), (                # noqa: E731
            step((F.col(rank) - F.col("below")) * GRID / F.col("inside")) + shift).cast("int")))
        tight = state.join(sketch, _same(keys)).select(
            "*", F.element_at("grid", place("r1", F.floor, 0)).alias("lo2"), F.element_at("grid", place("r2", F.ceil, 2)).alias("hi2"))
        tight = written(tight.drop("grid", *own), "selection")
        counts = bounded(tight).groupBy(*new).agg(
            F.count_if(F.col("v") < F.col("lo2")).alias("less"), F.count_if((F.col("v") >= F.col("lo2")) & (F.col("v") <= F.col("hi2"))).alias("held"),
            F.count_if((F.col("v") > F.col("lo2")) & (F.col("v") < F.col("hi2"))).alias("within")) \
            .select(*[F.col(k).alias(g) for k, g in zip(new, own)], "less", "held", "within")
        proven = (F.col("r1") - F.col("below") >= F.col("less")) & (F.col("r2") - F.col("below") < F.col("less") + F.col("held"))
        pick = lambda new_value, old: F.when(proven, new_value).otherwise(F.col(old))                    # noqa: E731
        state = tight.join(counts, _same(keys)).select(
            *new, "r1", "r2", "part", pick(F.col("lo2"), "lo").alias("lo"), pick(F.col("hi2"), "hi").alias("hi"),
            pick(F.col("held"), "inside").alias("inside"), pick(F.col("below") + F.col("less"), "below").alias("below"),
            pick(F.col("within"), "between").alias("between"))
        state = written(state, "selection")

    values = bounded(state).groupBy(*new, "r1", "r2", "part", "below", "v").agg(F.count(F.lit(1)).alias("c"))
    order = Window.partitionBy(*new).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = values.withColumn("upto", F.col("below") + F.sum("c").over(order))
    holds = lambda rank: F.max(F.when((F.col(rank) < F.col("upto")) & (F.col(rank) >= F.col("upto") - F.col("c")), F.col("v")))
    picked = ranked.groupBy(*new).agg(holds("r1").alias("a"), holds("r2").alias("b"), F.first("part").alias("part"))
    return picked.select(*[F.col(k).alias(name) for k, name in zip(new, keys)],
                         (F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias(out))
