"""Connected components of an edge table.

Alternating large-star and small-star steps: every node points to the
smallest node it can see, first over its larger neighbours, then over its
smaller ones, until nothing changes (a number of rounds logarithmic in the
longest path).  Each step is one aggregate and one join; no neighbourhood is
ever collected, and nothing but one checksum per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a > b, both bigint)."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = both.filter(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = (edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .unionByName(low.select("a", F.col("m").alias("b"))))
    return out.filter(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """``(node, component)`` for every node that occurs in an edge; the
    component is its smallest node.  Null ends and self-loops are ignored;
    repeated edges count once; no edges give an empty table."""
    s, d = F.col(src).cast("bigint"), F.col(dst).cast("bigint")
    cur = materialize(edges.select(F.greatest(s, d).alias("a"), F.least(s, d).alias("b"))
                           .filter(s.isNotNull() & d.isNotNull() & (s != d)).distinct(), "cc")
    sign = (F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))))
    seen = tuple(cur.agg(*sign).first())
    while seen[0]:
        nxt = materialize(_star(_star(cur, True), False), "cc")
        now = tuple(nxt.agg(*sign).first())
        drop_tables(cur)
        cur = nxt
        if now == seen:
            break
        seen = now
    # at the fixed point every node points straight at its root
    return (cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
               .unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
