"""Catalogue: pairs within a radius.  The points are the ``embeddings`` in
three dimensions, the sums of their first, middle and last components."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arith import round_half_away
from ..operators import neighbours as N
from ..sources.tables import table
from .registry import query

RADIUS = 0.15
# Fixed value: pairs with squared distance at or below this do not count.
CUTOFF = 1e-6

_POINTS = """p AS (
  SELECT vec_id, list_sum(list_transform(embedding[1:21], lambda v: CAST(v AS DOUBLE))) AS x,
         list_sum(list_transform(embedding[22:42], lambda v: CAST(v AS DOUBLE))) AS y,
         list_sum(list_transform(embedding[43:], lambda v: CAST(v AS DOUBLE))) AS z FROM embeddings),
d AS (
  SELECT a.vec_id AS a, b.vec_id AS b, (a.x - b.x) ^ 2 + (a.y - b.y) ^ 2 + (a.z - b.z) ^ 2 AS r2
  FROM p a JOIN p b ON a.vec_id < b.vec_id)"""


def _points(spark, sf):
    v = F.col("embedding").cast("array<double>")
    part = lambda lo, n: F.aggregate(F.slice(v, lo, n), F.lit(0.0), lambda s, e: s + e)       # noqa: E731
    return table(spark, sf, "embeddings").select("vec_id", part(1, 21).alias("x"), part(22, 21).alias("y"),
                                                 part(43, 1 << 20).alias("z"))


@query("neighbours_within", f"""
WITH {_POINTS},
u AS (SELECT a AS id, r2 FROM d WHERE r2 <= {RADIUS} * {RADIUS} UNION ALL SELECT b, r2 FROM d WHERE r2 <= {RADIUS} * {RADIUS}
      UNION ALL SELECT vec_id, NULL FROM p)
SELECT id, CAST(count(r2) AS BIGINT) AS n_near, round(min(r2), 6) AS nearest_r2, round(sum(r2), 6) AS sum_r2
FROM u GROUP BY id""", ids="JN-3, AG-23")
def neighbours_within(spark, sf):
    s = N.near_stats(_points(spark, sf), "vec_id", ["x", "y", "z"], RADIUS)
    return s.select("id", "n_near", round_half_away("nearest_r2", 6).alias("nearest_r2"), round_half_away("sum_r2", 6).alias("sum_r2"))


@query("close_pairs", f"""
WITH {_POINTS}
SELECT a, b, round(r2, 6) AS r2 FROM d WHERE r2 > {CUTOFF} AND r2 <= {RADIUS} * {RADIUS}""", ids="JN-3, PRJ-8")
def close_pairs(spark, sf):
    p = N.pairs_within(_points(spark, sf), "vec_id", ["x", "y", "z"], RADIUS, above=CUTOFF)
    return p.select("a", "b", round_half_away("r2", 6).alias("r2"))
