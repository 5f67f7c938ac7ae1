"""Pairs of points within a radius, by an equi-join on grid cells.

Points get the cell of a grid whose cells are as wide as the radius.  Two
points within the radius lie in the same or in neighbouring cells, so one side
of the join keeps its own cell, the other is sent to the cells before it (half
of the neighbours, so that every unordered pair meets once), and both are
joined on the cell.  The distance mask is a plain filter behind the join.

A cell with many points is salted: the staying side is dealt over the cell's
salts, the visiting side is copied to each, so no task gets a whole hot cell.
The number of tasks is the shuffle's, whatever the number of cells.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_ROWS = 2048                 # points of a cell per salt


def half_neighbourhood(dims: int) -> list[tuple[int, ...]]:
    """The own cell and one of every two opposite neighbours."""
    zero = (0,) * dims
    return [o for o in itertools.product((-1, 0, 1), repeat=dims) if o >= zero]


def pairs_within(points: DataFrame, point_id: str, coords: Sequence[str], radius: float, above: float = 0.0,
                 cell_rows: int | None = None) -> DataFrame:
    """``(a, b, r2)`` of every unordered pair of points, ``a < b``, whose
    squared distance ``r2`` is over ``above`` squared-distance units (or equal
    to 0 where ``above`` is 0) and at most ``radius`` squared.

    Points with a null id or a null or non-finite coordinate pair with
    nothing; rows of one id do not pair with each other."""
    if not radius > 0:
        raise ValueError("the radius must be positive")
    at = [f"_x{d}" for d in range(len(coords))]
    cells = [f"_c{d}" for d in range(len(coords))]
    own = points.select(F.col(point_id).alias("_id"), *[F.col(c).cast("double").alias(x) for c, x in zip(coords, at)])
    finite = [F.abs(x) < F.lit(float("inf")) for x in at]
    own = own.filter(functools.reduce(lambda p, q: p & q, finite, F.col("_id").isNotNull()))
    own = own.select("*", *[F.floor(F.col(x) / radius).cast("bigint").alias(c) for x, c in zip(at, cells)])

    full = cell_rows or CELL_ROWS
    hot = own.groupBy(*cells).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > full) \
             .select(*cells, F.ceil(F.col("_n") / full).alias("_salts"))
    salts = F.coalesce("_salts", F.lit(1).cast("bigint"))
    stay = own.join(hot, cells, "left").select("*", F.pmod(F.xxhash64("_id", *at), salts).alias("_salt")).drop("_salts")

    offsets = F.array(*[F.struct(*[F.lit(v).cast("bigint").alias(c) for v, c in zip(o, cells)]) for o in half_neighbourhood(len(cells))])
    sent = own.select("_id", *at, *[F.col(c).alias(f"_o{c}") for c in cells], F.explode(offsets).alias("_off"))
    sent = sent.select(F.col("_id").alias("_to"), *[F.col(x).alias(f"_t{x}") for x in at],
                       *[(F.col(f"_o{c}") + F.col(f"_off.{c}")).alias(c) for c in cells],
                       functools.reduce(lambda p, q: p & q, [F.col(f"_off.{c}") == 0 for c in cells]).alias("_same"))
    visit = sent.join(hot, cells, "left").select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("_salt")).drop("_salts")

    r2 = functools.reduce(lambda p, q: p + q, [(F.col(x) - F.col(f"_t{x}")) * (F.col(x) - F.col(f"_t{x}")) for x in at])
    near = stay.join(visit, [*cells, "_salt"]).select("_id", "_to", "_same", r2.alias("r2"))
    mask = (F.col("r2") <= radius * radius) & (F.col("_id") != F.col("_to")) & (~F.col("_same") | (F.col("_id") < F.col("_to")))
    if above > 0:
        mask = mask & (F.col("r2") > above)
    return near.filter(mask).select(F.least("_id", "_to").alias("a"), F.greatest("_id", "_to").alias("b"), "r2")


def near_stats(points: DataFrame, point_id: str, coords: Sequence[str], radius: float) -> DataFrame:
    """Per id ``(id, n_near, nearest_r2, sum_r2)``: the other points within
    the radius, the squared distance to the nearest and the sum of all (a
    row sum of the masked distance matrix); ids without neighbours have 0 and
    nulls."""
    pairs = pairs_within(points, point_id, coords, radius)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"), "r2")
    own = points.select(F.col(point_id).alias("id"), F.lit(None).cast("double").alias("r2"))
    return ends.unionByName(own).groupBy("id").agg(F.count("r2").alias("n_near"), F.min("r2").alias("nearest_r2"),
                                                   F.sum("r2").alias("sum_r2"))
