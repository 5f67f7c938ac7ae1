"""Embedding near-dedup by collision-counting projections.

Vectors of one label link when their cosine is at least ``threshold``.  All
work is on unit vectors, where that bounds the distance of a linked pair by
``r = sqrt(2 - 2 threshold)``, so that the difference of the two along a
random Gaussian direction is normal with deviation at most ``r``.

1. **Copies.**  Equal vectors of a label become one row with a count.
2. **Cells.**  While a label's vectors fit a cell, the label is one cell.
   Beyond ``cell_rows`` the label is cut by ``k`` projections into intervals
   of a few ``r``, ``k`` growing with the logarithm of its count, in as many
   differently projected tables as make the chance that a pair at exactly the
   threshold shares no cell at most ``miss``.  A cell is split into blocks of
   at most ``block_rows`` vectors, and every pair of blocks of a cell is one
   piece of work for one task: no pair of vectors ever becomes a row, and a
   cell of any size is spread over many tasks.
3. **Collision counting** inside a piece: along each of ``m`` projections the
   one side is sorted, and every vector of the other opens a window of
   ``1.5 r`` around its own place; a pair's count is the number of windows it
   collides in.  The required count is the binomial quantile that a pair at
   the threshold misses with probability ``miss``; after the first third of
   the projections pairs are dropped by the quantile for that many.
4. **Verification** of the pairs that reach the count, by their cosine in
   double precision.  A piece returns, per vector, the number of its links
   and one edge to the smallest vector it is connected to in the piece.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import connected_components

PROJECTIONS = 48
FIRST = 16
WINDOW = 1.5                    # window half-width, in units of r
CELL_WIDTH = 8.0                # interval width of a cell, in units of r


def binomial_quantile(n: int, p: float, miss: float) -> int:
    """Largest ``c`` with ``P(Binomial(n, p) < c) <= miss``."""
    total, c = 0.0, 0
    while c < n:
        total += math.comb(n, c) * p ** c * (1 - p) ** (n - c)
        if total > miss:
            break
        c += 1
    return c


def window_probability(half_width: float) -> float:
    """Chance that a normal of deviation 1 lies within ``half_width``."""
    return math.erf(half_width / math.sqrt(2))


def table_plan(count: int, cell_rows: int, miss: float) -> tuple[int, int]:
    """``(k, tables)`` for a label of ``count`` distinct vectors: each
    interval cut about halves a cell; a pair at the threshold stays within an
    interval of ``CELL_WIDTH`` deviations with chance ``1 - E|z| / width``."""
    k = max(0, math.ceil(math.log2(max(1.0, count / cell_rows))))
    if k == 0:
        return 0, 1
    together = (1 - math.sqrt(2 / math.pi) / CELL_WIDTH) ** k
    return k, math.ceil(math.log(miss) / math.log(1 - together))


def _clean(vec) -> np.ndarray | None:
    """Unit vector in double precision, or None for a vector that takes no
    part (null, empty, zero, null or non-finite components)."""
    if vec is None or len(vec) == 0 or any(x is None for x in vec):
        return None
    v = np.asarray(vec, dtype=np.float64)
    if not np.isfinite(v).all():
        return None
    big = np.abs(v).max()
    if big == 0:
        return None
    v = v / big                         # no overflow or underflow in the norm
    return v / np.sqrt(v @ v)


def unit_vectors(df: DataFrame) -> DataFrame:
    """``(vec_id, label, unit)`` from ``(vec_id, label, embedding)``; ``unit``
    is null for rows that take no part."""
    def run(batches):
        for b in batches:
            units = [None if lab is None else _clean(v)
                     for lab, v in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(units, pa.list_(pa.float64()))],
                                             names=["vec_id", "label", "unit"])
    return df.mapInArrow(run, "vec_id bigint, label bigint, unit array<double>")


def _cells(unit: np.ndarray, k: int, tables: int, r: float, seed: int) -> list[str]:
    """The cell of a vector in every table, as text."""
    out = []
    for t in range(tables):
        if k == 0:
            out.append("0")
            continue
        rng = np.random.default_rng([seed, 1, t])
        g = rng.standard_normal((k, len(unit)))
        shift = rng.random(k)
        out.append(f"{t}:" + ",".join(str(int(c)) for c in np.floor(g @ unit / (CELL_WIDTH * r) + shift)))
    return out


def count_links(a: np.ndarray, b: np.ndarray, threshold: float, seed: int, miss: float,
                same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs ``(i, j)`` of rows of ``a`` and ``b`` with cosine of at
    least ``threshold``, found by collision counting; with ``same`` (``b`` is
    ``a``) only ``i < j``."""
    r = math.sqrt(max(0.0, 2 - 2 * threshold))
    g = np.random.default_rng([seed, 2]).standard_normal((a.shape[1], PROJECTIONS))
    pa_, pb = a @ g, b @ g
    w = WINDOW * r
    p = window_probability(WINDOW)
    count = np.zeros((len(a), len(b)), dtype=np.uint8)
    for j in range(FIRST):
        order = np.argsort(pb[:, j], kind="stable")
        line = pb[order, j]
        lo = np.searchsorted(line, pa_[:, j] - w, side="left")
        hi = np.searchsorted(line, pa_[:, j] + w, side="right")
        for i in range(len(a)):
            count[i, order[lo[i]:hi[i]]] += 1
    i, j = np.nonzero(count >= binomial_quantile(FIRST, p, miss / 2))
    if same:
        i, j = i[i < j], j[i < j]
    hits = count[i, j].astype(np.int16)
    for c in range(FIRST, PROJECTIONS):
        hits += np.abs(pa_[i, c] - pb[j, c]) <= w
    ok = hits >= binomial_quantile(PROJECTIONS, p, miss / 2)
    i, j = i[ok], j[ok]
    keep = np.zeros(len(i), dtype=bool)
    for s in range(0, len(i), 1 << 16):     # bounded copies of the rows
        e = slice(s, s + (1 << 16))
        keep[e] = np.einsum("ij,ij->i", a[i[e]], b[j[e]]) >= threshold
    return i[keep], j[keep]


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    threshold: float = 0.93, seed: int = 17, miss: float = 1e-3,
                    cell_rows: int = 16384, block_rows: int = 2048) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``df``.

    Vectors link within a label when their cosine is at least ``threshold``
    (``n_links`` counts the other rows linked directly, copies included;
    ``component_id`` is the smallest id reachable).  Rows with a null label,
    and null, empty or zero vectors or such with null or non-finite
    components, link with nothing; vectors of different lengths are never
    linked.  Repeated rows are rows of their own and link with each other; a
    null id never names a component and is never kept.  Other columns are not
    read."""
    ids = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"),
                    F.col(embedding).alias("embedding"))
    # equal vectors of a label are one node with a count
    rows = unit_vectors(ids).select(
        "vec_id", "label", F.size("unit").alias("dim"), "unit",
        F.when(F.col("unit").isNotNull(), F.xxhash64("label", "unit")).alias("node"))
    rows = materialize(rows, "units")
    nodes = rows.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"),
        F.first("dim").alias("dim"), F.first("unit").alias("unit"))
    nodes = materialize(nodes, "nodes")
    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("count"))
    found = materialize(_pieces(nodes.join(sizes, ["label", "dim"]), threshold, seed, miss, cell_rows, block_rows), "found")
    comp = connected_components(found.select("node", "edge"), "node", "edge")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_node = (nodes.select("node", "low", "copies").join(links, "node", "left").join(comp, "node", "left")
                     .withColumn("component", F.coalesce("component", "node")))
    roots = per_node.groupBy("component").agg(F.min("low").alias("root"))
    per_node = per_node.join(roots, "component").select(
        "node", "root", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"))
    out = rows.select("vec_id", "node").join(per_node, "node", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("root")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _pieces(nodes: DataFrame, threshold: float, seed: int, miss: float, cell_rows: int, block_rows: int) -> DataFrame:
    """``(node, links, edge)`` of every piece of work: links with other nodes
    (weighted by their copies) and the smallest node connected to it there."""
    r = math.sqrt(max(0.0, 2 - 2 * threshold))

    def cells(batches):
        for b in batches:
            k_t = [table_plan(c, cell_rows, miss / 2) for c in b.column("count").to_pylist()]
            cells = [_cells(np.asarray(u), k, t, r, seed) for u, (k, t) in zip(b.column("unit").to_pylist(), k_t)]
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("copies"), b.column("unit"), b.column("label"), b.column("dim"),
                 pa.array(cells, pa.list_(pa.string()))],
                names=["node", "copies", "unit", "label", "dim", "cells"])

    spread = nodes.select("node", "copies", "unit", "label", "dim", "count").mapInArrow(
        cells, "node bigint, copies bigint, unit array<double>, label bigint, dim int, cells array<string>")
    rows = spread.select("node", "copies", "unit", "cells", F.posexplode("cells").alias("table", "cell"), "label", "dim") \
                 .withColumn("key", F.xxhash64("label", "dim", "cell"))
    full = rows.groupBy("key").agg(F.count(F.lit(1)).alias("in_cell")).filter("in_cell > 1")
    rows = rows.join(full, "key")
    # blocks of a cell, and every pair of blocks; a block goes to each pair it is in
    rows = rows.withColumn("blocks", F.ceil(F.col("in_cell") / block_rows).cast("int")) \
               .withColumn("block", F.pmod(F.xxhash64("node", F.lit(seed)), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    work = rows.select("key", "node", "copies", "unit", "cells", "table", "block", other.alias("o")) \
               .withColumn("x", F.least("block", "o")).withColumn("y", F.greatest("block", "o")) \
               .withColumn("cells", F.transform("cells", lambda c: F.xxhash64(c))).drop("o")

    def run(group: pa.Table) -> pa.Table:
        x, y = group["x"][0].as_py(), group["y"][0].as_py()
        t = group["table"][0].as_py()
        block = group["block"].to_numpy()
        node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
        unit = np.stack([np.asarray(u) for u in group["unit"].to_numpy()])
        cell = np.stack([np.asarray(c) for c in group["cells"].to_numpy()])[:, :t]
        ia = np.flatnonzero(block == x)
        ib = ia if x == y else np.flatnonzero(block == y)
        if not len(ia) or not len(ib):
            i = j = np.empty(0, dtype=np.int64)
        else:
            i, j = count_links(unit[ia], unit[ib], threshold, seed, miss, x == y)
            i, j = ia[i], ib[j]
        if t and len(i):                    # counted in the first table the two share
            fresh = ~(cell[i] == cell[j]).any(axis=1)
            i, j = i[fresh], j[fresh]
        links = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
        low = node.copy()
        if len(i):
            by_j = np.argsort(j, kind="stable")
            si, sj = np.flatnonzero(np.diff(i, prepend=-1)), np.flatnonzero(np.diff(j[by_j], prepend=-1))
            while True:                     # smallest node over links, until it settles
                before = low.copy()
                low[i[si]] = np.minimum(low[i[si]], np.minimum.reduceat(low[j], si))
                low[j[by_j][sj]] = np.minimum(low[j[by_j][sj]], np.minimum.reduceat(low[i[by_j]], sj))
                if (before == low).all():
                    break
        some = links > 0
        return pa.table({"node": node[some], "links": links[some].astype(np.int64), "edge": low[some]},
                        schema=pa.schema([("node", pa.int64()), ("links", pa.int64()), ("edge", pa.int64())]))

    return work.groupBy("key", "x", "y").applyInArrow(run, "node bigint, links bigint, edge bigint")
