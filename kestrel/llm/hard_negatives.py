"""Hard-negative mining by Strassen products of anchor and candidate tiles.

Components go on an integer grid, ``floor(scale c)``, so that a score, the
inner product of an anchor and a candidate, is an exact integer and ties are
real.  Two searches follow, both over tiles of anchors and candidates:

1. **Positives**: per anchor the best ``positives`` other rows of its label;
   a tile holds rows of one label, so only anchors of that label meet it.
2. **Windows**: per anchor and positive the best ``negatives`` rows of other
   labels whose score lies between the two shares of the positive's score.

Candidates are dealt into blocks by their place in the table, anchors into
parts; a piece of work is one part and one block, a task multiplies it tile
by tile (``strassen``: seven half-size products per step on int64 tiles
padded with zeros to even sides, integer additions, which are exact even
where they wrap).  Every tile leaves a heap per anchor (or anchor and window)
of its best few rows; heaps merge by keeping the best of their union, first
in the task and then, by a ranked window whose limit Spark applies before the
shuffle too, over all blocks.  No pair below a heap's limit becomes a row, and
a label, id or vector that holds a third of all rows only means more blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import parallelism
from .common import drop_tables, materialize
from .vectors import entries, usable_rows

LEAF = 32                      # tiles with a side of this length are multiplied directly
BLOCK_ROWS = 16_384            # candidates of a block
PART_ROWS = 65_536             # anchors of a part
BLOCK_CELLS = 1 << 21          # entries of a block: long vectors make smaller blocks
CHUNK = 256                    # anchors multiplied at once
NORM_LIMIT = 1 << 57           # squared length from which scores might not fit their tests
_NONE = np.iinfo(np.int64).min


# ------------------------------------------------------------ exact products

def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Direct product.  Doubles hold every partial sum exactly while it is
    below 2^53; beyond that bound the product runs in int64."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), dtype=np.int64)
    most = max(abs(int(a.max())), abs(int(a.min()))) * max(abs(int(b.max())), abs(int(b.min()))) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _even(a: np.ndarray) -> np.ndarray:
    rows, cols = a.shape[0] & 1, a.shape[1] & 1
    return np.pad(a, ((0, rows), (0, cols))) if rows or cols else a


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices: exact modulo 2^64, so exact whenever the
    result fits, whatever the sums on the way."""
    m, n = a.shape[0], b.shape[1]
    if min(m, a.shape[1], n) <= leaf:
        return _leaf(a, b)
    a, b = _even(a), _even(b)
    r, c, s = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :c], a[:r, c:], a[r:, :c], a[r:, c:]
    b11, b12, b21, b22 = b[:c, :s], b[:c, s:], b[c:, :s], b[c:, s:]
    out = np.empty((2 * r, 2 * s), dtype=np.int64)
    c11, c12, c21, c22 = out[:r, :s], out[:r, s:], out[r:, :s], out[r:, s:]
    p = strassen(a11 + a22, b11 + b22, leaf)
    c11[:], c22[:] = p, p
    p = strassen(a21 + a22, b11, leaf)
    c21[:] = p
    c22 -= p
    p = strassen(a11, b12 - b22, leaf)
    c12[:] = p
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


# --------------------------------------------------------------------- heaps

def best_of(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int):
    """The heaps' merge: per owner the ``k`` best of the given entries (score
    falling, then id rising), sorted by owner."""
    order = np.lexsort((ids, -score, owner))
    owner, score, ids = owner[order], score[order], ids[order]
    first = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1)) if len(owner) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(owner)) - np.repeat(first, np.diff(np.concatenate((first, [len(owner)]))))
    return owner[place < k], score[place < k], ids[place < k]


def tile_heaps(scores: np.ndarray, ids: np.ndarray, k: int):
    """``(row, score, id)`` of the ``k`` best entries of each row of a tile;
    ``_NONE`` marks entries that take no part."""
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        hit = scores >= least[:, None]
        hit &= scores != _NONE
    else:
        hit = scores != _NONE
    row, col = np.nonzero(hit)
    return best_of(row, scores[row, col], ids[col], k)


# --------------------------------------------------------------------- spark

def on_grid(df: DataFrame, vec_id: str, embedding: str, label: str, anchor, scale: float) -> DataFrame:
    """``(place, vec_id, label, anchor, dim, q)`` of the rows that take part,
    as a written table; ``place`` numbers its rows."""
    def run(batches):
        for b in batches:
            rows, lens, starts, flat = usable_rows(b.column(3))
            with np.errstate(over="ignore"):
                q = np.floor(scale * entries(lens, starts, flat))
            widest = float(np.abs(q).max(initial=0.0))
            if not widest * widest * float(lens.max(initial=0)) < NORM_LIMIT:      # some row may be out of range: look at each
                parts = np.split(q, np.cumsum(lens)[:-1])
                near = np.array([float(np.abs(v).max(initial=0.0)) < 1 << 31 and float(np.dot(v, v)) < NORM_LIMIT for v in parts])
                q, rows, lens = q[np.repeat(near, lens)], rows[near], lens[near]
            offsets = pa.array(np.concatenate(([0], np.cumsum(lens))), pa.int32())
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays([*[b.column(i).take(at) for i in range(3)], pa.array(lens, pa.int32()),
                                              pa.ListArray.from_arrays(offsets, pa.array(q.astype(np.int32)))],
                                             names=["vec_id", "label", "anchor", "dim", "q"])

    picked = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"),
                       F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(embedding).cast("array<double>").alias("c"))
    clean = picked.filter("vec_id IS NOT NULL AND label IS NOT NULL") \
                  .mapInArrow(run, "vec_id bigint, label bigint, anchor boolean, dim int, q array<int>")
    return materialize(clean.withColumn("place", F.monotonically_increasing_id()), "grid")


def _dealt(candidates: DataFrame, anchors: DataFrame, blocks, parts, group) -> DataFrame:
    """Both sides of every piece of work, sorted for the tasks: candidates
    (``kind`` 0) before the anchors that meet them.  ``blocks`` and ``parts``
    are the numbers of blocks and parts (columns), ``group`` keys the pieces."""
    spread = F.xxhash64("place", F.lit(5))
    own = candidates.select("*", F.pmod(spread, blocks).alias("block"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
                            F.lit(0).alias("kind"))
    sent = anchors.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block"),
                          F.pmod(spread, parts).cast("int").alias("part"), F.lit(1).alias("kind"))
    key = ["dim", *group, "part", "block"]
    both = own.unionByName(sent, allowMissingColumns=True)
    return both.repartition(*key).sortWithinPartitions(*key, "kind")


def _pieces(batches, keys: list[str], chunk: int = CHUNK):
    """Walk sorted rows: yields ``(candidates, anchors)`` of a piece, the
    latter at most ``chunk`` rows at a time, as dictionaries of arrays."""
    def columns(b, s, e):
        part = b.slice(s, e - s)
        out = {n: part.column(i) for i, n in enumerate(b.schema.names)}
        m = e - s
        out |= {n: out[n].to_numpy(zero_copy_only=False) for n in ("place", "vec_id", "label")}
        out["q"] = out["q"].flatten().to_numpy().astype(np.int64).reshape(m, -1)
        return out

    key, held, tile = None, [], None
    for b in batches:
        cols = [b.column(b.schema.get_field_index(k)).to_numpy() for k in [*keys, "kind"]]
        cut = np.zeros(max(0, b.num_rows - 1), dtype=bool)
        for c in cols:
            cut |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(cut) + 1), b.num_rows]
        for s, e in zip(edges, edges[1:]):
            if s == e:
                continue
            if key != (now := tuple(c[s] for c in cols[:-1])):
                key, held, tile = now, [], None
            if cols[-1][s] == 0:
                held.append(columns(b, s, e))
                tile = None
                continue
            if not held:
                continue
            if tile is None:
                tile = {n: np.concatenate([h[n] for h in held]) for n in ("vec_id", "label", "q")}
                tile["t"] = np.ascontiguousarray(tile["q"].T)
                held = [tile]
            for c in range(s, e, chunk):
                yield tile, columns(b, c, min(e, c + chunk))


def _ranked(found: DataFrame, owner: list[str], k: int) -> DataFrame:
    """Merge the heaps of all blocks: the ``k`` best of an owner, ranked."""
    order = Window.partitionBy(*owner).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)


def mine(df: DataFrame, anchor, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
         scale: float = 256.0, positives: int = 5, negatives: int = 3, low: tuple[int, int] = (1, 2),
         high: tuple[int, int] = (19, 20)) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``: for each anchor and each of its ``positives`` best other
    rows of the same label, the ``negatives`` best rows of other labels with
    ``low * positive_score <= negative_score <= high * positive_score`` (shares
    as integer fractions).  ``anchor`` is a boolean column of ``df``.

    Scores are integer inner products of ``floor(scale c)``; higher ones come
    first, ties go to the smaller id.  Rows with a null id, label or vector, or
    with null or non-finite components, take no part, nor do vectors whose
    squared grid length is 2^57 or more (their scores might not fit a long). Rows
    meet rows of their own vector length only; empty vectors score 0.  Rows
    of the anchor's own id are not other rows; repeated rows are candidates of
    their own, and every row of a repeated anchor id is answered.  Positives
    with a negative score have no window.  Fewer rows than asked for are all
    returned; an empty table gives an empty result.  Other columns are not
    read."""
    names = ["anchor", "anchor_id", "positive_id", "positive_score", "score", "vec_id"]
    grid = on_grid(df, vec_id, embedding, label, anchor, scale)
    slots = parallelism(df.sparkSession)
    n, cells, n_anchors = grid.agg(F.count(F.lit(1)), F.coalesce(F.sum("dim"), F.lit(0)), F.count_if("anchor")).first()
    rows = ["place", "vec_id", "label", "dim", "q"]
    anchors = grid.filter("anchor").select(*rows)
    parts = max(1, math.ceil(n_anchors / PART_ROWS))
    dense = max(1, math.ceil(cells / max(1, n) / (BLOCK_CELLS / BLOCK_ROWS)))       # blocks shrink with long vectors
    wanted = max(math.ceil(n / BLOCK_ROWS * dense), min(slots, math.ceil(n / 1024)))

    def positives_of(batches):
        for tile, a in _pieces(batches, ["dim", "label", "part", "block"]):
            scores = strassen(a["q"], tile["t"])
            scores[a["vec_id"][:, None] == tile["vec_id"][None, :]] = _NONE
            row, score, ids = tile_heaps(scores, tile["vec_id"], positives)
            yield pa.RecordBatch.from_arrays([pa.array(a["place"][row]), pa.array(score), pa.array(ids)],
                                             names=["anchor", "score", "vec_id"])

    # blocks of a label: its share of all blocks; only labels that have anchors are dealt
    share = grid.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("asked"))
    share = share.filter("asked > 0").select("dim", "label", F.ceil(F.col("rows") * wanted / max(1, n)).cast("bigint").alias("blocks"),
                                             F.ceil(F.col("asked") / PART_ROWS).cast("int").alias("parts"))
    share = materialize(share, "labels")
    dealt = _dealt(grid.select(*rows).join(share, ["dim", "label"]), anchors.join(share, ["dim", "label"]),
                   F.col("blocks"), F.col("parts"), ["label"]).drop("blocks", "parts")
    found = materialize(_ranked(dealt.mapInArrow(positives_of, "anchor bigint, score bigint, vec_id bigint"), ["anchor"], positives),
                        "positives")

    wins = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(F.col("rank"), F.col("vec_id").alias("id"), "score")))
                                       .alias("wins"))                       # at most `positives` of an anchor
    asked = anchors.join(wins, anchors.place == wins.anchor).drop("anchor")

    def negatives_of(batches):
        for tile, a in _pieces(batches, ["dim", "part", "block"]):
            scores = strassen(a["q"], tile["t"])
            scores[a["label"][:, None] == tile["label"][None, :]] = _NONE
            lists = a["wins"]
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            ids, tops = (flat.field(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            out = []
            for j in range(int(sizes.max(initial=0))):
                has = np.flatnonzero(sizes > j)
                at = first[has] + j
                p, part = tops[at][:, None], scores[has]
                inside = (part != _NONE) & (low[1] * part >= low[0] * p) & (high[1] * part <= high[0] * p)
                row, score, neg = tile_heaps(np.where(inside, part, _NONE), tile["vec_id"], negatives)
                out.append((a["place"][has[row]], a["vec_id"][has[row]], ids[at][row], tops[at][row], np.full(len(row), j + 1), score, neg))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out]).astype(np.int64)) for i in range(7)],
                                                 names=["anchor", "anchor_id", "positive_id", "positive_score", "win", "score", "vec_id"])

    dealt = _dealt(grid.select(*rows), asked, F.lit(wanted).cast("bigint"), F.lit(parts), [])
    mined = dealt.mapInArrow(negatives_of, ", ".join(f"{x} bigint" for x in [*names[:4], "win", *names[4:]]))
    return _ranked(mined, ["anchor", "win", "anchor_id", "positive_id", "positive_score"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
