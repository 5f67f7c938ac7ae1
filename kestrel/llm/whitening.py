"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries are put on an integer grid, ``x = floor(scale c) + shift``, so that
copies are equal and sums are exact.  The model is fitted on every distinct
grid vector once.  Its covariance ``V`` is never built: all that is asked of
the data is a product ``V Q = (1/n) sum (x - S/n) ((x - S/n)' Q)`` with a block
``Q`` of ``2 k + 8`` columns (``BlockProduct``), one pass over the fit list in
which a task sends one block of ``d x (2 k + 8)`` numbers, whatever its rows.

1. A short Lanczos run gives a lower end of the spectrum of ``V``.
2. Rayleigh-Ritz on ``Q``: eigenvalues of ``Q' V Q`` and rotated columns.
3. The pairs are certified when every residual ``|V q - e q|`` of the first
   ``k`` is at most ``TOLERANCE`` of the largest eigenvalue, or when it no
   longer falls and is at most ``FLOOR`` (rounding of the sums).
4. Otherwise a Chebyshev polynomial in ``V``, evaluated by its three-term
   recurrence with one pass per degree, damps the interval from the lower end
   to the smallest Ritz value of the block (or a little below the ``k``-th,
   where the block's values tie) and lifts what lies above; QR makes
   the columns orthonormal again, and 2 follows.

The driver holds blocks of ``d x (2 k + 8)`` numbers and ``d`` exact sums;
nothing there grows with the rows.  The fit list and the grid vectors are
tables in the shared folder, so a lost executor costs a task, not a pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .vectors import entries, usable_rows

TOLERANCE = 2e-15              # certified residual, relative to the largest eigenvalue
FLOOR = 1e-12                  # a residual that stalls must be below this
RANK = 1e-12                   # eigenvalues below this share of the largest one are zero
GAP = 0.1                      # share of the wanted end that the damped interval leaves free
DEGREE = 10                    # of the Chebyshev filter
ROUNDS = 60
LIFT = 1e10                    # largest ratio by which a filter may stretch the block
LANCZOS_STEPS = 6
GRID_LIMIT = float(1 << 60)    # grid values are held to this range

_LOW = np.int64((1 << 32) - 1)


@dataclass
class Whitener:
    """Exact sums of the fit list and the certified eigenpairs of its covariance."""
    n: int
    sums: list[int]
    vectors: np.ndarray        # d x components, unit columns
    values: np.ndarray         # falling
    trace: float
    residual: float            # largest |V q - e q|, relative to the largest eigenvalue
    identity_error: float
    passes: int

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], dtype=np.int64) if self.n else np.empty(0, dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.sums])


def on_grid(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = 64.0,
            shift: int = 1_000_000) -> DataFrame:
    """``(vec_id, x)``: ``x = floor(scale c) + shift`` as longs, written as a table.

    Rows whose vector is null or holds null or non-finite entries are left
    out; repeated rows and null ids are kept.  A covariance needs vectors of
    one length: those of the most frequent length (of equally frequent ones
    the longest) remain.  ``scale c`` is held to +-2^60.  Other columns are
    not read."""
    def run(batches):
        for b in batches:
            rows, lens, starts, flat = usable_rows(b.column(1))
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(scale * entries(lens, starts, flat)), -GRID_LIMIT, GRID_LIMIT).astype(np.int64) + shift
            offsets = pa.array(np.concatenate(([0], np.cumsum(lens))), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.ListArray.from_arrays(offsets, pa.array(x))],
                                             names=["vec_id", "x"])

    picked = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("c"))
    grid = materialize(picked.mapInArrow(run, "vec_id bigint, x array<bigint>"), "grid")
    common = grid.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return grid.filter(F.size("x") == (common["d"] if common else 0))


def _sum_blocks(fit_list: DataFrame, block, size: int) -> np.ndarray:
    """Sum over tasks of the ``size`` numbers that ``block`` (an object with
    ``add(rows)`` and ``total``) has after its task's rows."""
    def run(batches):
        part = block()
        for b in batches:
            if b.num_rows:
                part.add(b.column(0).flatten().to_numpy().reshape(b.num_rows, -1))
        total = part.total
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total.ravel())], names=["at", "value"])

    rows = fit_list.select("x").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(size)
    got = rows.toPandas()
    out[got["at"].to_numpy()] = got["value"].to_numpy()
    return out


class BlockProduct:
    """One task's share of ``sum (x - mean) ((x - mean)' Q)``."""

    def __init__(self, base, rest, q):
        self.base, self.rest, self.q, self.total = base, rest, q, None

    def add(self, x):
        centred = (x - self.base) - self.rest
        part = centred.T @ (centred @ self.q)
        self.total = part if self.total is None else self.total + part


class WhitenedMoments:
    """One task's sums of the whitened values, of their products and of the squared centred entries."""

    def __init__(self, base, rest, axes):
        self.base, self.rest, self.axes, self.total = base, rest, axes, None

    def add(self, x):
        centred = (x - self.base) - self.rest
        w = centred @ self.axes
        part = np.concatenate(((w.T @ w).ravel(), w.sum(axis=0), [np.einsum("ij,ij->", centred, centred)]))
        self.total = part if self.total is None else self.total + part


def _exact_sums(fit_list: DataFrame) -> tuple[int, list[int]]:
    """The number of rows and the sum of every dimension, exact: each entry is
    added as two halves of 32 bits."""
    def run(batches):
        n, high, low = 0, None, None
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1)
                h, lo = (x >> np.int64(32)).sum(axis=0), (x & _LOW).sum(axis=0)
                high, low = (h, lo) if high is None else (high + h, low + lo)
                n += b.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(high)), pa.int32()), pa.array(high), pa.array(low),
                                              pa.array(np.full(len(high), n))], names=["dim", "high", "low", "n"])

    parts = fit_list.select("x").mapInArrow(run, "dim int, high bigint, low bigint, n bigint")
    total = parts.groupBy("dim").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]).collect()
    rows = sorted((r["dim"], (int(r["high"]) << 32) + int(r["low"]), int(r["n"])) for r in total)
    return (rows[0][2] if rows else 0), [s for _, s, _ in rows]


def _lower_end(product, d: int, rng) -> float:
    """A lower estimate of the smallest eigenvalue from a few Lanczos steps:
    the smallest Ritz value less the last residual, and not below zero."""
    v = rng.standard_normal(d)
    basis, alpha, beta = [v / np.linalg.norm(v)], [], []
    for _ in range(min(LANCZOS_STEPS, d)):
        w = product(basis[-1][:, None])[:, 0]
        alpha.append(float(w @ basis[-1]))
        for _ in range(2):                        # full orthogonalisation, twice
            for u in basis:
                w = w - (w @ u) * u
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(alpha):
            break
        basis.append(w / beta[-1])
    m = len(alpha)
    ritz = np.linalg.eigvalsh(np.diag(alpha) + np.diag(beta[:m - 1], 1) + np.diag(beta[:m - 1], -1))
    return max(0.0, float(ritz[0]) - beta[-1])


def chebyshev_filter(product, q, vq, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """``p(V) q`` for the Chebyshev polynomial of ``degree`` that stays small
    on ``[low, high]`` and is 1 at ``top``; ``vq`` is ``V q``, so a call costs
    ``degree - 1`` products."""
    half, centre = (high - low) / 2, (high + low) / 2
    first = half / (top - centre)
    sigma, before, now = first, q, (vq - centre * q) * (first / half)
    for _ in range(degree - 1):
        following = 1.0 / (2.0 / first - sigma)
        before, now = now, (product(now) - centre * now) * (2 * following / half) - (sigma * following) * before
        sigma = following
    return now


def eigenpairs(product, d: int, k: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest eigenvalues (falling), their unit vectors and the
    certified relative residual of the operator behind ``product``."""
    rng = np.random.default_rng([seed, d])
    block = min(d, 2 * k + 8)
    q = np.eye(d) if block == d else np.linalg.qr(rng.standard_normal((d, block)))[0]
    low = _lower_end(product, d, rng) if block < d else 0.0
    last = math.inf
    for _ in range(ROUNDS):
        vq = product(q)
        h = q.T @ vq
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = float(values[0])
        if top <= 0.0:
            return np.zeros(0), q[:, :0], 0.0
        residual = float(np.linalg.norm(vq[:, :k] - q[:, :k] * values[:k], axis=0).max(initial=0.0)) / top
        if residual <= TOLERANCE or residual <= FLOOR and residual > 0.5 * last:
            break
        last = residual
        start, wanted = low, float(values[min(k, block) - 1])
        high = min(float(values[-1]), wanted - GAP * (wanted - start))     # below the wanted ones, even where all of the block tie
        if high <= start:
            start, high = 0.0, min(float(values[-1]), (1 - GAP) * wanted)
        reach = max(1 + 1e-9, (top - (high + start) / 2) / max((high - start) / 2, 1e-300))
        degree = max(1, min(DEGREE, int(math.log(2 * LIFT) / math.acosh(reach)))) if high > 0 else 1
        q = np.linalg.qr(chebyshev_filter(product, q, vq, start, high, top, degree) if high > 1e-14 * top else vq)[0]
    else:
        raise ArithmeticError(f"no certified eigenpairs after {ROUNDS} rounds (residual {residual:.1e})")
    keep = min(k, int((values > RANK * top).sum()))
    q = q[:, :keep]
    return values[:keep], q * np.where(q[np.abs(q).argmax(axis=0), np.arange(keep)] < 0, -1.0, 1.0), residual


def fit(grid: DataFrame, components: int = 16) -> Whitener:
    """Fit on the distinct ``x`` of ``grid`` (from ``on_grid``).  Components
    of zero variance are left out: a table without rows, or with one distinct
    vector, gives a model without components."""
    fit_list = materialize(grid.select("x").distinct(), "fitlist")
    n, sums = _exact_sums(fit_list)
    model = Whitener(n, sums, np.zeros((len(sums), 0)), np.zeros(0), 0.0, 0.0, 0.0, 0)
    if not n or not sums:
        return model
    d, base, rest = len(sums), model.base, model.rest

    def product(q):
        model.passes += 1
        return _sum_blocks(fit_list, lambda: BlockProduct(base, rest, q), d * q.shape[1]).reshape(d, -1) / n

    model.values, model.vectors, model.residual = eigenpairs(product, d, components)
    k = len(model.values)
    axes = model.vectors / np.sqrt(model.values)
    total = _sum_blocks(fit_list, lambda: WhitenedMoments(base, rest, axes), k * k + k + 1)
    mean = total[k * k:k * k + k] / n
    cov = total[:k * k].reshape(k, k) / n - np.outer(mean, mean)
    model.trace = float(total[-1]) / n
    model.identity_error = float(np.abs(cov - np.eye(k)).max(initial=0.0))
    return model


def _deviations(x: np.ndarray, model: Whitener) -> list:
    """``sum (n x - S)^2`` per row, exact; null beyond 38 digits."""
    near = x - model.base
    far = int(np.abs(near).max(initial=0)) + 1
    if x.shape[1] * (model.n * far) ** 2 < 1 << 62:
        d = model.n * near - np.array([s % model.n for s in model.sums], dtype=np.int64)
        return [Decimal(v) for v in np.einsum("ij,ij->i", d, d).tolist()]
    d = model.n * x.astype(object) - np.array(model.sums, dtype=object)
    return [Decimal(v) if v < 10 ** 38 else None for v in (d * d).sum(axis=1).tolist()]


def whiten(grid: DataFrame, model: Whitener) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained,
    identity_error)`` for every row of ``grid`` and component of ``model``:
    ``deviation`` is the exact ``sum (n x - S)^2``, ``whitened`` the row's
    centred vector along the component over the root of its eigenvalue."""
    k = len(model.values)
    axes = model.vectors / np.sqrt(model.values) if k else model.vectors
    share = model.values / model.trace if k else model.values
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        for b in batches:
            m = b.num_rows
            if not m or not k:
                continue
            x = b.column(1).flatten().to_numpy().reshape(m, -1)
            w = ((x - model.base) - model.rest) @ axes
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, model.n)),
                 pa.array(_deviations(x, model), pa.decimal128(38, 0)).take(each), pa.array(w.ravel()),
                 pa.array(np.tile(share, m)), pa.array(np.full(m * k, model.identity_error))], names=names)

    return grid.select("vec_id", "x").mapInArrow(run, "vec_id bigint, component int, n bigint, deviation decimal(38,0), "
                                                      "whitened double, explained double, identity_error double")
