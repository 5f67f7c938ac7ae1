"""Blocked numeric arrays held as long-form tables.

An n-d array is a table ``(i0, i1, ..., value)``.  Chunks are computed
columns (``i div chunk``), so blocked reductions are ordinary two-level
aggregates: per-chunk partials, then a reduction of the partials.  Slices
are filters on index columns (pushed to the scan); axis reductions are
``groupBy`` on the remaining axes; broadcasting against a reduced array is
an equi-join on the shared axes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arith import int_floor_div, nan_to_null
from ..plans.joins import broadcast_if_small


def explode_vectors(df: DataFrame, id_col: str, vec_col: str, step: int = 1) -> DataFrame:
    """``(i, j, value)`` from an array column; with ``step > 1`` only every
    ``step``-th position is kept, selected inside the array before the
    explode so dropped cells are never materialised."""
    arr = F.col(vec_col)
    if step > 1:
        arr = F.filter(arr, lambda x, k: k % step == 0)
    return df.select(F.col(id_col).alias("i"), F.posexplode(arr).alias("pos", "v")) \
        .select("i", (F.col("pos") * step).cast("bigint").alias("j"),
                F.col("v").cast("double").alias("value"))


def cell_means(events: DataFrame, ts: str, kind: str, value: str) -> DataFrame:
    """3-D grid ``(day, hour, <kind>, value, n)``: mean value per cell."""
    return (events.groupBy(F.to_date(ts).alias("day"),
                           F.hour(ts).cast("bigint").alias("hour"), F.col(kind))
                  .agg(F.avg(value).alias("value"), F.count(F.lit(1)).alias("n")))


def with_chunk(df: DataFrame, idx: str, chunk_rows: int, name: str = "chunk") -> DataFrame:
    return df.withColumn(name, int_floor_div(idx, chunk_rows))


def chunk_summary(df: DataFrame, idx: str, chunk_rows: int) -> DataFrame:
    """``(chunk, n, lo, hi)``: the chunk layout of a 1-D array."""
    return (with_chunk(df, idx, chunk_rows).groupBy("chunk")
            .agg(F.count(F.lit(1)).alias("n"), F.min(idx).alias("lo"), F.max(idx).alias("hi")))


def blocked_sum(df: DataFrame, idx: str, value: str, chunk_rows: int) -> DataFrame:
    """Per-chunk sums plus the total (row with ``chunk`` NULL).

    The chunk sums are one aggregate (partial sums before the shuffle); the
    total is the sum of those partials, computed from the same aggregate, so
    Spark reuses its shuffle and the data is read once (a ``rollup`` would
    duplicate every input row into two grouping sets)."""
    parts = (with_chunk(df, idx, chunk_rows).groupBy("chunk")
             .agg(F.sum(value).alias("chunk_sum"), F.count(value).alias("n")))
    total = parts.agg(F.lit(None).cast("bigint").alias("chunk"),
                      F.sum("chunk_sum").alias("chunk_sum"), F.sum("n").alias("n"))
    return parts.unionByName(total)


def blocked_mean(df: DataFrame, idx: str, value: str, chunk_rows: int) -> DataFrame:
    """Mean from chunk ``(sum, count)`` partials divided once at the end
    (never a mean of means)."""
    parts = (with_chunk(df, idx, chunk_rows).groupBy("chunk")
             .agg(F.sum(value).alias("s"), F.count(value).alias("c")))
    return parts.agg(F.try_divide(F.sum("s"), F.sum("c")).alias("mean"))


def range_slice(df: DataFrame, idx: str, lo: int, hi: int) -> DataFrame:
    """``a[lo:hi]``: half-open, unlike the inclusive label slice."""
    return df.filter((F.col(idx) >= lo) & (F.col(idx) < hi))


def strided_slice(df: DataFrame, idx: str, step: int, start: int = 0,
                  new_idx: str = "new_idx") -> DataFrame:
    """``a[start::step]`` with the re-based index ``(idx - start) div step``."""
    c = F.col(idx)
    return (df.filter((c >= start) & (F.pmod(c - start, F.lit(step)) == 0))
              .withColumn(new_idx, F.expr(f"(`{idx}` - {int(start)}) div {int(step)}")))


def topk(df: DataFrame, value: str, k: int, tie: str) -> DataFrame:
    """Largest ``k`` values (ties by ``tie``): a per-partition heap plus a
    final merge of ``k`` rows per partition, never a full sort."""
    return df.orderBy(F.desc(value), F.asc(tie)).limit(k)


def nbytes(df: DataFrame, value: str, itemsize: int = 8) -> DataFrame:
    """Size in bytes of the dense array (``x.nbytes``)."""
    return df.agg((F.count(F.lit(1)) * itemsize).cast("bigint").alias("nbytes"),
                  F.count(F.lit(1)).alias("n"))


def nan_sum(df: DataFrame, value: str) -> DataFrame:
    """``nansum``: the sum with NaN skipped, and how many were skipped."""
    v = F.col(value)
    return df.agg(F.sum(nan_to_null(v)).alias("nansum"),
                  F.count(F.when(F.isnan(v), 1)).alias("n_nan"))


def axis_mean(df: DataFrame, keep: Sequence[str], value: str = "value") -> DataFrame:
    """Mean along the axes not in ``keep`` (``x.mean(axis=...)``)."""
    return df.groupBy(*keep).agg(F.avg(value).alias("mean"))


def stack(slices: Sequence[DataFrame], axis: str = "axis0") -> DataFrame:
    """Stack equal-shape arrays along a new leading axis."""
    out = None
    for i, s in enumerate(slices):
        s = s.withColumn(axis, F.lit(i).cast("bigint"))
        out = s if out is None else out.unionByName(s)
    return out


def write_slices(df: DataFrame, axis: str, path: str) -> str:
    """Write an array as one folder per slice along ``axis``
    (``path/axis=value``).  Rows are dealt by the axis; where one slice is
    large, it is spread over several tasks and files."""
    df.hint("rebalance", axis).write.partitionBy(axis).parquet(path)
    return path


def add_slice(df: DataFrame, axis: str, at, path: str) -> None:
    """Add the slice ``axis == at`` (without that column) to a stack of
    slices; refuses a slice that exists."""
    df.drop(axis).write.mode("errorifexists").parquet(f"{path.rstrip('/')}/{axis}={at}")


def stack_files(spark, paths: str | Sequence[str], axis: str = "axis0", schema=None) -> DataFrame:
    """Stack slices along ``axis``.

    ``paths`` as one folder holds a folder ``axis=value`` per slice: the axis
    is a partition column found from the folder names, so a filter on it opens
    only the matching folders; ``schema`` (with the axis) saves reading a
    footer and fixes the axis type.  A list of paths holds one slice each: the
    axis value is the position in the list, and every slice is its own scan
    with its own literal, so names need not be distinct."""
    if isinstance(paths, str):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.option("basePath", paths).parquet(paths)
    return stack([spark.read.parquet(p) for p in paths], axis)


def anomaly(grid: DataFrame, axis: str, dims: Sequence[str], value: str = "value",
            at=None) -> DataFrame:
    """``grid[at] - grid.mean(axis)``: the slice at ``axis == at`` (default:
    the first axis value) minus the mean over ``axis``, aligned on ``dims``
    (inner: cells missing from the slice are dropped).

    One aggregate per cell gives its mean over ``axis``, its first axis
    value and the value there (``min_by``); the default slice is then a join
    with the one-row global minimum of those first values, so the grid is
    reduced once and no slice is read twice.
    """
    cells = grid.groupBy(*dims).agg(F.avg(value).alias("_mean"),
                                    F.min(axis).alias("_first"),
                                    F.min_by(F.col(value), F.col(axis)).alias("_v0"))
    if at is None:
        first = cells.agg(F.min("_first").alias("_first"))      # one row: broadcast is safe
        sl = cells.join(F.broadcast(first), "_first")
        return sl.select(*dims, (F.col("_v0") - F.col("_mean")).alias("anomaly"))
    means = cells.select(*dims, "_mean")
    slice_at = grid.filter(F.col(axis) == F.lit(at)).select(*dims, F.col(value).alias("_v"))
    return (slice_at.join(broadcast_if_small(means), list(dims))
                    .select(*dims, (F.col("_v") - F.col("_mean")).alias("anomaly")))
