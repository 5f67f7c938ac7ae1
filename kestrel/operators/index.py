"""An index with kept divisions: rows stored in key order, in parts whose
bounds are known, so that look-ups open only the parts they need.

1. Every key gets a number that keeps its order (numbers and times as they
   are, strings by the six bytes after the prefix that all keys share).
2. A mergeable quantile sketch of these numbers proposes several candidate
   cuts per part; an exact count of the rows between the candidates (one
   aggregate, at most as many groups as candidates) chooses the cuts nearest
   to equal parts.  Nothing is sorted for this, and the driver sees one row
   per candidate, a number set by the caller.
3. Rows go to their part and are sorted there.  A value that holds more than
   a part's share of the rows spans several parts and is dealt over them by
   row hash.  A part is one folder.
4. The exact lowest and highest key and count of every part are stored beside
   the data as the divisions table.  ``loc`` reads that table, then only the
   folders whose bounds meet the asked range.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CANDIDATES = 8             # proposed cuts per part
PART = "_part"


def _code(df: DataFrame, key: str) -> Column:
    """The order-keeping number of a key (equal for strings that agree in the
    bytes looked at)."""
    kind = df.schema[key].dataType.simpleString()
    c = F.col(key)
    if kind == "string":
        ends = df.agg(F.min(key), F.max(key)).first()
        shared = os.path.commonprefix([s.encode() for s in ends]) if ends[0] is not None else b""
        rest = F.rpad(F.hex(F.substring(c.cast("binary"), len(shared) + 1, 6)), 12, "0")
        return F.conv(rest, 16, 10).cast("double")          # 48 bits: exact
    if kind.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(c).cast("double")
    return c.cast("double")


def cuts(coded: DataFrame, partitions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the column ``code``: candidate cuts (rising), and per range
    between them its first part and the number of parts it spans."""
    points = CANDIDATES * partitions
    grid = ",".join(repr(i / points) for i in range(1, points))
    sketch = coded.agg(F.expr(f"percentile_approx(code, array({grid}), {max(10_000, 4 * points)})")).first()[0] if points > 1 else None
    found = np.unique(np.array(sketch or [], dtype=np.float64))

    @F.pandas_udf("int")
    def range_of(code: pd.Series) -> pd.Series:
        # ranges alternate: below a cut, exactly on it, ...: a value of many rows is a range of its own
        return pd.Series(np.searchsorted(found, code, side="left") + np.searchsorted(found, code, side="right"), dtype="int32")

    counts = np.zeros(2 * len(found) + 1, dtype=np.int64)
    for r in coded.filter("code IS NOT NULL").groupBy(range_of("code").alias("at")).count().collect():      # at most 2 * points rows
        counts[r["at"]] = r["count"]
    upto = np.cumsum(counts)
    size = max(1.0, upto[-1] / partitions)
    # a range belongs to the part its middle row falls into; one that holds more than a part spans what it fills
    start = upto - counts
    first = np.minimum(partitions - 1, ((start + np.minimum(counts, size) / 2) // size)).astype(np.int64)
    last = np.minimum(partitions - 1, ((upto - np.minimum(counts, size) / 2) // size)).astype(np.int64)
    first = np.maximum.accumulate(first)
    return found, first, np.maximum(1, last - first + 1)


def write_index(df: DataFrame, key: str, path: str, partitions: int) -> str:
    """Store ``df`` under ``path`` in ``partitions`` parts by ``key``
    (``set_index``); rows with a null key make a part of their own (-1)."""
    coded = df.withColumn("code", _code(df, key))
    found, first, span = cuts(coded.select("code"), partitions)

    @F.pandas_udf("int")
    def part_of(code: pd.Series, row: pd.Series) -> pd.Series:
        at = np.searchsorted(found, code, side="left") + np.searchsorted(found, code, side="right")
        part = first[at] + np.mod(row, span[at])
        return pd.Series(np.where(code.isna(), -1, part), dtype="int32")

    row = F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id())
    placed = coded.withColumn(PART, part_of("code", row)).drop("code")
    # partition 0 takes the null keys: part p is written by task p + 1 alone
    placed.repartitionById(partitions + 1, F.col(PART) + 1).sortWithinPartitions(key).write.partitionBy(PART).parquet(path)
    stored = df.sparkSession.read.schema(placed.schema).parquet(path)
    bounds = stored.groupBy(PART).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n"))
    bounds.write.parquet(f"{path.rstrip('/')}/_divisions")
    placed.limit(0).write.parquet(f"{path.rstrip('/')}/_schema")          # an index without rows has no folder to tell it
    return path


def _stored(spark: SparkSession, path: str) -> DataFrame:
    schema = spark.read.parquet(f"{path.rstrip('/')}/_schema").schema
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def divisions(spark: SparkSession, path: str) -> DataFrame:
    """``(_part, lo, hi, n)`` of a stored index."""
    return spark.read.parquet(f"{path.rstrip('/')}/_divisions")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a stored index, without the part column."""
    return _stored(spark, path).drop(PART)


def loc(spark: SparkSession, path: str, key: str, lo, hi=None) -> DataFrame:
    """Rows with ``lo <= key <= hi`` (``key == lo`` without ``hi``).  The
    divisions name the parts; only their folders are opened."""
    hi = lo if hi is None else hi
    meets = divisions(spark, path).filter((F.col("lo") <= F.lit(hi)) & (F.col("hi") >= F.lit(lo)))
    parts = [r[PART] for r in meets.select(PART).collect()]              # at most one row per part
    rows = _stored(spark, path)
    return rows.filter(F.col(PART).isin(parts) & F.col(key).between(F.lit(lo), F.lit(hi))).drop(PART)
