"""File and generated sources: multi-file CSV / JSON / text, keyed stores,
in-memory sequences, and random normal arrays.

Readers take a glob or a list of paths (local, HDFS or object-store URIs
such as ``s3a://bucket/prefix/*.csv`` are passed straight to Spark) and a
declared schema, so no inference pass reads the data twice.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str,
             header: bool = True) -> DataFrame:
    """Multi-file CSV with a header line and a declared schema.

    CSV cannot prune columns at the file level (every line is parsed), so
    convert hot CSV inputs to Parquet once (``storage.write_parquet``).
    """
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE") \
        .csv(paths if isinstance(paths, str) else list(paths))


def read_text(spark: SparkSession, paths: str | Sequence[str], min_partitions: int | None = None
              ) -> DataFrame:
    """Lines of text files; ``.gz`` is decompressed but not splittable, so a
    few large gzip files are spread over ``min_partitions`` after the scan."""
    df = spark.read.text(paths if isinstance(paths, str) else list(paths))
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def from_sequence(spark: SparkSession, values: Sequence, col: str = "value",
                  dtype: str = "long") -> DataFrame:
    """A small in-memory sequence (``from_sequence``); for integer ranges use
    ``spark.range``, which is generated on the executors."""
    return spark.createDataFrame([(v,) for v in values], f"{col} {dtype}")


def integer_range(spark: SparkSession, bounds: DataFrame, col: str = "value") -> DataFrame:
    """All integers ``lo <= x < hi`` of a one-row table ``(lo, hi)``,
    generated on the executors (``from_sequence(range(lo, hi))``)."""
    lo, hi = bounds.first()
    return spark.range(lo or 0, hi or 0).withColumnRenamed("id", col)


# The modulus 2^31 - 1 and two multipliers of the
# multiplicative congruential generators (Park and Miller; L'Ecuyer).
_M31, _STEP_A, _STEP_B = 2147483647, 48271, 69621


def _uniform(cell: Column, seed: int, stream: int) -> Column:
    """A number in (0, 1) from a cell index: four multiply-and-xor rounds of
    31-bit integers, all below 2^63, so any engine computes the same."""
    x = F.pmod(cell + F.lit((seed * 2 + stream) * 1_000_003 % _M31), F.lit(_M31)).cast("bigint")
    for k, a in enumerate((_STEP_A, _STEP_B, _STEP_A, _STEP_B)):
        x = F.pmod(x * a + F.lit(12345 + k + 7919 * stream), F.lit(_M31))
        x = x.bitwiseXOR(F.shiftright(x, 13 - 2 * k))
    return (x + 1).cast("double") / F.lit(float(1 << 31) + 1.0)


def normal_at(cell: Column, seed: int, mean: float = 0.0, std: float = 1.0) -> Column:
    """A normal(mean, std) value that depends on the cell index and the seed
    alone (a counter-based generator with the Box-Muller transform): the same
    under any partitioning, order or retry."""
    radius = F.sqrt(F.lit(-2.0) * F.log(_uniform(cell, seed, 0)))
    return F.lit(mean) + F.lit(std) * radius * F.cos(F.lit(2 * math.pi) * _uniform(cell, seed, 1))


def random_normal(spark: SparkSession, shape: Sequence[int], mean: float = 0.0,
                  std: float = 1.0, seed: int | None = None,
                  partitions: int | None = None) -> DataFrame:
    """A dense array of normal(mean, std) values in long form
    ``(i0, i1, ..., value)``, generated on the executors from ``spark.range``.

    The values follow the distribution but are not NumPy's stream (tests
    check moments), and depend on the partitioning; ``normal_at`` gives values
    that depend on the cell alone.  Indices come from the cell number, so any
    filter on them runs before ``randn`` is evaluated.
    """
    total = 1
    for n in shape:
        total *= int(n)
    cells = spark.range(0, total, numPartitions=partitions) if partitions else spark.range(0, total)
    idx = []
    stride = total
    for d, n in enumerate(shape):
        stride //= int(n)
        idx.append(F.pmod(F.expr(f"id div {stride}"), F.lit(int(n))).alias(f"i{d}"))
    gen = F.randn(seed) if seed is not None else F.randn()
    return cells.select(*idx, (gen * std + mean).alias("value"))
