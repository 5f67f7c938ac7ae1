"""Storage layout: Parquet/ORC writes with options, keyed directories,
sorted stores for fast look-up, re-indexing with divisions, categorising.

Writes go under the shared folder of the session (``spark.checkpoint.dir``),
never a machine-local temporary folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from ..plans.ranking import global_row_number, ntile_column


def write_parquet(df: DataFrame, path: str, compression: str = "zstd",
                  mode: str = "errorifexists", partition_by=None) -> str:
    """Write Parquet with a codec; nullability comes from the schema."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_keyed(df: DataFrame, root: str, key: str, fmt: str = "orc",
                mode: str = "errorifexists") -> str:
    """One directory per dataset key (the keyed binary store): ``root/key``."""
    path = f"{root.rstrip('/')}/{key.strip('/')}"
    df.write.mode(mode).format(fmt).save(path)
    return path


def read_keyed(spark: SparkSession, root: str, key: str, fmt: str = "orc") -> DataFrame:
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{key.strip('/')}")


def set_index(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Re-index: range-partition on ``key`` and sort inside partitions, so
    partitions are ordered (``set_index``).  A hash of the row and its input
    partition, both fixed on a retry, is the last range key: a hot value spans
    several neighbouring partitions, which then share it as a boundary; other
    values lie in one partition each unless a boundary falls on them."""
    tie = F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id())
    return (df.withColumn("_index_tie", tie).repartitionByRange(partitions, key, "_index_tie")
              .sortWithinPartitions(key).drop("_index_tie"))


def divisions(indexed: DataFrame, key: str) -> DataFrame:
    """``(partition, lo, hi, n)`` per partition of a re-indexed frame (the
    division boundaries are the ``lo`` values plus the last ``hi``)."""
    return (indexed.groupBy(F.spark_partition_id().alias("partition"))
                   .agg(F.min(key).alias("lo"), F.max(key).alias("hi"),
                        F.count(F.lit(1)).alias("n")))


def exact_divisions(df: DataFrame, key: str, k: int) -> DataFrame:
    """``(tile, lo, hi, n)``: ``k`` equal-count divisions (``ntile``) with
    exact boundaries, computed without a single-partition window.  The row's
    hash is ranked after the key, so a hot value is sorted by many tasks."""
    tied = df.select(key, F.xxhash64(*[F.col(c) for c in df.columns]).alias("_row"))
    ranked = global_row_number(tied, [key, "_row"], "rn")
    total = ranked.count()
    return (ranked.withColumn("tile", ntile_column("rn", total, k)).groupBy("tile")
                  .agg(F.min(key).alias("lo"), F.max(key).alias("hi"),
                       F.count(F.lit(1)).alias("n")))


TARGET_FILE_BYTES = 256 * 1024 * 1024


def store_file_count(df: DataFrame, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Files for a sorted store: about ``target_bytes`` each by Catalyst's
    size estimate, and at least one per task slot."""
    from ..plans.joins import estimated_bytes
    from ..session import parallelism
    est = estimated_bytes(df)
    known = est is not None and 0 < est < 2 ** 60      # Long.MaxValue means "unknown"
    by_size = -(-est // target_bytes) if known else 0
    return max(parallelism(df.sparkSession), int(by_size))


def write_sorted_store(df: DataFrame, key: str, path: str, files: int | None = None,
                       row_group_rows: int | None = None) -> str:
    """Archive sorted and range-partitioned by ``key``: each file and row
    group covers a narrow key range, so Parquet min/max statistics let a
    point or range look-up skip almost everything.  ``files`` defaults to
    ``store_file_count`` (grows with the data)."""
    w = set_index(df, key, files or store_file_count(df)).write.mode("errorifexists")
    if row_group_rows:
        w = w.option("parquet.block.row.count.limit", str(row_group_rows))
    w.parquet(path)
    return path


def lookup(spark: SparkSession, path: str, key: str, value) -> DataFrame:
    """All rows with ``key == value`` from a sorted store."""
    return spark.read.parquet(path).filter(F.col(key) == F.lit(value))


def categorize(df: DataFrame, col: str, code: str | None = None):
    """Replace strings by integer codes: returns ``(coded_df, dictionary)``.

    Codes are 0-based positions in ascending value order (NULL -> -1).  The
    dictionary is built by a distributed global rank over the distinct
    values and joined back (broadcast only when proven small).
    """
    code = code or f"{col}_code"
    values = df.select(col).filter(F.col(col).isNotNull()).distinct()
    dictionary = global_row_number(values, [col], "_rn").select(
        col, (F.col("_rn") - 1).alias(code))
    coded = df.join(broadcast_if_small(dictionary), col, "left") \
        .withColumn(code, F.coalesce(F.col(code), F.lit(-1).cast("bigint")))
    return coded, dictionary
