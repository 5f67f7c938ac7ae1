"""Global positions without a single-partition window.

``row_number() OVER (ORDER BY k)`` with no ``PARTITION BY`` moves every row
to one task.  Here the rows are range-partitioned and sorted instead; the
sorted table is pinned with a reliable checkpoint (so the sampled range
bounds and the partition contents cannot change between the two passes),
each partition's row count gives its offset - a table with one row per
partition, so its size is bounded by the partition count and it can be
broadcast - and a row's position is its offset plus its place in the
partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def global_row_number(df: DataFrame, order: Sequence[str], name: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name``: 1-based position in the total order ``order``.

    Rows tied on ``order`` are ordered by a hash of the whole row, which is
    deterministic across runs and retries; make ``order`` unique when tied
    rows must come in a particular order."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # a row hash as last sort key: rows equal on ``order`` (a hot value) can
    # then span several range partitions instead of landing in one task
    keyed = df.withColumn("__rank_tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    cols = [*order, "__rank_tie"]
    ranged = keyed.repartitionByRange(partitions, *cols) if partitions else keyed.repartitionByRange(*cols)
    srt = ranged.sortWithinPartitions(*cols).checkpoint(eager=True).drop("__rank_tie")
    pos = (srt.withColumn("__rank_pid", F.spark_partition_id())
              .withColumn("__rank_pos", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)))
    counts = pos.groupBy("__rank_pid").agg(F.count(F.lit(1)).alias("__rank_c"))
    w = Window.orderBy("__rank_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__rank_pid", F.coalesce(F.sum("__rank_c").over(w), F.lit(0)).alias("__rank_off"))
    # one row per partition: bounded by the partition count, safe to broadcast
    return (pos.join(F.broadcast(offsets), "__rank_pid")
               .withColumn(name, F.col("__rank_off") + F.col("__rank_pos") + 1)
               .drop("__rank_pid", "__rank_pos", "__rank_off"))


def positions_in_groups(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``df`` plus ``name``: 1-based position within ``group`` (NULL is a
    group) in ``order``; the global rank less the group's lowest rank."""
    from .joins import broadcast_if_small
    ranked = global_row_number(df, [group, *order], "__rank_rn")
    first = ranked.groupBy(F.col(group).alias("__rank_group")).agg(F.min("__rank_rn").alias("__rank_first"))
    return (ranked.join(broadcast_if_small(first), F.col(group).eqNullSafe(F.col("__rank_group")))
                  .withColumn(name, F.col("__rank_rn") - F.col("__rank_first") + 1)
                  .drop("__rank_rn", "__rank_group", "__rank_first"))


def ntile_column(rn: str, total: int, k: int):
    """SQL ``ntile(k)`` from a 1-based position and the row total: the first
    ``total % k`` tiles get one extra row."""
    base, rem = divmod(total, k)
    r0 = F.col(rn) - 1
    big = rem * (base + 1)
    if base == 0:
        return (r0 + 1).cast("int")
    return F.when(r0 < big, F.floor(r0 / (base + 1)) + 1) \
        .otherwise(F.lit(rem) + F.floor((r0 - big) / base) + 1).cast("int")
