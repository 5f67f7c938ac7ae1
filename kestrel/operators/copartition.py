"""Co-partitioned tables: join on an index that both sides are stored by.

Both sides are written as catalogue tables bucketed and sorted by the key
with one bucket count, so that every later join on the key reads bucket ``i``
of the one side next to bucket ``i`` of the other: no exchange, whatever the
size.  A key that would fill more than its share of a bucket is split when
the tables are written: its rows on the side where it is frequent are dealt
over several salts, its rows on the other side are copied to each of them.  A
key has salts on both sides where it is frequent on both.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from .storage import store_file_count

_LEFT, _RIGHT = "_salt_left", "_salt_right"


@dataclass(frozen=True)
class CoPartitioned:
    """Two bucketed catalogue tables that share a key and a bucket count."""
    left: str
    right: str
    key: str
    buckets: int

    def join(self, spark: SparkSession, columns=None) -> DataFrame:
        """The inner join on the key, bucket against bucket."""
        on = [self.key, _LEFT, _RIGHT]
        left, right = spark.table(self.left), spark.table(self.right)
        return left.hint("merge").join(right, on).drop(_LEFT, _RIGHT)

    def drop(self, spark: SparkSession) -> None:
        """Take both tables out of the catalogue (their files stay)."""
        for name in (self.left, self.right):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def hot_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``(key, salts)`` of the keys that hold more than two buckets' mean
    rows; fewer than ``buckets / 2`` of them can exist."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.filter(F.col(key).isNotNull()).count()
    hot = counts.filter(F.col("n") * buckets > 2 * total)
    return hot.select(key, F.ceil(F.col("n") * buckets / F.lit(max(total, 1))).cast("int").alias("salts"))


def _salted(df: DataFrame, key: str, own_hot: DataFrame, other_hot: DataFrame, own: str, other: str) -> DataFrame:
    # both broadcasts hold fewer rows than half the bucket count
    row = F.xxhash64(*[F.col(c) for c in df.columns], F.spark_partition_id())
    out = df.withColumn("_row", row) \
        .join(F.broadcast(own_hot.withColumnRenamed("salts", "_own")), key, "left") \
        .join(F.broadcast(other_hot.withColumnRenamed("salts", "_other")), key, "left")
    copies = F.coalesce("_other", F.lit(1)).cast("bigint")
    return out.withColumn(own, F.pmod("_row", F.coalesce("_own", F.lit(1)).cast("bigint"))) \
        .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1))).drop("_row", "_own", "_other")


def write_bucketed(df: DataFrame, name: str, keys, buckets: int, path: str, mode: str = "errorifexists") -> None:
    """Save ``df`` as a catalogue table bucketed and sorted by ``keys``.  The
    rows are dealt to one task per bucket first, so a bucket is one file."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    (df.repartition(buckets, *keys).write.mode(mode).format("parquet").option("path", path)
       .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


def co_partition(left: DataFrame, right: DataFrame, key: str, buckets: int | None = None) -> CoPartitioned:
    """Write ``left`` and ``right`` for joins on ``key``.

    Rows with a NULL key match nothing and are not written.  ``buckets``
    defaults to the file count of the larger side (about 256 MB a bucket, at
    least one per task slot)."""
    spark = left.sparkSession
    buckets = buckets or 2 ** math.ceil(math.log2(max(store_file_count(left), store_file_count(right))))
    left, right = (d.filter(F.col(key).isNotNull()) for d in (left, right))
    hot_left, hot_right = hot_keys(left, key, buckets), hot_keys(right, key, buckets)
    tag = uuid.uuid4().hex[:12]
    sides = ((f"copart_{tag}_left", _salted(left, key, hot_left, hot_right, _LEFT, _RIGHT)),
             (f"copart_{tag}_right", _salted(right, key, hot_right, hot_left, _RIGHT, _LEFT)))
    for name, df in sides:
        write_bucketed(df, name, [key, _LEFT, _RIGHT], buckets, work_dir(spark, name))
    return CoPartitioned(sides[0][0], sides[1][0], key, buckets)
