"""Join helpers: broadcast only behind a size check.

``broadcast_if_small`` reads Catalyst's size estimate of the optimised plan
of the small side (file sizes for scans, propagated through filters and
projections) and adds the broadcast hint only when it is under the bound;
beyond it the join is left to the planner (sort-merge join, AQE may still
switch to broadcast at run time from real shuffle sizes, and splits skewed
partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (no job is run); ``None`` when the
    session does not expose the plan (then nothing is hinted)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when its estimated size is at most ``max_bytes``,
    else ``df`` unchanged."""
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join where ``small`` is broadcast only if it is proven small."""
    return big.join(broadcast_if_small(small, max_bytes), on, how)

