"""Materialisation helpers: persist for reuse, cut lineage safely, show plans.

``persisted`` keeps a frame in executor memory (spilling to disk) for the
queries inside a ``with`` block and releases it afterwards.  A lost executor
only loses cached blocks, which Spark recomputes from lineage.  For long
lineages ``cut_lineage`` writes a reliable checkpoint to the shared folder
named by ``spark.checkpoint.dir`` (never ``localCheckpoint``, whose blocks die
with their executor).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir, work_dir


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """``with persisted(df) as d: ...`` - cached inside, released after."""
    d = df.persist(level)
    try:
        yield d
    finally:
        d.unpersist()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint under the session's shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text (``explain`` without printing), for
    inspection and plan assertions in tests."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared work folder, read back: the
    lineage is cut and a lost executor costs nothing that was written."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
