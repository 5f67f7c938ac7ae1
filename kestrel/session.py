"""Session factory and shared-folder helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames (or a session) in and returns lazy DataFrames.  This module
only offers a convenient builder for tests, the bench and notebooks, and the
one place that decides where intermediate tables go (``work_dir``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "kestrel",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session with the settings every query here assumes.

    On a cluster the same keys belong in ``spark-defaults.conf``; shuffle
    partitions there should be sized to the data (about 128-256 MB per
    partition after compression), and AQE coalesces the small ones.
    """
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or cpus
    b = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
        # checkpoint files are removed once no DataFrame refers to them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _fallback_dir(spark: SparkSession, local: bool) -> str:
    """Where to work when ``spark.checkpoint.dir`` is unset: a fresh scratch
    folder for local runs (tests).  A cluster must name a shared folder."""
    if local:
        return tempfile.mkdtemp(prefix="kestrel-ckpt-")
    raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster whoever runs it sets that key to a shared file system
    (HDFS, S3A, ...).  Only when nothing is set do we choose one ourselves
    (``_fallback_dir``).
    """
    try:
        sc = spark.sparkContext
    except Exception:                     # Spark Connect: the server owns the setting
        return spark.conf.get(CHECKPOINT_KEY, None) or _fallback_dir(spark, local=False)
    d = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_KEY, None) \
        or sc.getConf().get(CHECKPOINT_KEY, None)
    if not d:
        d = _fallback_dir(spark, local=sc.master.startswith("local"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/kestrel-{name}-{uuid.uuid4().hex[:12]}"


def parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (default parallelism), or the shuffle
    partition count when the session does not expose its context."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
