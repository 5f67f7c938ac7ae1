"""Tumbling-window counters, as a batch query and as a Structured Streaming
query with the same transform.

The reference reads a running total and resets it on a fixed schedule; on
event data that is a count (and sum) per tumbling window of event time.  The
stream form uses a watermark, so state for closed windows is dropped and
rows later than the watermark are discarded.  The query's progress reports
Spark's drop metric (late partial aggregates); ``late_row_report`` gives the
exact dropped rows per window by checking the emitted counts against the
source files in one batch job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import parallelism, work_dir


def tumbling_counts(df: DataFrame, ts: str, every: str = "1 hour",
                    value: str | None = None) -> DataFrame:
    """``(window_start, window_end, n[, total])`` per tumbling window."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(value).alias("total"))
    cols = ["n", "total"] if value else ["n"]
    return (df.groupBy(F.window(F.col(ts), every).alias("w")).agg(*aggs)
              .select(F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), *cols))


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    # watermarks need TIMESTAMP (with time zone); NTZ event times are cast
    # (the session time zone is UTC, so the instant is unchanged)
    if df.schema[ts].dataType.simpleString() == "timestamp_ntz":
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def streaming_tumbling_counts(stream: DataFrame, ts: str, every: str = "1 hour",
                              lateness: str = "1 hour", value: str | None = None) -> DataFrame:
    """The streaming transform: watermark + tumbling-window aggregate."""
    s = _event_time(stream, ts).withWatermark(ts, lateness)
    return tumbling_counts(s, ts, every, value)


@dataclass
class StreamRun:
    output_path: str
    checkpoint: str
    # Spark's numRowsDroppedByWatermark: late input counted after the
    # map-side partial aggregate, i.e. one per (window, task) partial
    dropped_late_partials: int
    batches: int
    # the event-time watermark when the stream stopped (UTC, naive), if any
    final_watermark: object = None


def run_tumbling_stream(spark: SparkSession, source_path: str, schema: StructType, ts: str,
                        every: str = "1 hour", lateness: str = "1 hour",
                        value: str | None = None, max_files_per_trigger: int | None = None,
                        output_path: str | None = None, checkpoint: str | None = None,
                        state_partitions: int | None = None) -> StreamRun:
    """Run the counter over a folder of Parquet files as a stream
    (``availableNow``: everything present, in micro-batches, then stop).

    Append mode writes each window once, after the watermark has passed it;
    windows still open when the stream stops are not written, they stay in
    the checkpoint.  ``checkpoint`` belongs to ``output_path`` and defaults to
    ``<output_path>-checkpoint``: a second run into the same output resumes
    from it, so files that came meanwhile are added without loss or
    duplicates (file sink + checkpoint is exactly-once).  An output folder
    of a stream whose checkpoint is missing is refused, since the file sink
    would skip the new query's batches.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    agg = streaming_tumbling_counts(reader.parquet(source_path), ts, every, lateness, value)
    out = output_path or work_dir(spark, "stream-out")
    ckpt = checkpoint or out.rstrip("/") + "-checkpoint"
    if _exists(spark, f"{out}/_spark_metadata") and not _exists(spark, ckpt):
        raise ValueError(f"{out} holds a stream's output, but its checkpoint {ckpt} does not exist")
    # the state store is split into the shuffle-partition count in force when
    # the query first starts (then fixed by its checkpoint): one per task slot
    # unless told otherwise
    parts = state_partitions or parallelism(spark)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(parts))
    try:
        q = (agg.writeStream.outputMode("append").format("parquet")
                .option("path", out).option("checkpointLocation", ckpt)
                .trigger(availableNow=True).start())
    finally:
        spark.conf.set(key, before)
    # Spark keeps the progress of the last batches only: note each batch's
    # figures while the query runs, so that totals cover all of them
    seen: dict[int, tuple[int, str | None]] = {}
    while True:
        done = q.awaitTermination(1)
        for p in q.recentProgress:
            late = sum(int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators)
            seen[p.batchId] = (late, (p.eventTime or {}).get("watermark"))
        if done:
            break
    marks = [seen[b][1] for b in sorted(seen) if seen[b][1]]
    return StreamRun(out, ckpt, sum(late for late, _ in seen.values()), len(seen),
                     _parse_instant(marks[-1] if marks else None))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _parse_instant(text):
    import datetime as dt
    if not text:
        return None
    t = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    return t.astimezone(dt.timezone.utc).replace(tzinfo=None)


def late_row_report(spark: SparkSession, run: StreamRun, source_path: str, schema: StructType,
                    ts: str, every: str = "1 hour") -> DataFrame:
    """Exact late-data report of a finished counter stream, as a batch job
    over the same source files (the ground truth).

    For every window the final watermark has closed, rows in the source
    minus rows the stream emitted are the rows dropped as late; windows that
    received only late rows were never emitted and count in full.  Returns
    ``(window_start, window_end, n_source, n_emitted, n_dropped)`` for the
    windows that lost rows.
    """
    src = _event_time(spark.read.schema(schema).parquet(source_path), ts)
    expected = tumbling_counts(src, ts, every).withColumnRenamed("n", "n_source")
    emitted = spark.read.parquet(run.output_path).select(
        "window_start", F.col("n").alias("n_emitted"))
    closed = expected
    if run.final_watermark is not None:
        closed = expected.filter(F.col("window_end") <= F.lit(run.final_watermark).cast("timestamp"))
    rep = closed.join(emitted, "window_start", "left").withColumn(
        "n_dropped", F.col("n_source") - F.coalesce(F.col("n_emitted"), F.lit(0)))
    return rep.filter(F.col("n_dropped") > 0).select(
        "window_start", "window_end", "n_source",
        F.coalesce(F.col("n_emitted"), F.lit(0)).alias("n_emitted"), "n_dropped")
