"""Running totals that are read and reset on a schedule, as a keyed stateful
stream.

Every key has a running count and sum per period of event time.  When the
watermark passes the end of a period, the key's timer fires: the processor
emits the period's totals and removes them from its state (read and reset in
one step, exactly once, since state and output are committed together).  Rows
of a period that has been read already go to a side table instead of being
dropped.  What is still open when the stream stops is read from its state
store, so closed, open and late rows add up to the input.

A hot key is dealt over ``salts`` state keys, each with its own timers; the
readers add them up.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..session import parallelism, work_dir
from .counter import _event_time, _exists

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OUT = "kind string, key string, salt int, period_start bigint, n bigint, total double"
_STATE = "starts array<bigint>, ns array<bigint>, totals array<double>"
_COLUMNS = [c.split()[0] for c in _OUT.split(", ")]


class ReadAndReset(StatefulProcessor):
    """State of a key: the starts (microseconds, rising) of its open periods
    with their counts and sums, and one timer at the end of the first."""

    def __init__(self, every: int):
        self.every = every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _STATE)

    def _load(self) -> dict[int, tuple[int, float]]:
        held = self.open.get() if self.open.exists() else None
        return {s: (n, t) for s, n, t in zip(*held)} if held else {}

    def _store(self, held: dict[int, tuple[int, float]], timer: bool) -> None:
        if not held:
            self.open.clear()
            return
        starts = sorted(held)
        self.open.update((starts, [held[s][0] for s in starts], [held[s][1] for s in starts]))
        if timer:
            self.handle.registerTimer((starts[0] + self.every) // 1000)

    def _rows(self, kind, key, rows):
        name, salt = key
        return pd.DataFrame([(kind, name, salt, s, n, t) for s, (n, t) in sorted(rows.items())], columns=_COLUMNS)

    def handleInputRows(self, key, rows, timerValues):
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held, late = self._load(), {}
        first = min(held, default=None)
        for pdf in rows:
            sums = pdf.groupby(pdf["at"] // self.every * self.every)["value"].agg(["size", "sum"])
            for start, n, total in sums.itertuples():
                own = late if start + self.every <= mark else held
                n0, t0 = own.get(start, (0, 0.0))
                own[int(start)] = (n0 + int(n), t0 + float(total))
        if held:
            self._store(held, timer=first is None or min(held) < first)
        if late:
            yield self._rows("late", key, late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held = self._load()
        closed = {s: v for s, v in held.items() if s + self.every <= mark}
        if closed:                                     # read and reset
            self._store({s: v for s, v in held.items() if s not in closed}, timer=True)
            yield self._rows("closed", key, closed)

    def close(self) -> None:
        pass


@dataclass
class ResetRun:
    output_path: str
    checkpoint: str
    every_micros: int


def run_read_and_reset(spark: SparkSession, source_path: str, schema: StructType, ts: str, key: str, value: str,
                       every_seconds: int = 3600, lateness: str = "1 hour", salts: int = 1,
                       max_files_per_trigger: int | None = None, output_path: str | None = None) -> ResetRun:
    """Run the counter over a folder of Parquet files (``availableNow``: all
    that is there, then stop).  A second run into the same ``output_path``
    resumes from its checkpoint: open totals go on, nothing is read twice.

    Rows without a time count nowhere; a null key is a key; a null value adds
    to the count alone."""
    out = output_path or work_dir(spark, "reset-out")
    ckpt = out.rstrip("/") + "-checkpoint"
    if _exists(spark, f"{out}/_spark_metadata") and not _exists(spark, ckpt):
        raise ValueError(f"{out} holds a stream's output, but its checkpoint {ckpt} does not exist")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = _event_time(reader.parquet(source_path), ts).filter(F.col(ts).isNotNull()).withWatermark(ts, lateness)
    # the time goes on as a plain number: Spark then keeps rows behind the watermark, and the processor tells them apart
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in schema.names]), F.lit(salts)).cast("int") if salts > 1 else F.lit(0)
    plain = rows.select(F.col(key).cast("string").alias("key"), salt.alias("salt"), F.unix_micros(ts).alias("at"),
                        F.col(value).cast("double").alias("value"))
    every = every_seconds * 1_000_000
    done = plain.groupBy("key", "salt").transformWithStateInPandas(
        ReadAndReset(every), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")
    settings = {"spark.sql.streaming.stateStore.providerClass": _PROVIDER,
                "spark.sql.shuffle.partitions": str(parallelism(spark))}       # fixed by the checkpoint from the first run on
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        q = done.writeStream.outputMode("append").format("parquet").partitionBy("kind").option("path", out) \
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    return ResetRun(out, ckpt, every)


def _open(spark: SparkSession, run: ResetRun) -> DataFrame:
    """The totals that are still in the state store."""
    state = spark.read.format("statestore").option("path", run.checkpoint).option("stateVarName", "open").load()
    return state.select(F.lit("open").alias("kind"), F.col("key.key").alias("key"),
                        F.explode(F.arrays_zip("value.starts", "value.ns", "value.totals")).alias("v")) \
        .select("kind", "key", F.col("v.starts").alias("period_start"), F.col("v.ns").alias("n"), F.col("v.totals").alias("total"))


def totals(spark: SparkSession, run: ResetRun) -> DataFrame:
    """``(kind, key, period_start, n, total)``: ``closed`` totals as they were
    read, ``open`` ones from the state, and ``late`` rows that came after
    their period had been read."""
    out = spark.read.schema(f"{_OUT}").parquet(run.output_path) if _exists(spark, run.output_path) else spark.createDataFrame([], _OUT)
    every = out.select("kind", "key", "period_start", "n", "total").unionByName(_open(spark, run))
    return every.groupBy("kind", "key", F.timestamp_micros("period_start").alias("period_start")) \
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
