"""Catalogue: the tumbling-window counter, as a batch query and as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arith import round_half_away
from ..sources.tables import table
from ..session import work_dir
from ..streaming.counter import run_tumbling_stream, tumbling_counts
from ..streaming.reset import run_read_and_reset, totals
from .registry import query


@query("tumbling_counter", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total
FROM events GROUP BY 1, 2""", ids="ST-1, AG-25")
def tumbling_counter(spark, sf):
    c = tumbling_counts(table(spark, sf, "events"), "ts", "1 hour", "value")
    return c.select("window_start", "window_end", "n", round_half_away("total", 4).alias("total"))


# Append mode writes a window once the watermark (latest event time minus the
# allowed lateness) has passed its end; with the whole folder in one
# micro-batch nothing is late, so the emitted windows are exactly those that
# end at or before max(ts) - 1 hour.
@query("tumbling_counter_stream", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total
FROM events GROUP BY 1, 2
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
       ids="ST-1")
def tumbling_counter_stream(spark, sf):
    ev = table(spark, sf, "events")
    src = work_dir(spark, "events-landing")
    ev.write.parquet(src)                      # files landing in a folder: the stream source
    run = run_tumbling_stream(spark, src, ev.schema, "ts", every="1 hour", lateness="1 hour",
                              value="value")
    out = spark.read.parquet(run.output_path)
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                      "n", round_half_away("total", 4).alias("total"))


# Everything lies in one micro-batch, so nothing is late: a period is closed
# when it ends at or before the watermark, max(ts) - 1 hour in whole
# milliseconds; the others are still open, and reported too.
@query("read_and_reset_stream", """
SELECT event_type, date_trunc('hour', ts) AS window_start,
       CASE WHEN date_trunc('hour', ts) + INTERVAL 1 HOUR <= date_trunc('milliseconds', (SELECT max(ts) FROM events)) - INTERVAL 1 HOUR
            THEN 'closed' ELSE 'open' END AS kind,
       CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total
FROM events GROUP BY 1, 2""", ids="ST-1")
def read_and_reset_stream(spark, sf):
    ev = table(spark, sf, "events")
    src = work_dir(spark, "events-landing")
    ev.write.parquet(src)
    run = run_read_and_reset(spark, src, ev.schema, "ts", "event_type", "value", salts=2)
    return totals(spark, run).select(F.col("key").alias("event_type"), F.col("period_start").cast("timestamp_ntz").alias("window_start"),
                                     "kind", "n", round_half_away("total", 4).alias("total"))
