"""Catalogue: blocked arrays - ``vector`` (events), ``matrix`` (embeddings),
``cube`` (events by day, hour, type)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arith import round_half_away
from ..operators import grid as GR
from ..session import work_dir
from ..sources.files import normal_at
from ..sources.tables import cube, table, vector
from .registry import query

# Parameters: chunk length, slice bounds, stride, top-k size.
CHUNK = 1000
SLICE_LO, SLICE_HI = 2000, 3000
STRIDE = 100
AXIS_STRIDE = 4
TOPK = 10
NORMAL_SEED = 1981

_CUBE = """cube AS (SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) AS BIGINT) AS hour, event_type,
                avg(value) AS value, CAST(count(*) AS BIGINT) AS n
         FROM events GROUP BY 1, 2, 3)"""
_MATRIX = """matrix AS (SELECT vec_id AS i, CAST(unnest(generate_series(0, len(embedding) - 1)) AS BIGINT) AS j,
                 CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings)"""


@query("array_chunks", f"""
SELECT CAST(event_id // {CHUNK} AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS n,
       min(event_id) AS lo, max(event_id) AS hi
FROM events GROUP BY 1""", ids="SRC-7")
def array_chunks(spark, sf):
    return GR.chunk_summary(vector(spark, sf), "idx", CHUNK)


@query("blocked_sum", f"""
SELECT CAST(event_id // {CHUNK} AS BIGINT) AS chunk, round(sum(value), 4) AS chunk_sum,
       CAST(count(value) AS BIGINT) AS n
FROM events GROUP BY ROLLUP (event_id // {CHUNK})""", ids="AG-20")
def blocked_sum(spark, sf):
    return GR.blocked_sum(vector(spark, sf), "idx", "value", CHUNK) \
        .select("chunk", round_half_away("chunk_sum", 4).alias("chunk_sum"), "n")


@query("blocked_mean", f"""
SELECT round(sum(s) / sum(c), 6) AS mean FROM (
  SELECT sum(value) AS s, count(value) AS c FROM events GROUP BY event_id // {CHUNK}) t""",
       ids="AG-21")
def blocked_mean(spark, sf):
    return GR.blocked_mean(vector(spark, sf), "idx", "value", CHUNK) \
        .select(round_half_away("mean", 6).alias("mean"))


@query("range_slice", f"""
SELECT event_id AS idx, value FROM events WHERE event_id >= {SLICE_LO} AND event_id < {SLICE_HI}""",
       ids="GR-3")
def range_slice(spark, sf):
    return GR.range_slice(vector(spark, sf), "idx", SLICE_LO, SLICE_HI)


@query("strided_slice", f"""
SELECT event_id AS idx, value, CAST(event_id // {STRIDE} AS BIGINT) AS new_idx
FROM events WHERE event_id % {STRIDE} = 0""", ids="GR-2")
def strided_slice(spark, sf):
    return GR.strided_slice(vector(spark, sf), "idx", STRIDE)


@query("array_topk", f"""
SELECT event_id AS idx, value FROM events ORDER BY value DESC, event_id LIMIT {TOPK}""",
       ids="SL-4")
def array_topk(spark, sf):
    return GR.topk(vector(spark, sf), "value", TOPK, "idx")


@query("array_nbytes", """
SELECT CAST(count(*) * 8 AS BIGINT) AS nbytes, CAST(count(*) AS BIGINT) AS n FROM events""",
       ids="AG-29")
def array_nbytes(spark, sf):
    return GR.nbytes(vector(spark, sf), "value")


# NaN is injected for one event type so that the NaN-skipping sum has
# something to skip.
@query("nan_sum", """
SELECT round(sum(CASE WHEN isnan(v) THEN NULL ELSE v END), 4) AS nansum,
       CAST(count(*) FILTER (WHERE isnan(v)) AS BIGINT) AS n_nan
FROM (SELECT CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE ELSE value END AS v FROM events) t""",
       ids="AG-24")
def nan_sum(spark, sf):
    v = table(spark, sf, "events").select(
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
         .otherwise(F.col("value")).alias("value"))
    return GR.nan_sum(v, "value").select(round_half_away("nansum", 4).alias("nansum"), "n_nan")


@query("axis_mean", f"""
WITH {_MATRIX} SELECT j, round(avg(value), 6) AS mean FROM matrix GROUP BY j""", ids="AG-22")
def axis_mean(spark, sf):
    m = GR.explode_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return GR.axis_mean(m, ["j"]).select("j", round_half_away("mean", 6).alias("mean"))


@query("axis_mean_strided", f"""
WITH {_MATRIX} SELECT j, round(avg(value), 6) AS mean FROM matrix
WHERE j % {AXIS_STRIDE} = 0 GROUP BY j""", ids="GR-4, AG-22, GR-2")
def axis_mean_strided(spark, sf):
    m = GR.explode_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding", step=AXIS_STRIDE)
    return GR.axis_mean(m, ["j"]).select("j", round_half_away("mean", 6).alias("mean"))


def _stacked_days(spark, sf):
    slices = cube(spark, sf).select("day", "hour", "event_type", round_half_away("value", 6).alias("value"), "n")
    path = GR.write_slices(slices, "day", work_dir(spark, "slices"))
    return GR.stack_files(spark, path, "day", slices.schema)


@query("grid_stack", f"""
WITH {_CUBE} SELECT day, hour, event_type, round(value, 6) AS value, n FROM cube""", ids="GR-1")
def grid_stack(spark, sf):
    return _stacked_days(spark, sf).select("day", "hour", "event_type", "value", "n")


# one slice of the stack: only its folder is opened
@query("grid_stack_slice", f"""
WITH {_CUBE} SELECT hour, event_type, round(value, 6) AS value, n FROM cube
WHERE day = (SELECT min(day) FROM cube)""", ids="GR-1, GR-3")
def grid_stack_slice(spark, sf):
    stacked = _stacked_days(spark, sf)
    first = stacked.agg(F.min("day")).first()[0]
    return stacked.filter(F.col("day") == F.lit(first)).select("hour", "event_type", "value", "n")


def _uniform_sql(stream: int) -> str:
    x = f"((event_id + {(NORMAL_SEED * 2 + stream) * 1_000_003 % 2147483647}) % 2147483647)"
    for k, a in enumerate((48271, 69621, 48271, 69621)):
        x = f"(({x} * {a} + {12345 + k + 7919 * stream}) % 2147483647)"
        x = f"xor({x}, {x} >> {13 - 2 * k})"
    return f"(({x} + 1) / (2147483648.0::DOUBLE + 1))"


# The cells are the events' indices; mean and chunk sums of the generated
# array would hide a wrong cell, so every value is returned.
@query("random_normal_cells", f"""
SELECT event_id AS idx, round(10 + 0.1 * sqrt(-2 * ln({_uniform_sql(0)})) * cos(2 * pi() * {_uniform_sql(1)}), 6) AS value
FROM events""", ids="SRC-8")
def random_normal_cells(spark, sf):
    cells = vector(spark, sf).select("idx")
    return cells.select("idx", round_half_away(normal_at(F.col("idx"), NORMAL_SEED, 10.0, 0.1), 6).alias("value"))


@query("grid_anomaly", f"""
WITH {_CUBE},
m AS (SELECT hour, event_type, avg(value) AS mean_value FROM cube GROUP BY 1, 2),
s AS (SELECT * FROM cube WHERE day = (SELECT min(day) FROM cube))
SELECT s.hour, s.event_type, round(s.value - m.mean_value, 6) AS anomaly
FROM s JOIN m ON s.hour = m.hour AND s.event_type = m.event_type""", ids="JN-6")
def grid_anomaly(spark, sf):
    a = GR.anomaly(cube(spark, sf), "day", ["hour", "event_type"])
    return a.select("hour", "event_type", round_half_away("anomaly", 6).alias("anomaly"))
