"""Zipped floor-division totals and bad-row quarantine.

``quarantine`` tags every row with the first failing check in one pass; good
rows feed the aggregate and bad rows go to a side table.  Writing both from
the tagged frame with ``partitionBy`` costs one job, not two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.arith import int_floor_div


def floor_ratio(a, b, integers: bool = False) -> Column:
    """Python ``a // b`` (floor) as BIGINT; raises on b = 0 under ANSI.
    ``integers``: both sides are integer columns, divided exactly."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return (int_floor_div(a, b) if integers else F.floor(a / b)).cast("bigint")


def _integers(df: DataFrame, *cols: str) -> bool:
    return all(isinstance(df.schema[c].dataType, IntegralType) for c in cols)


def floor_ratio_sum(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: ``sum(a // b)`` over zipped columns (the ratio/summation
    job).  A zero divisor fails the job, as in the reference; use
    ``quarantine`` to keep going."""
    return df.agg(F.sum(floor_ratio(a, b, _integers(df, a, b))).alias("total"))


def quarantine(df: DataFrame, checks: dict[str, Column], error: str = "error") -> DataFrame:
    """Add ``error``: the name of the first check whose *bad* condition
    holds, NULL for a good row.  Checks are ordered (dict order)."""
    tag = F.lit(None).cast("string")
    for name, bad in reversed(list(checks.items())):
        tag = F.when(F.coalesce(bad, F.lit(False)), F.lit(name)).otherwise(tag)
    return df.withColumn(error, tag)


def good_rows(tagged: DataFrame, error: str = "error") -> DataFrame:
    return tagged.filter(F.col(error).isNull()).drop(error)


def bad_rows(tagged: DataFrame, error: str = "error") -> DataFrame:
    return tagged.filter(F.col(error).isNotNull())


def write_quarantined(tagged: DataFrame, path: str, error: str = "error",
                      mode: str = "errorifexists") -> None:
    """One job writes good rows under ``status=ok`` and bad rows under
    ``status=<reason>``."""
    (tagged.withColumn("status", F.coalesce(F.col(error), F.lit("ok"))).drop(error)
           .write.mode(mode).partitionBy("status").parquet(path))


def zero_divisor_checks(a: str, b: str) -> dict[str, Column]:
    """The checks of the ratio job: NULL inputs and a zero divisor."""
    return {"null_input": F.col(a).isNull() | F.col(b).isNull(),
            "divide_by_zero": F.col(b) == 0}


def ratio_with_quarantine(df: DataFrame, a: str, b: str) -> DataFrame:
    """``(status, n, total)``: good rows summed, bad rows counted per reason,
    from one scan and one aggregate."""
    tagged = quarantine(df, zero_divisor_checks(a, b))
    # a NULL in place of a zero divisor: no row can fail, whatever order Spark evaluates in
    ratio = F.when(F.col("error").isNull(),
                   floor_ratio(F.col(a), F.nullif(F.col(b), F.lit(0)), _integers(df, a, b)))
    return (tagged.groupBy(F.coalesce(F.col("error"), F.lit("ok")).alias("status"))
                  .agg(F.count(F.lit(1)).alias("n"), F.sum(ratio).alias("total")))


def leading_rows(df: DataFrame, order: list[str], n: int, total: int) -> DataFrame:
    """Rows of ``df`` (``total`` of them) that hold its first ``n`` rows in
    ``order``: those up to a value of the first order column that a quantile
    sketch names and an exact count confirms.  Only a numeric or time column
    can be cut; otherwise, or if the count does not confirm, all rows."""
    kind = df.schema[order[0]].dataType.simpleString()
    if n >= total or kind not in ("tinyint", "smallint", "int", "bigint", "float", "double", "date"):
        return df
    first = F.col(order[0])
    cut = df.agg(F.percentile_approx(first, min(1.0, n / total + 0.01), 10_000)).first()[0]
    head = df.filter(first.isNull() | (first <= F.lit(cut)))             # nulls come first
    return head if head.count() >= n else df


def zip_by_position(a: DataFrame, b: DataFrame, order_a: list[str], order_b: list[str],
                    how: str = "inner") -> DataFrame:
    """Pair the i-th row of ``a`` with the i-th row of ``b`` (``zip``), each
    side in its stated order.  Positions come from the distributed global
    rank (no single-partition window), then an equi-join on the position;
    ``how='inner'`` stops at the shorter side as ``zip`` does, and of the
    longer side only rows that can meet one are ranked."""
    from ..plans.ranking import global_row_number
    if how == "inner":
        na, nb = a.count(), b.count()
        a, b = leading_rows(a, order_a, nb, na), leading_rows(b, order_b, na, nb)
    pa = global_row_number(a, order_a, "_pos")
    pb = global_row_number(b, order_b, "_pos")
    return pa.join(pb, "_pos", how)
