"""Tabular operators: element-wise maps, filters, label look-ups, grouping,
value counts, top-k, joins and date parts.

Filters are plain predicates so they reach the parquet scan as
``PushedFilters``; aggregates are built-ins so they split into partial and
final halves around one exchange; top-k is ``orderBy + limit``, which plans
as ``TakeOrderedAndProject`` (a per-partition heap, never a full sort).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arith import int_floor_div, py_mod
from ..plans.joins import join_small


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def arithmetic(df: DataFrame, keep: Sequence[str], exprs: dict[str, Column]) -> DataFrame:
    """Select ``keep`` columns plus named element-wise expressions."""
    return df.select(*keep, *[e.alias(n) for n, e in exprs.items()])


def python_ops(x, n: int) -> dict[str, Column]:
    """``x + 1, x * 2, x ** 2, x // n, x % n`` with Python semantics for an
    integer ``x`` (floor division stays in exact integer arithmetic)."""
    x = _c(x)
    return {"plus_one": x + 1, "times_two": x * 2, "squared": F.pow(x, 2),
            "floordiv": int_floor_div(x, F.lit(n)).cast("bigint"), "mod": py_mod(x, F.lit(n))}


def where(df: DataFrame, cond: Column) -> DataFrame:
    return df.filter(cond)


def isin(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def loc(df: DataFrame, index: str, label) -> DataFrame:
    """All rows whose index column equals ``label`` (``df.loc[label]``)."""
    return df.filter(F.col(index) == F.lit(label))


def loc_range(df: DataFrame, index: str, lo, hi) -> DataFrame:
    """Label slice, both ends inclusive (``df.loc[lo:hi]``)."""
    return df.filter(F.col(index).between(lo, hi))


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a stated order (made deterministic by ``order``)."""
    return df.orderBy(*order).limit(n)


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).dropDuplicates()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(col, n)``, nulls dropped, most frequent first, ties by value."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.asc(col)))


def count_by(df: DataFrame, key: str, sort: bool = True) -> DataFrame:
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(key) if sort else out


def group_mean(df: DataFrame, key: str, value: str, cond: Column | None = None,
               drop_null_keys: bool = True) -> DataFrame:
    """``(key, mean)``; like pandas, null keys form no group."""
    if cond is not None:
        df = df.filter(cond)
    if drop_null_keys:
        df = df.filter(F.col(key).isNotNull())
    return df.groupBy(key).agg(F.avg(value).alias("mean"))


def group_count_max(df: DataFrame, key: str, count_col: str, max_col: str) -> DataFrame:
    """``(key, n, max)``: count of non-null ``count_col``, max of ``max_col``."""
    return df.groupBy(key).agg(F.count(count_col).alias("n"), F.max(max_col).alias("max"))


def topk_group_mean(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """The ``k`` keys with the highest mean; ties broken by key."""
    return (df.groupBy(key).agg(F.avg(value).alias("mean"))
              .orderBy(F.desc("mean"), F.asc(key)).limit(k))


def global_stats(df: DataFrame, col: str) -> DataFrame:
    """One row: count, sum, mean, min, max and population variance / std
    (ddof 0, the array default)."""
    c = F.col(col)
    return df.agg(F.count(c).alias("n"), F.sum(c).alias("total"), F.avg(c).alias("mean"),
                  F.min(c).alias("min"), F.max(c).alias("max"),
                  F.var_pop(c).alias("var"), F.stddev_pop(c).alias("std"))


def join_on(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join; the right side is broadcast only if proven small."""
    return join_small(left, right, on, how)


def date_parts(df: DataFrame, ts: str, keep: Sequence[str]) -> DataFrame:
    c = F.col(ts)
    return df.select(*keep, F.year(c).cast("bigint").alias("year"),
                     F.month(c).cast("bigint").alias("month"),
                     F.dayofmonth(c).cast("bigint").alias("day"))
