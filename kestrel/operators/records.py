"""Nested records: build, pluck, size, flatten, denormalise, and folds over
nested lists.

Records carry a list column ``ARRAY<STRUCT<...>>``.  Per-record work uses
higher-order functions (``size``, ``transform``, ``aggregate``, ``filter``)
so nothing is exploded unless rows are really wanted; per-key folds are
built-in aggregates over those per-record values, so they combine map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nest_children(parent: DataFrame, child: DataFrame, key: str, part_cols: Sequence[str],
                  child_cols: Sequence[str], list_name: str) -> DataFrame:
    """One record per parent and part: parent columns + list of child structs.

    ``part_cols`` are columns of the child that split a parent's children over
    several records (the "one line per account and file" layout); the layout
    depends on them alone, never on a measured size.  A record is one row, so
    where a parent may have very many children, part columns must keep its
    lists small; ``record_stats`` computes per-record figures without lists.
    Parents without children get one record with an empty list and parts set
    to 0.  Lists are sorted, so records are deterministic.
    """
    lists = F.array_sort(F.collect_list(F.struct(*child_cols)))
    rec = record_stats(parent, child, key, part_cols, {list_name: lists})
    return rec.withColumn(list_name, F.coalesce(F.col(list_name), F.array().cast(rec.schema[list_name].dataType)))


def record_stats(parent: DataFrame, child: DataFrame, key: str, part_cols: Sequence[str],
                 aggs: dict[str, Column]) -> DataFrame:
    """One row per record of ``nest_children``: parent columns, parts, and
    aggregates over the record's children taken from the long form (partial
    aggregation before the shuffle, so a hot parent is one row per map task).
    Aggregates of a parent without children are NULL."""
    grouped = child.groupBy(key, *part_cols).agg(*[a.alias(n) for n, a in aggs.items()])
    return parent.join(grouped, key, "left").select(
        *parent.columns,
        *[F.coalesce(F.col(p), F.lit(0).cast(grouped.schema[p].dataType)).alias(p) for p in part_cols], *aggs)


def pluck(df: DataFrame, *fields: str) -> DataFrame:
    """Select fields (``bag.pluck``); nested paths like ``'s.f'`` allowed."""
    return df.select(*[F.col(f).alias(f.split(".")[-1]) for f in fields])


def pluck_list_field(list_col: str, field: str) -> Column:
    """ARRAY of one field of every struct in a list (``pluck`` on a list)."""
    return F.transform(F.col(list_col), lambda s: s[field])


def with_size(df: DataFrame, list_col: str, name: str = "n") -> DataFrame:
    """Add the list length (``len(d['transactions'])``); NULL list -> 0."""
    return df.withColumn(name, F.coalesce(F.size(F.col(list_col)), F.lit(0)).cast("bigint"))


def flatten(df: DataFrame, list_col: str) -> DataFrame:
    """One row per list element, element fields as columns; empty lists
    contribute nothing (``bag.flatten``)."""
    return df.select(F.explode(F.col(list_col)).alias("_e")).select("_e.*")


def denormalize(df: DataFrame, parent_cols: Sequence[str], list_col: str) -> DataFrame:
    """Parent fields copied onto every child row."""
    return (df.select(*parent_cols, F.explode(F.col(list_col)).alias("_e"))
              .select(*parent_cols, "_e.*"))


def denormalize_rows(heads: DataFrame, rows: DataFrame, key: str, parent_cols: Sequence[str],
                     child_cols: Sequence[str]) -> DataFrame:
    """``denormalize`` of records kept in long form, a table of parents and
    one of children: one join, no list is built.  A record with any number of
    children is rows of any number of tasks."""
    return rows.join(heads.select(key, *[c for c in parent_cols if c != key]), key).select(*parent_cols, *child_cols)


def flatten_rows(heads: DataFrame, rows: DataFrame, key: str, child_cols: Sequence[str]) -> DataFrame:
    """``flatten`` of records kept in long form: the children of all parents."""
    return rows.join(heads.select(key), key, "left_semi").select(*child_cols)


def list_sum(list_col: str, field: str) -> Column:
    """Sum of one numeric field over the list (0 for an empty list)."""
    return F.aggregate(F.col(list_col), F.lit(0.0),
                       lambda acc, s: acc + F.coalesce(s[field].cast("double"), F.lit(0.0)))


def list_count(list_col: str, field: str) -> Column:
    """Number of elements whose field is not NULL."""
    return F.size(F.filter(F.col(list_col), lambda s: s[field].isNotNull()))


def list_max(list_col: str, field: str) -> Column:
    """Largest value of one field over the list (NULL for an empty list)."""
    return F.array_max(F.transform(F.col(list_col), lambda s: s[field]))


def nested_mean(df: DataFrame, list_col: str, field: str, cond: Column | None = None) -> DataFrame:
    """One row: the mean of a nested field over (filtered) records, computed
    as total / count so the answer never depends on how records are split."""
    if cond is not None:
        df = df.filter(cond)
    # try_divide: no values gives NULL (as ``avg`` of nothing), not an error
    return df.agg(F.try_divide(F.sum(list_sum(list_col, field)),
                               F.sum(list_count(list_col, field))).alias("mean"))


def nested_size_mean(df: DataFrame, list_col: str, cond: Column | None = None) -> DataFrame:
    """One row: the mean list length over (filtered) records."""
    if cond is not None:
        df = df.filter(cond)
    return df.agg(F.avg(F.size(F.col(list_col))).alias("mean_count"))


def fold_by(df: DataFrame, key: str, aggs: dict[str, Column]) -> DataFrame:
    """``foldby`` for associative folds expressed as built-in aggregates
    (partial aggregation before the shuffle)."""
    return df.groupBy(key).agg(*[a.alias(n) for n, a in aggs.items()])


def to_frame(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Records to a flat, typed frame (``bag.to_dataframe``)."""
    return df.select(*[c.alias(n) for n, c in cols.items()])


def parse_json_records(df: DataFrame, text: str, schema: str, corrupt_col: str | None = None) -> DataFrame:
    """JSON text column to the typed columns of the DDL ``schema``; a malformed
    line yields NULL fields instead of failing the job, and ``corrupt_col``
    (if named) holds its text, NULL for a good line."""
    rest = [c for c in df.columns if c != text]
    options = {"columnNameOfCorruptRecord": corrupt_col} if corrupt_col else {}
    full = f"{schema}, `{corrupt_col}` STRING" if corrupt_col else schema
    return df.select(F.from_json(F.col(text), full, options).alias("_r"), *rest).select("_r.*", *rest)


def read_json_records(spark, path: str, schema, corrupt_col: str = "_corrupt_record") -> DataFrame:
    """JSON-lines files (glob, ``.gz`` ok) with a declared schema; malformed
    lines are kept in ``corrupt_col`` rather than dropped."""
    from pyspark.sql.types import StringType, StructField, StructType
    full = StructType(list(schema.fields) + [StructField(corrupt_col, StringType(), True)])
    return (spark.read.schema(full).option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", corrupt_col).json(path))
