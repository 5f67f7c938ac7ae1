"""The supplied parquet tables and the standard views built on them.

Every view is a lazy projection of one table (or a join of two), so column
pruning and filter push-down reach the parquet scan through it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import parallelism

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet`` (file or directory of parts)."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Hash-distribute ``df`` on ``key`` over one partition per task slot
    when its scan yields fewer than two partitions per slot.

    Used before CPU-heavy per-row work (tokenising, regex) so that a few
    large files (or a single row group) do not pin that work to a few tasks.
    On a large input the scan is already split into many tasks and this is
    a no-op, so no extra shuffle is paid at scale.
    """
    try:
        slots = parallelism(df.sparkSession)
        if df.rdd.getNumPartitions() >= 2 * slots:
            return df
    except Exception:          # no RDD view (e.g. a Spark Connect session): leave as is
        return df
    return df.repartition(slots, key) if key else df.repartition(slots)


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register every table as a temporary view of the same name."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def register_standard_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Register the tables and the stand-in views (``account``, ``lines``,
    ``vector``, ``matrix``, ``cube``, ``nested``) for ``spark.sql``."""
    register_views(spark, sf_dir)
    views = {"account": account, "lines": lines, "vector": vector, "matrix": matrix,
             "cube": cube, "nested": nested}
    for name, make in views.items():
        make(spark, sf_dir).createOrReplaceTempView(name)
    return [*TABLES, *views]


# ---------------------------------------------------------------- stand-ins
# The reference's own inputs (account CSV/JSON files, HDF5 arrays) are not in
# its tree; these views give the same shapes over the supplied tables.

def account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat accounts ``(id, names, amount)``: customer key, segment, balance."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"),
                    F.col("c_mktsegment").alias("names"),
                    F.col("c_acctbal").alias("amount"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of ``documents``: ``(doc_id, line_no, line)``, 1-based."""
    from ..operators.text import split_lines
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return split_lines(docs, "doc_id", "text")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` spread over all cores before text work (see ``spread``)."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 1-D array in long form: ``(idx, value)`` from ``events``."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("idx"), F.col("value"))


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 2-D array in long form ``(i, j, value)`` from ``embeddings``."""
    from ..operators.grid import explode_vectors
    return explode_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 3-D grid ``(day, hour, event_type, value)`` from ``events``:
    the mean event value per cell, one day per slice."""
    from ..operators.grid import cell_means
    e = table(spark, sf_dir, "events")
    return cell_means(e, "ts", "event_type", "value")


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested account-like records from ``orders`` + ``lineitem``.

    One record per order and "file" (the reference keeps one line per account
    and file, so the same id occurs in several records); the file of a line
    item is ``l_partkey % 4``.  ``transactions`` is
    ``ARRAY<STRUCT<transaction_id BIGINT, amount DOUBLE>>``.
    """
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    return nested_from(o, li)


def nested_from(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The nested records of ``nested`` from given orders / lineitem frames."""
    from ..operators.records import nest_children
    return nest_children(account_heads(orders), account_rows(lineitem), key="id", part_cols=["file"],
                         child_cols=["transaction_id", "amount"], list_name="transactions")


def account_heads(orders: DataFrame) -> DataFrame:
    """``(id, name)``: the parents of the nested records."""
    return orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"))


def account_rows(lineitem: DataFrame) -> DataFrame:
    """``(id, file, transaction_id, amount)``: the nested records in long form."""
    return lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.pmod(F.col("l_partkey"), F.lit(4)).alias("file"),
        F.col("l_linenumber").cast("bigint").alias("transaction_id"),
        F.col("l_extendedprice").alias("amount"))


def nested_stats(spark: SparkSession, sf_dir: str, **aggs) -> DataFrame:
    """``(id, name, file, aggregates)`` per nested record, from the long form."""
    from ..operators.records import record_stats
    return record_stats(account_heads(table(spark, sf_dir, "orders")), account_rows(table(spark, sf_dir, "lineitem")),
                        "id", ["file"], aggs)
