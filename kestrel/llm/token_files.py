"""Token ids in Parquet list columns.

``write_tokens`` encodes whole texts and writes, in ascending document order,

* ``<path>/tokens``: ``doc_id, shard, row, local_start, n_tokens, ids``; files
  are ranges of ids in order (``shard`` numbers them).  ``ids`` is a list of
  32-bit integers, dictionary encoded (the vocabulary fits one dictionary
  page, so an id takes at most as many bits as the vocabulary needs); the
  other columns rise and are delta encoded.  Row groups have a set size, pages
  a set number of rows, and every column has a page index, so a reader of a
  few documents or of the metadata columns touches only their pages;
* ``<path>/manifest``: per shard its first and last id, documents, tokens and
  the number of tokens before it.

``read_metadata`` never opens the ids column; ``read_tokens`` takes a range of
ids that is pushed down to row groups and pages.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ..plans.joins import broadcast_if_small
from .tokens import broadcast_tokenizer, shared_encoder, slices

CALL_CHARS = 2_000_000          # of an encoder call: a word is looked up once a call
DELTA = ("doc_id", "row", "local_start", "n_tokens", "shard")


def _encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``docs`` (``doc_id, text``, sorted) to rows of the tokens table."""
    json = broadcast_tokenizer(docs.sparkSession, tokenizer)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        enc = shared_encoder(json)
        row, start = 0, 0
        for b in batches:
            for at, texts in slices(b, 1, 2048, CALL_CHARS):
                parts = [ids + end for ids in enc.encode(texts)]
                sizes = np.array([len(p) // 4 for p in parts], dtype=np.int64)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                flat = np.frombuffer(b"".join(parts), dtype="<i4")
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), pa.array(row + np.arange(len(texts))), pa.array(start + ends[:-1]),
                     pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))],
                    names=["doc_id", "row", "local_start", "n_tokens", "ids"])
                row += len(texts)
                start += int(ends[-1])
    schema = StructType([*(StructField(c, LongType()) for c in ("doc_id", "row", "local_start", "n_tokens")),
                         StructField("ids", ArrayType(IntegerType(), containsNull=False))])
    return docs.mapInArrow(run, schema)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = 2, shards: int | None = None, row_group_bytes: int = 32 << 20,
                 page_rows: int = 1000) -> None:
    """Write the ids of every row of ``docs`` below ``path`` (which must not
    exist).

    Null and empty texts have the end id only.  Rows with a null id come
    first; repeated rows are written as often as they occur; rows with equal
    ids stand in the order of their texts.  An empty table gives empty files.
    Other columns are not read."""
    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    ranged = src.repartitionByRange(shards, "doc_id") if shards else src.repartitionByRange("doc_id")
    rows = _encoded(ranged.sortWithinPartitions("doc_id", "text"), tokenizer, end_id)
    out = rows.withColumn("shard", F.spark_partition_id())
    w = out.select("doc_id", "shard", "row", "local_start", "n_tokens", "ids").write \
           .option("parquet.writer.version", "PARQUET_2_0").option("parquet.block.size", str(row_group_bytes)) \
           .option("parquet.page.row.count.limit", str(page_rows)).option("parquet.enable.dictionary", "true") \
           .option("parquet.dictionary.page.size", str(4 << 20))
    for c in DELTA:
        w = w.option(f"parquet.enable.dictionary#{c}", "false")
    w.parquet(f"{path}/tokens")
    spark = docs.sparkSession
    files = spark.read.parquet(f"{path}/tokens").groupBy("shard").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
        F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)     # one row per file
    files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))) \
         .coalesce(1).write.parquet(f"{path}/manifest")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens)`` without reading ids; ``start`` counts the
    ids of all documents before."""
    return read_tokens(spark, path).drop("ids")


def read_tokens(spark: SparkSession, path: str, first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)``, optionally of the documents with
    ids from ``first_id`` to ``last_id``."""
    t = spark.read.parquet(f"{path}/tokens")
    if first_id is not None:
        t = t.filter(F.col("doc_id") >= first_id)
    if last_id is not None:
        t = t.filter(F.col("doc_id") <= last_id)
    m = spark.read.parquet(f"{path}/manifest").select("shard", F.col("start").alias("shard_start"))
    return t.join(broadcast_if_small(m), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def with_checksum(tokens: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``: the unsigned crc32 of the ids
    as little-endian unsigned 32-bit integers."""
    def run(batches):
        for b in batches:
            flat, ends = b.column(3).values, b.column(3).offsets.to_numpy()
            raw = np.asarray(flat.to_numpy(zero_copy_only=False), dtype="<u4")
            crc = [zlib.crc32(raw[s:e].tobytes()) for s, e in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return tokens.select("doc_id", "start", "n_tokens", "ids") \
                 .mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
