"""Catalogue entries of the training-data operators.

``QUERIES`` maps a name to its builder, ``SQL`` to the DuckDB text where SQL
can express the result.  The builders are thin: they read a whole table,
apply an operator with its production parameters and shape the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from ..sources.tables import table
from . import (ann, embedding_dedup, hard_negatives, language_id, license_scan, line_dedup, mixing, ngram_join, packing,
               quality, token_files, url_filter, whitening)

Builder = Callable[[SparkSession, str], DataFrame]

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow",
             "net/es/": "block", "net/fr/": "block"}


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def held_out(column: str, folds: int, fold: int):
    """Whether a row belongs to the held-out part (null ids do not)."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds == fold, F.lit(False))


def op1_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf, "embeddings"), threshold=0.93) \
        .select("vec_id", "n_links", "component_id", "kept")


def op2_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf, "documents"))


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Per document: lines, lines dropped, their places, and the length of
    the text that is left."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    hits = line_dedup.recurring_lines(docs)
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    # only the figures of a text go on, not the text
    left = line_dedup.drop_lines(docs.withColumn("kept", F.col("text")), hits, text="kept").select(
        "doc_id", F.coalesce(breaks + 1, F.lit(0)).cast("bigint").alias("n_lines"), F.length("kept").cast("bigint").alias("kept_chars"))
    places = hits.select(F.col("doc_id").alias("id"), F.size("lines").cast("bigint").alias("n"),
                         F.array_join(F.transform("lines", lambda x: x.cast("string")), ",").alias("places"))
    return left.join(places, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "n_lines", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.coalesce("places", F.lit("")).alias("dropped"), "kept_chars")


def op5_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "statistics")       # read twice: to learn, joined with the labels, and to score
    quality.describe(table(spark, sf, "documents")).write.parquet(path)
    described = spark.read.parquet(path)
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    learn = described.filter(~held_out("doc_id", 4, 2)).join(labels.filter("label IS NOT NULL"), "doc_id")
    model = quality.fit_described(learn)
    return quality.score_described(described, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
                                             (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    net = language_id.fit(docs.filter(~held_out("doc_id", 5, 0) & F.col("doc_id").isNotNull()))
    return language_id.identify(docs, net).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer_path(WORD_TOKENIZER))


def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "tokens")
    token_files.write_tokens(table(spark, sf, "documents"), path, tokenizer_path(BYTE_TOKENIZER))
    return token_files.with_checksum(token_files.read_tokens(spark, path))


def op10_ann(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    return ann.nearest(rows, rows.filter(F.col("vec_id") % 20 == 0))


def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    grid = whitening.on_grid(table(spark, sf, "embeddings"), scale=64.0, shift=1_000_000)
    return whitening.whiten(grid, whitening.fit(grid, components=16)) \
        .withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    rows = table(spark, sf, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op13_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(table(spark, sf, "documents")).select(
        "doc_id", "n_words", F.size("base_starts").cast("bigint").alias("n_base"), F.array_min("base_starts").alias("first_word"),
        F.array_max("base_starts").alias("last_word"), F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


QUERIES: dict[str, Builder] = {f.__name__: f for f in (
    op1_embedding_dedup, op2_ngram_join, op3_mixing, op4_line_dedup, op5_url_filter, op6_quality,
    op7_language_id, op8_packing, op9_token_files, op10_ann, op11_whitening, op12_hard_negatives, op13_license_scan)}

#: The scores are small integers, so the doubles of ``list_inner_product`` are exact.
SQL: dict[str, str] = {"op12_hard_negatives": """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3"""}
