"""A corpus pipeline of five stages over ``documents``.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All stages but the last return the columns of
``documents``: ``doc_id, text, lang, source, n_chars``.

1. ``language_id`` drops documents whose language cannot be told (no letter,
   or a score below 0.5);
2. ``line_dedup`` takes lines of recurring templates out of all documents but
   the first that has them; a document that loses all its lines goes;
3. ``ngram_join`` keeps one document (the smallest id) of each group of near
   duplicates;
4. ``mixing`` takes each source's share: a document appears once for every
   whole copy taken and once more for each word range taken from it;
5. ``packing`` packs the mix into sequences of 4096 tokens.

Rows with a null id pass stages 1 to 3 but for the language; extra columns
are dropped; repeated rows of one id and text count as one document in stage
3 and stand once after it.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import language_id, line_dedup, mixing, ngram_join, packing
from kestrel.llm.common import small_batches
from kestrel.llm.queries import WORD_TOKENIZER, tokenizer_path
from kestrel.session import work_dir
from kestrel.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_SCORE = 0.5
PIECES = 200_000        # pieces of text whose ids a worker keeps in packing: the default takes some 75 MB more, beside what the stages before left
SPACE = r"[\x20\x09-\x0D]"


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = language_id.fit(docs)
    found = language_id.identify(docs, net, carry=("text", "lang", "source", "n_chars"))
    kept = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return kept.select("doc_id", F.col("carry_text").alias("text"), F.coalesce("carry_lang", "lang_pred").alias("lang"),
                       F.col("carry_source").alias("source"), F.col("carry_n_chars").alias("n_chars"))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    out = line_dedup.drop_lines(docs.withColumn("before", F.col("text")), line_dedup.recurring_lines(docs))
    emptied = (F.trim("text") == "") & (F.trim("before") != "")
    return out.filter(~F.coalesce(emptied, F.lit(False))).drop("before") \
              .withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    with small_batches(spark):          # its jobs run here: texts and sets reach Python a few MB at a time
        groups = ngram_join.jaccard_components(docs)
    gone = groups.filter("doc_id != component_id").select("doc_id").distinct()
    named = docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    return named.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(named.filter("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, carry=("text", "lang"))
    # words with the white space before them, so that a cut keeps its line breaks and indentation
    words = F.regexp_extract_all("carry_text", F.lit(f"({SPACE}*{mixing.WORDS})"), 1)
    cut = F.transform("spans", lambda s: F.when(s["length"] == F.col("size"), F.col("carry_text")).otherwise(
        F.array_join(F.slice(words, (s["start"] + 1).cast("int"), s["length"].cast("int")), "")))
    parts = F.concat(F.array_repeat(F.col("carry_text"), F.col("copies").cast("int")), cut)
    return mixed.filter("taken > 0").select("doc_id", F.explode(parts).alias("text"), F.col("carry_lang").alias("lang"), "source") \
                .withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path(WORD_TOKENIZER), cache=PIECES)


STAGES = [("language_id", identify_languages), ("line_dedup", drop_recurring_lines),
          ("ngram_join", keep_one_of_each_group), ("mixing", mix_sources), ("packing", pack_sequences)]

#: A trained network, a similarity join and a tokenizer have no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``<sf_dir>/documents.parquet``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
