"""Text operators: lines, word counts, token totals, substring filters.

All of them are one narrow stage (split / explode / filter) followed by a
hash aggregate whose partial half runs before the shuffle - Spark's
map-side combine, the same thing as the reference's combiner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tokens import (TOKENIZER_DELIMS, normalise_line, pattern_entries, space_split,
                               whitespace_token_count, word_tokens)
from ..session import work_dir


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of text files (glob allowed; ``.gz`` decompressed).

    A gzip file cannot be split, so it is read by one task; the caller may
    ``repartition`` after the scan when files are few and large.
    """
    return spark.read.text(path)


def read_skip_patterns(spark: SparkSession, path: str) -> Column:
    """The side file of regex patterns, one per line, in file order, as a
    column for the ``patterns`` of the functions below.

    The file is read whole as one row and becomes one ordered array that Spark
    hands to the tasks as a scalar subquery: no pattern passes through Python,
    and their number is not limited.  Empty lines are no patterns."""
    whole = spark.read.text(path, wholetext=True)
    entries = pattern_entries(F.split("value", "\r?\n"))
    written = work_dir(spark, "patterns")                 # parsed once, whatever the number of uses
    whole.select(entries.alias("entries")).write.parquet(written)
    return spark.read.parquet(written).scalar()


def split_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, line_no, line)`` for every ``\\n``-separated line (1-based)."""
    return df.select(F.col(key), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line")) \
        .select(key, (F.col("pos") + 1).cast("bigint").alias("line_no"), "line")


def _placed(df: DataFrame, text: str, patterns):
    """A pattern column from ``read_skip_patterns`` as a column of the rows
    (lambdas take no subquery); a list stays as it is."""
    if not isinstance(patterns, Column):
        return df, patterns
    return df.select(text, patterns.alias("_patterns")), F.col("_patterns")


def tokens(df: DataFrame, text: str, lower: bool = False,
           patterns: Sequence[str] | Column = ()) -> DataFrame:
    """One row per whitespace token after optional lower-case + pattern removal.

    The raw split is exploded and empty pieces dropped by a plain filter,
    which keeps the whole stage in generated code (a lambda filter on the
    array would be interpreted per element)."""
    df, patterns = _placed(df, text, patterns)
    line = normalise_line(F.col(text), lower=lower, patterns=patterns)
    return (df.select(F.explode(F.split(line, TOKENIZER_DELIMS)).alias("word"))
              .filter(F.col("word") != ""))


def word_count(df: DataFrame, text: str = "value", lower: bool = False,
               patterns: Sequence[str] | Column = ()) -> DataFrame:
    """``(word, n)``: whitespace-token counts (the MapReduce word count).

    ``lower`` and ``patterns`` give the configurable variant: lower-case
    first, then delete every pattern, then tokenise.
    """
    return tokens(df, text, lower, patterns).groupBy("word") \
        .agg(F.count(F.lit(1)).alias("n"))


def count_words_observed(df: DataFrame, text: str = "value", lower: bool = False,
                         patterns: Sequence[str] | Column = (), name: str = "input_words"):
    """Word count plus a named job counter of emitted tokens.

    Returns ``(counts_df, observation)``; ``observation.get`` holds
    ``{name: total}`` once an action on ``counts_df`` has run.  Observed
    metrics are taken from the final plan once, so retried or speculative
    tasks do not double-count as accumulators would.
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    toks = tokens(df, text, lower, patterns).observe(obs, F.count(F.lit(1)).alias(name))
    return toks.groupBy("word").agg(F.count(F.lit(1)).alias("n")), obs


def input_words(df: DataFrame, text: str = "value", lower: bool = False,
                patterns: Sequence[str] | Column = ()) -> DataFrame:
    """One row: the number of tokens the word count emits (exact)."""
    df, patterns = _placed(df, text, patterns)
    line = normalise_line(F.col(text), lower=lower, patterns=patterns)
    return df.agg(F.sum(whitespace_token_count(line)).cast("bigint").alias("input_words"))


def word_count_space(df: DataFrame, text: str = "value") -> DataFrame:
    """``(word, n)`` over ``split(" ")`` tokens: empty tokens are counted."""
    return df.select(F.explode(space_split(text)).alias("word")) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def max_words_per_line(df: DataFrame, text: str = "value") -> DataFrame:
    """One row: the largest ``split(" ")`` size of any line."""
    return df.agg(F.max(F.size(space_split(text))).cast("bigint").alias("max_words"))


def regex_word_total(df: DataFrame, text: str = "value") -> DataFrame:
    """One row: the number of Unicode ``\\w+`` runs in all texts."""
    return df.agg(F.sum(F.size(word_tokens(text))).cast("bigint").alias("n_tokens"))


def lines_containing(df: DataFrame, text: str, needles: Sequence[str]) -> DataFrame:
    """One row with a count per needle of lines containing it (case-sensitive).

    A single scan feeds every counter (conditional aggregates), instead of one
    filter + count per needle.
    """
    aggs = [F.count(F.when(F.col(text).contains(n), 1)).cast("bigint").alias(f"lines_with_{i}")
            for i, n in enumerate(needles)]
    return df.agg(*aggs)


def filter_containing(df: DataFrame, text: str, needle: str) -> DataFrame:
    """Rows whose text contains ``needle`` (case-sensitive)."""
    return df.filter(F.col(text).contains(needle))


def sorted_word_lines(counts: DataFrame, key: str = "word", value: str = "n") -> DataFrame:
    """``key<TAB>value`` lines sorted by key, as the MapReduce text output."""
    return counts.orderBy(key).select(
        F.concat_ws("\t", F.col(key), F.col(value).cast("string")).alias("value"))


def write_key_value_text(counts: DataFrame, path: str, key: str = "word",
                         value: str = "n") -> None:
    """Write the sorted ``key<TAB>value`` text; fails if ``path`` exists."""
    sorted_word_lines(counts, key, value).write.mode("errorifexists").text(path)


def row_count(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` (counts are BIGINT)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def count_per_file(df: DataFrame) -> DataFrame:
    """Rows per input file, for multi-file scans (``input_file_name``)."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
