"""Catalogue: text operators over ``documents``."""

from __future__ import annotations

from ..functions.tokens import TOKENIZER_DELIMS
from ..operators import text as T
from ..session import work_dir
from ..sources.tables import documents, lines
from .registry import query

# The skip-pattern side file of the word-count job (one Java
# regex per line, applied in this order), and the substrings searched by the
# line filters.
SKIP_PATTERNS = ["\\.", "\\,", "\\!", "to"]
NEEDLES = ["a", "b", "Spark"]

_LINES_SQL = "lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"
_DELIMS_SQL = TOKENIZER_DELIMS


def _skip_sql(expr: str, lower: bool) -> str:
    out = f"lower({expr})" if lower else expr
    for p in SKIP_PATTERNS:
        out = f"regexp_replace({out}, '{p}', '', 'g')"
    return out


def _wc_sql(lower: bool) -> str:
    return f"""
WITH {_LINES_SQL}
SELECT word, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest(regexp_split_to_array({_skip_sql('line', lower)}, '{_DELIMS_SQL}')) AS word
  FROM lines) t
WHERE word <> '' GROUP BY word"""


_SPACE_SPLIT_SQL = ("CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[] "
                    "ELSE string_split(rtrim(line, ' '), ' ') END")


@query("text_lines", """
SELECT doc_id,
       CAST(unnest(generate_series(1, len(string_split(text, chr(10))))) AS BIGINT) AS line_no,
       unnest(string_split(text, chr(10))) AS line
FROM documents""", ids="SRC-1")
def text_lines(spark, sf):
    return lines(spark, sf)


@query("lines_containing", f"""
WITH {_LINES_SQL}
SELECT {", ".join(f"CAST(count(*) FILTER (WHERE contains(line, '{n}')) AS BIGINT) AS lines_with_{i}"
                  for i, n in enumerate(NEEDLES))}
FROM lines""", ids="PRJ-5, FN-6")
def lines_containing(spark, sf):
    return T.lines_containing(lines(spark, sf), "line", NEEDLES)


@query("row_count", f"""
WITH {_LINES_SQL}
SELECT CAST(count(*) AS BIGINT) AS n_rows FROM lines""", ids="AG-8")
def row_count(spark, sf):
    return T.row_count(lines(spark, sf))


@query("word_count", f"""
SELECT word, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest(regexp_split_to_array(text, '{_DELIMS_SQL}')) AS word FROM documents) t
WHERE word <> '' GROUP BY word""", ids="AG-1, AG-4, FN-1")
def word_count(spark, sf):
    # newline is a delimiter, so tokenising whole texts equals tokenising lines
    return T.word_count(documents(spark, sf).select("text"), "text")


def _skip_file_patterns(spark):
    """The skip patterns as the job sees them: a side file (one regex per
    line) in the shared folder, read back in file order."""
    path = work_dir(spark, "skip-patterns")
    (spark.createDataFrame([(p,) for p in SKIP_PATTERNS], "value string")
          .coalesce(1).write.text(path))
    return T.read_skip_patterns(spark, path)


@query("wc_skip", _wc_sql(lower=False), ids="AG-2, FN-4, SRC-12")
def wc_skip(spark, sf):
    return T.word_count(lines(spark, sf), "line", lower=False, patterns=_skip_file_patterns(spark))


@query("wc_skip_lower", _wc_sql(lower=True), ids="AG-2, FN-3, FN-4, SRC-12")
def wc_skip_lower(spark, sf):
    return T.word_count(lines(spark, sf), "line", lower=True, patterns=_skip_file_patterns(spark))


@query("input_words", f"""
WITH {_LINES_SQL}
SELECT CAST(sum(len(list_filter(regexp_split_to_array({_skip_sql('line', False)}, '{_DELIMS_SQL}'),
                                lambda w: w <> ''))) AS BIGINT) AS input_words
FROM lines""", ids="AG-3")
def input_words(spark, sf):
    return T.input_words(lines(spark, sf), "line", patterns=SKIP_PATTERNS)


@query("word_count_space", f"""
WITH {_LINES_SQL}
SELECT word, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest({_SPACE_SPLIT_SQL}) AS word FROM lines) t
GROUP BY word""", ids="AG-6, FN-2")
def word_count_space(spark, sf):
    return T.word_count_space(lines(spark, sf), "line")


@query("max_words_per_line", f"""
WITH {_LINES_SQL}
SELECT CAST(max(len({_SPACE_SPLIT_SQL})) AS BIGINT) AS max_words FROM lines""", ids="AG-7")
def max_words_per_line(spark, sf):
    return T.max_words_per_line(lines(spark, sf), "line")


@query("regex_word_total", r"""
SELECT CAST(sum(len(regexp_extract_all(text, '[\p{L}\p{N}_]+'))) AS BIGINT) AS n_tokens
FROM documents""", ids="AG-5, FN-5")
def regex_word_total(spark, sf):
    return T.regex_word_total(documents(spark, sf).select("text"), "text")
