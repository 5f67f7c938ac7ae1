"""Property tests: tokenisers and arithmetic against plain-Python models of
the semantics they reproduce."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kestrel.functions.arith import floor_div, int_floor_div, py_mod
from kestrel.functions.tokens import (space_split, whitespace_token_count, whitespace_tokens,
                                      word_tokens)

ALPHABET = st.sampled_from(list("ab AZ\t\r\n\f,.!_9é ßÉ"))
LINES = st.lists(st.text(ALPHABET, max_size=12), min_size=1, max_size=25)
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def java_split_space(s: str) -> list[str]:
    """Java ``s.split(" ")``: trailing empty strings removed; "" -> [""]."""
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def string_tokenizer(s: str) -> list[str]:
    """java.util.StringTokenizer with its default delimiters."""
    return [t for t in re.split(r"[ \t\n\r\f]+", s) if t]


def collect(spark, rows, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i long, value string")
    return [r[1] for r in df.select("i", expr).orderBy("i").collect()]


@SETTINGS
@given(LINES)
def test_space_split_matches_java(spark, rows):
    assert collect(spark, rows, space_split("value")) == [java_split_space(r) for r in rows]


@SETTINGS
@given(LINES)
def test_whitespace_tokens_match_string_tokenizer(spark, rows):
    assert collect(spark, rows, whitespace_tokens("value")) == [string_tokenizer(r) for r in rows]


@SETTINGS
@given(LINES)
def test_token_count_matches_string_tokenizer(spark, rows):
    assert collect(spark, rows, whitespace_token_count("value")) == \
        [len(string_tokenizer(r)) for r in rows]


@SETTINGS
@given(LINES)
def test_word_tokens_match_python_w(spark, rows):
    assert collect(spark, rows, word_tokens("value")) == [re.findall(r"\w+", r) for r in rows]


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**6, 10**6), st.integers(-50, 50).filter(bool)),
                min_size=1, max_size=30))
def test_floor_div_and_mod_match_python(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [tuple(r) for r in df.select(floor_div("a", "b").cast("long"), py_mod("a", "b")).collect()]
    assert got == [(a // b, a % b) for a, b in pairs]


@SETTINGS
@given(st.lists(st.tuples(st.integers(-2**62, 2**62), st.integers(-2**31, 2**31).filter(bool)),
                min_size=1, max_size=30))
def test_int_floor_div_exact_64bit(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(int_floor_div("a", "b")).collect()]
    assert got == [a // b for a, b in pairs]


def test_round_half_away_matches_duckdb(spark):
    import duckdb
    from kestrel.functions.arith import round_half_away
    vals = [44.5690625, 45.8059375, -2.5e-7, 2.5e-7, -1e-9, 1234.56785, -1234.56785, 0.0, 1e12 + 0.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 6)).collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT round({v!r}::DOUBLE, 6)").fetchall()[0][0] for v in vals]
    assert [repr(g) for g in got] == [repr(w) for w in want]
