"""Word-count goldens of the reference and tokenizer edge cases."""

import os

import pytest
from pyspark.sql import functions as F

from kestrel.functions.tokens import space_split, whitespace_tokens, word_tokens
from kestrel.operators import text as T

# Reconstructed inputs of the four word-count goldens (FIXTURES.md).
WC1 = ["Hello World Bye World", "Hello Hadoop Goodbye Hadoop"]
WC2 = ["Hello World, Bye World!", "Hello Hadoop, Goodbye to hadoop."]
SKIP = ["\\.", "\\,", "\\!", "to"]


def lines_df(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def as_dict(df):
    return {r["word"]: r["n"] for r in df.collect()}


def test_word_count_golden(spark):
    got = as_dict(T.word_count(lines_df(spark, WC1)))
    assert got == {"Bye": 1, "Goodbye": 1, "Hadoop": 2, "Hello": 2, "World": 2}


def test_word_count2_no_patterns(spark):
    got = as_dict(T.word_count(lines_df(spark, WC2)))
    assert got == {"Bye": 1, "Goodbye": 1, "Hadoop,": 1, "Hello": 2, "World!": 1,
                   "World,": 1, "hadoop.": 1, "to": 1}
    assert T.input_words(lines_df(spark, WC2)).first()[0] == 9


def test_word_count2_patterns(spark):
    got = as_dict(T.word_count(lines_df(spark, WC2), patterns=SKIP))
    assert got == {"Bye": 1, "Goodbye": 1, "Hadoop": 1, "Hello": 2, "World": 2, "hadoop": 1}
    assert T.input_words(lines_df(spark, WC2), patterns=SKIP).first()[0] == 8


def test_word_count2_patterns_lower(spark):
    got = as_dict(T.word_count(lines_df(spark, WC2), lower=True, patterns=SKIP))
    assert got == {"bye": 1, "goodbye": 1, "hadoop": 2, "hello": 2, "world": 2}


def test_observed_counter(spark):
    counts, obs = T.count_words_observed(lines_df(spark, WC2), patterns=SKIP)
    counts.collect()
    assert obs.get["input_words"] == 8


def test_regex_patterns_not_literal(spark):
    # a real regex takes the regex path; order of removal is list order
    df = lines_df(spark, ["t.o x", "a1b22c"])
    got = as_dict(T.word_count(df, patterns=["\\.", "to", "[0-9]+"]))
    assert got == {"x": 1, "abc": 1}


def test_skip_file_and_sorted_text_output(spark, scratch):
    p = os.path.join(scratch, "skip.txt")
    with open(p, "w") as f:
        f.write("\n".join(SKIP) + "\n")
    pats = T.read_skip_patterns(spark, p)
    assert as_dict(T.word_count(lines_df(spark, WC1), patterns=pats)) == as_dict(T.word_count(lines_df(spark, WC1), patterns=SKIP))
    counts = T.word_count(lines_df(spark, WC1))
    out = os.path.join(scratch, "out")
    T.write_key_value_text(counts.coalesce(1), out)
    body = [r.value for r in spark.read.text(out).collect()]
    assert body == ["Bye\t1", "Goodbye\t1", "Hadoop\t2", "Hello\t2", "World\t2"]
    with pytest.raises(Exception):
        T.write_key_value_text(counts, out)          # target must not exist


def test_space_split_edges(spark):
    rows = ["", "   ", "a b  ", " a", "a  b", "a\tb c"]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    sizes = [r[0] for r in df.select(F.size(space_split("value"))).collect()]
    assert sizes == [1, 0, 2, 2, 3, 2]
    words = T.word_count_space(df)
    assert as_dict(words)[""] == 1 + 1 + 1       # "" line, leading in " a", inner in "a  b"


def test_whitespace_tokens_never_empty(spark):
    rows = ["  a\tb\r\nc\fd  ", "", "\t\t"]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    toks = [r[0] for r in df.select(whitespace_tokens("value")).collect()]
    assert toks == [["a", "b", "c", "d"], [], []]


def test_unicode_word_tokens(spark):
    df = spark.createDataFrame([("héllo wörld_1, ça-va 42",)], "value string")
    assert df.select(word_tokens("value")).first()[0] == ["héllo", "wörld_1", "ça", "va", "42"]


def test_whole_text_and_line_by_line_agree(spark):
    text = "one two\nthree, four\n\nfive"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    whole = T.regex_word_total(df, "text").first()[0]
    per_line = T.regex_word_total(T.split_lines(df, "doc_id", "text"), "line").first()[0]
    assert whole == per_line == 5


def test_lines_containing_counts(spark):
    df = lines_df(spark, ["a Spark line", "b only", "ab", "none here", "Sparkb"])
    got = T.lines_containing(df, "value", ["a", "b", "Spark"]).first()
    assert (got[0], got[1], got[2]) == (3, 3, 2)
    assert T.filter_containing(df, "value", "Spark").count() == 2


def test_plan_has_map_side_combine(spark):
    from kestrel.plans.cache import plan_text
    plan = plan_text(T.word_count(lines_df(spark, WC1)))
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("HashAggregate")
    assert "partial_count" in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_pattern_heads(spark):
    """The head is in every match, and plain patterns are replaced as text."""
    from kestrel.functions.tokens import pattern_entries
    pats = ["\\.", "to", "to", "", "ab*c", "ab+c", "a|b", "[0-9]+", "x{2}y", "a\\.b\\?", "(?i)z", "\\d", "\\Qa\\E", "q.r", "a\\**"]
    df = spark.createDataFrame([(pats,)], "p array<string>")
    found = df.select(pattern_entries(F.col("p")).alias("e")).first()["e"]
    got = [tuple(e) for e in found["entries"]]
    gate = lambda *p: spark.createDataFrame([(list(p),)], "p array<string>").select(pattern_entries(F.col("p"))["gate"]).first()[0]
    assert found["gate"] == "" and gate("\\.", "to", "\\]x", "-", "tu") == "[.t\\]\\-]" and gate() == ""
    assert got == [("\\.", ".", True), ("to", "to", True), ("ab*c", "a", False), ("ab+c", "ab", False), ("a|b", "", False),
                   ("[0-9]+", "", False), ("x{2}y", "", False), ("a\\.b\\?", "a.b?", True), ("(?i)z", "", False), ("\\d", "", False),
                   ("\\Qa\\E", "", False), ("q.r", "q", False), ("a\\**", "a", False)]


def test_many_skip_patterns(spark, scratch):
    """50,000 patterns from a file: the same answers as one by one, in file order."""
    import re
    pats = ["ab", "\\.", "z[0-9]z"] + [f"k{i:05d}" for i in range(50_000)] + ["cd", "q+r"]
    with open(f"{scratch}/p.txt", "w") as f:
        f.write("\r\n".join(pats))
    texts = ["cabd k00017 k0001.7", "z5z k49999k00000", "untouched", "aabb qqqr", "", "MNOP"]
    hot = [p for p in pats if p[0] != "k"] + ["k00017", "k49999", "k00000"]
    want = []
    for t in texts:
        for p in sorted(hot, key=pats.index):
            t = re.sub(p, "", t)
        want += t.split()
    column = T.read_skip_patterns(spark, f"{scratch}/p.txt")
    got = as_dict(T.word_count(lines_df(spark, texts), patterns=column))
    assert got == {w: want.count(w) for w in want}
    small = T.word_count(lines_df(spark, texts), patterns=column)
    assert "NestedLoop" not in small._jdf.queryExecution().executedPlan().toString()
