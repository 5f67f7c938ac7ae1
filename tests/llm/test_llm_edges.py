"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing extra columns, for every operator and pipeline stage."""

import pytest
from pyspark.sql import functions as F

from kestrel.llm import (ann, embedding_dedup, language_id, line_dedup, mixing, ngram_join, packing, quality,
                         token_files, url_filter)
from kestrel.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER, tokenizer_path

LONG = "some words of a long text that goes on " * 40_000                # 1.5 MB, one line
EXTRA = "component_id long, n long, score double, words string, label int, carry_text string, features array<long>"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def with_extras(df):
    """Columns that carry the operators' own names."""
    for c in EXTRA.split(", "):
        name, kind = c.split(" ", 1)
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "the same words in the same order here", "en", "a", 1), (2, "the same words in the same order here", "en", "a", 1),
            (2, "the same words in the same order here", "en", "a", 1), (3, None, None, None, None), (4, "", "en", "a", 0),
            (5, " \t\n ", "en", None, 4), (6, "Word", "de", "b", 4), (7, "word", None, "b", 4), (8, LONG, "en", "b", len(LONG)),
            (9, "12 34 !!", "en", "c", 8), (None, "no id but a text of a few words", "fr", "c", 9), (10, "x" * 300_000, "en", "c", 1)]
    df = with_extras(spark.createDataFrame(rows, DOCS)).repartition(3).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def none(spark):
    return with_extras(spark.createDataFrame([], DOCS))


def test_ngram_join(odd, none):
    got = sorted(((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(odd).collect()))
    by = {g[0]: g[1:] for g in got}
    assert len(got) == 12 and by[1] == (4, 1) and by[2] == (4, 1) and by[3] == (0, 3) and by[4] == (0, 4) and by[5] == (0, 5)
    assert by[6] == (1, 6) and by[7] == (1, 6) and by[10] == (1, 10) and by[-1] == (5, None)
    words = LONG.split()
    assert by[8][0] == len({tuple(words[i:i + 5]) for i in range(len(words) - 4)})
    assert ngram_join.jaccard_components(none).collect() == []
    with pytest.raises(ValueError):
        ngram_join.jaccard_components(odd, num=50)


def test_mixing(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == 12 and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert all(r["taken"] == 0 for r in got if r["doc_id"] in (3, 4, 5))
    assert mixing.mix(none).collect() == []
    wordless = mixing.mix(odd.filter("doc_id IN (3, 4, 5)")).collect()
    assert [(r["taken"], r["target"]) for r in wordless] == [(0, 0.0)] * 3


@pytest.mark.parametrize("times", [1, 10])
def test_mixing_rare_sources(spark, times):
    """Rare sources reach their targets beside large ones, in a small and in a large corpus."""
    words = {"big1": (80 * times, 300), "big2": (80 * times, 300), "few5": (1, 5), "ten1": (1, 10), "ten2": (2, 5), "ten3": (10, 1)}
    rows = [(i, " ".join(["w"] * n), s) for s, (docs, n) in words.items() for i in range(docs)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source") \
        .agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    for r in got:
        assert abs(r["taken"] - r["target"]) <= (1 if r["source"][:3] != "big" else 0.01 * r["target"]), r
    assert {r["source"]: r["taken"] for r in got}["few5"] == 15


def test_line_dedup(spark, odd, none):
    hits = {r["doc_id"]: r["lines"] for r in line_dedup.recurring_lines(odd).collect()}
    assert hits == {2: [0]}
    left = line_dedup.drop_lines(odd, line_dedup.recurring_lines(odd))
    assert left.columns == odd.columns and left.count() == 12
    texts = {(r["doc_id"], r["text"]) for r in left.collect()}
    assert (2, "") in texts and (3, None) in texts and (8, LONG) in texts
    assert line_dedup.recurring_lines(none).collect() == []


def test_quality(odd, none):
    model = quality.fit(odd.select("text", F.when(F.col("doc_id") < 4, 1).when(F.col("doc_id") < 9, 0).alias("label")))
    got = quality.score(odd, model).collect()
    assert len(got) == 12 and all(0 <= r["score"] <= 1 for r in got)
    empty = quality.fit(none)
    assert 0 <= quality.score(odd, empty).first()["score"] <= 1 and quality.score(none, empty).collect() == []
    one = quality.fit(odd.select("text", F.lit(1).alias("label")))
    assert quality.score(odd, one).first()["score"] > 0.5


def test_language_id(odd, none):
    net = language_id.fit(odd, steps=20)
    got = language_id.identify(odd, net, carry=("lang", "score")).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 12 and all(by[d]["lang_pred"] == "und" and by[d]["score"] == 0 for d in (3, 4, 5, 9))
    assert by[8]["lang_pred"] in net.languages and by[8]["carry_lang"] == "en"
    blank = language_id.fit(none)
    assert blank.languages == [] and {r["lang_pred"] for r in language_id.identify(odd, blank).collect()} == {"und"}
    assert language_id.identify(none, net).collect() == []


def test_packing(odd, none):
    got = packing.pack_documents(odd, tokenizer_path(WORD_TOKENIZER)).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["length"])
    assert by[3] == by[4] == by[5] == [1] and len(by[2]) == 2 and None in by
    assert all(x == 4096 for x in sorted(by[8])[1:]) and sum(by[8]) > 300_000
    assert packing.pack_documents(none, tokenizer_path(WORD_TOKENIZER)).collect() == []


def test_token_files(spark, odd, none, scratch):
    token_files.write_tokens(odd, f"{scratch}/a", tokenizer_path(BYTE_TOKENIZER), shards=4)
    got = token_files.with_checksum(token_files.read_tokens(spark, f"{scratch}/a")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:i]) for i in range(12)]
    assert [r["n_tokens"] for r in got if r["doc_id"] in (3, 4)] == [1, 1]
    token_files.write_tokens(none, f"{scratch}/b", tokenizer_path(BYTE_TOKENIZER))
    assert token_files.read_metadata(spark, f"{scratch}/b").collect() == []


def test_url_filter(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://"), (4, "HTTP://Example.COM?x"), (5, "http://a.com#f"), (5, "http://a.com#f"),
            (None, "x://www.Example.com/en/a?b#c"), (6, "a://b://c/d"), (7, "http://h.org/" + "a/" * 5000), (8, "http://notcom/x\ny")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("score", F.lit("x"))
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow"}
    got = sorted(((r["page_id"] or 0, r["host"], r["path"][:9], r["rule"], r["verdict"]) for r in url_filter.judge_urls(df, rules).collect()),
                 key=str)
    assert got == sorted([(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
                          (4, "example.com", "", None, "allow"), (5, "a.com", "", None, "allow"), (5, "a.com", "", None, "allow"),
                          (0, "www.example.com", "/en/a", "www.example.com/en/", "allow"), (6, "b:", "//c/d", None, "allow"),
                          (7, "h.org", "/a/a/a/a/", None, "allow"), (8, "notcom", "/x\ny", None, "allow")], key=str)
    assert url_filter.judge_urls(df.limit(0), rules).collect() == []


VECTORS = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
           (6, [0.0, 0.0], 1), (7, [1.0, float("nan")], 1), (8, [1.0, None], 1), (9, [], 1), (10, [1.0, 0.1, 0.0], 1),
           (None, [1.0, 0.01], 1), (11, [1e200, 1e198], 1)]


@pytest.fixture(scope="module")
def vectors(spark):
    df = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>, label int")
    return df.withColumn("unit", F.lit("x")).withColumn("score", F.lit("x")).withColumn("node", F.lit(0))


def test_embedding_dedup(vectors):
    got = embedding_dedup.near_duplicates(vectors).collect()
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    assert len(got) == len(VECTORS)
    assert by[1] == [(4, 1, True)] and by[2] == [(4, 1, False)] * 2 and by[None] == [(4, 1, False)] and by[11] == [(4, 1, False)]
    assert all(by[i] == [(0, i, True)] for i in (3, 4, 5, 6, 7, 8, 9, 10))
    assert embedding_dedup.near_duplicates(vectors.limit(0)).collect() == []


def test_ann(vectors):
    got = ann.nearest(vectors.filter("vec_id != 11 OR vec_id IS NULL"), vectors.filter("vec_id IN (1, 5, 6, 10)"), k=3).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert by == {1: [(2, 2.0), (2, 2.0), (3, 1.0)]}        # ties to the smaller id; nothing else of 3 components
    assert ann.nearest(vectors.limit(0), vectors).collect() == [] and ann.nearest(vectors, vectors.limit(0)).collect() == []


def test_pipeline_stages(spark, odd, none):
    import corpus_pipeline as P
    for name, stage in P.STAGES:
        for docs in (odd, none):
            out = stage(spark, docs, "")
            n = out.count()
            if name != P.STAGES[-1][0]:
                assert out.columns == list(P.COLUMNS)
            assert n == 0 if docs is none else n > 0


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline as P
    text = "document {0} tells of the {0} house and of the {0} garden\nand nobody else has said {0} before in quite this way"
    rows = [(i, text.format(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}") + f"\nalpha{i}", "en", "s", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    kept = P.keep_one_of_each_group(spark, docs, "")
    assert kept.count() == 60


def test_pipeline_cuts_keep_white_space(spark):
    """What the mix takes of a document stands in it as it is, line breaks and indentation included."""
    import corpus_pipeline as P
    texts = {i: "".join(f"line {i} {j}\n  indented {j}\t" for j in range(400)) for i in range(12)}
    docs = spark.createDataFrame([(i, t, "en", "abc"[i % 3], len(t)) for i, t in texts.items()], DOCS)
    got = P.mix_sources(spark, docs, "").collect()
    assert got and all(r["text"].rstrip() in texts[r["doc_id"]] for r in got)
    assert any(len(r["text"].split()) < len(texts[r["doc_id"]].split()) for r in got)


@pytest.mark.parametrize("n", [5, 10_000])
def test_line_dedup_fields_at_any_size(spark, n):
    """A field whose values come back in a large corpus stays a field."""
    line = "Posted by user {} in {} on our community board for all members today"
    name = lambda i, k: k + "".join(chr(97 + i // 26 ** j % 26) for j in range(2))
    pairs = [(i * 7919 % 40_000) for i in range(n)]
    docs = spark.createDataFrame([(i, line.format(name(p // 200, "u"), name(p % 200, "c"))) for i, p in enumerate(pairs)],
                                 "doc_id long, text string")
    hits = {r["doc_id"]: r["lines"] for r in line_dedup.recurring_lines(docs).collect()}
    assert hits == {i: [0] for i in range(1, n)}


def test_line_dedup_fields_beside_other_templates(spark):
    """Templates that share a leaf are told apart, and each keeps its fields."""
    word = lambda i: "w" + chr(97 + i // 26) + chr(97 + i % 26)
    docs = [(t * 100 + i, f"posted by user {word(i)} about " + " ".join(f"{word(t)}{k}" for k in "abcde") + f" on {word(i * 7 % 100)} again today")
            for t in range(20) for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    hits = {r["doc_id"]: r["lines"] for r in line_dedup.recurring_lines(df).collect()}
    assert hits == {d: [0] for d, _ in docs if d % 100}


def test_line_dedup_passages_without_long_lines(spark):
    """Text without blanks, other white space, and a passage set in short lines recur from two documents on."""
    own = lambda d: f"{'abc'[d] * 5} own opening\n"
    verse = "the rose is red today\nthe violet is blue\n\nand here the verse now ends\nso\nbe it\n"
    han = "春天的花园里有许多美丽的花朵和蝴蝶在阳光下飞舞着二十种颜色第{}章\n"
    tabs = "one\ttwo\tthree\tfour\tfive\tsix\tseven\teight\tnumber {}\n"
    docs = spark.createDataFrame([(0, own(0) + verse + han.format(1) + tabs.format(1)), (1, own(1) + verse + han.format(22)),
                                  (2, own(2) + "the rose is red today\nelse\nso\n" + tabs.format(3))], "doc_id long, text string")
    hits = {r["doc_id"]: r["lines"] for r in line_dedup.recurring_lines(docs).collect()}
    assert hits == {1: [1, 2, 4, 5, 6, 7], 2: [4]}
    assert {r["doc_id"]: r["lines"] for r in line_dedup.recurring_lines(docs.unionAll(docs)).collect()} == hits


def test_line_dedup_narrow_wrapping(spark):
    """Long lines do not end a passage of many words in short lines."""
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(90)]
    wrapped, at = [], 0
    while at < len(words):
        wrapped.append(" ".join(words[at:at + (8 if len(wrapped) % 3 == 1 else 7)]))
        at += len(wrapped[-1].split())
    docs = spark.createDataFrame([(d, f"{'abc'[d] * 6} opens\n" + "\n".join(wrapped)) for d in range(3)], "doc_id long, text string")
    hits = {r["doc_id"]: r["lines"] for r in line_dedup.recurring_lines(docs).collect()}
    assert hits == {d: list(range(1, len(wrapped) + 1)) for d in (1, 2)}


def test_language_id_learns_every_language(spark):
    """More labelled languages than 64, the rarest and those without ids too."""
    letters = "abcdefghijklmnopqrstuvwx"
    word = lambda k: letters[k % 24] + letters[(k // 24 * 7 + k + 3) % 24] + letters[(k * 5 + 1) % 24]
    docs = [(None if k == 69 else 100 * k + i, f"{word(k)} " * (30 + i), f"l{k:02d}") for k in range(70) for i in range(4 if k > 63 else 6)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    net = language_id.fit(df)
    assert net.languages == sorted({d[2] for d in docs})
    got = language_id.identify(df, net, carry=("lang",)).collect()
    rare = [r for r in got if r["carry_lang"] > "l63"]
    assert len(rare) == 24 and sum(r["lang_pred"] == r["carry_lang"] for r in rare) >= 22
