"""Every training-data query on a whole small table, against brute force."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from conftest import SF_SMALL
from pyspark.sql import functions as F
from kestrel.llm import language_id, line_dedup, ngram_join, packing, url_filter
from kestrel.llm.queries import BYTE_TOKENIZER, QUERIES, URL_RULES, WORD_TOKENIZER, tokenizer_path

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def rows(name):
    return pq.read_table(f"{SF_SMALL}/{name}.parquet").to_pylist()


def shingles(text):
    w = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def cosine_links(table, threshold=0.93):
    by = defaultdict(list)
    for r in table:
        v = r["embedding"]
        if r["label"] is not None and v and None not in v and np.isfinite(v).all() and any(v):
            by[r["label"]].append((r["vec_id"], np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float))))
    return [(a, b) for group in by.values() for i, (a, u) in enumerate(group)
            for b, v in group[i + 1:] if u @ v >= threshold]


def test_op1_embedding_dedup(spark):
    table = rows("embeddings")
    links = cosine_links(table)
    comp = components([r["vec_id"] for r in table], links)
    got = {r["vec_id"]: r for r in QUERIES["op1_embedding_dedup"](spark, SF_SMALL).collect()}
    assert len(got) == len(table)
    for v, r in got.items():
        assert r["n_links"] == sum(v in p for p in links)
        assert r["component_id"] == comp[v] and r["kept"] == (comp[v] == v)


def test_op2_ngram_join(spark):
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows("documents")}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    comp = components(ids, links)
    got = QUERIES["op2_ngram_join"](spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {d: (len(sets[d]), comp[d]) for d in ids}


def test_op3_mixing(spark):
    docs = rows("documents")
    size = {r["doc_id"]: len(WORD.findall((r["text"] or "").encode())) for r in docs}
    total = defaultdict(int)
    for r in docs:
        total[r["source"]] += size[r["doc_id"]]
    names = sorted(total)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    stopped, level = set(), 0.0
    while True:
        level = (sum(total.values()) - sum(3 * total[s] for s in stopped)) / sum(weight[s] for s in names if s not in stopped)
        new = {s for s in names if s not in stopped and level * weight[s] > 3 * total[s]}
        if not new:
            break
        stopped |= new
    target = {s: 3.0 * total[s] if s in stopped else level * weight[s] for s in names}
    got = QUERIES["op3_mixing"](spark, SF_SMALL).collect()
    again = QUERIES["op3_mixing"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    source = {r["doc_id"]: r["source"] for r in docs}
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[s] and 0 <= r["taken"] <= 3 * r["size"]
        assert r["target"] == pytest.approx(target[s])
    assert all(taken[s] == pytest.approx(target[s], rel=0.02) for s in names)


def line_keys(docs, depth=3, long_tokens=8, min_constant=0.7, min_masked=0.5):
    """Template key of every line, in plain Python."""
    lines = []
    for d, text in docs:
        for pos, raw in enumerate((text or "").split("\n")):
            line = raw.strip(" \t\r\f\x0b")
            if line:
                masked = ["<*>" if re.search("[0-9]", t) else t for t in line.split(" ")]
                lines.append((d, pos, line, tuple(masked), (len(masked), tuple(masked[:depth]))))
    forms = defaultdict(set)
    for _, _, _, m, leaf in lines:
        if len(m) >= long_tokens:
            forms[leaf].add(m)
    out = {}
    for d, pos, line, m, leaf in lines:
        key = None
        if len(m) >= long_tokens and len(forms[leaf]) > 1:
            t = [x if x != "<*>" and (i < depth or sum(f[i] == x for f in forms[leaf]) > 1) else "<*>" for i, x in enumerate(m)]
            if sum(x != "<*>" for x in t) >= min_constant * len(m):
                key = ("leaf", leaf, tuple(t))
        if key is None:
            key = ("masked", m) if sum(x != "<*>" for x in m) >= min_masked * len(m) else ("raw", line)
        out[d, pos] = (key, len(m) >= long_tokens)
    return out


def expected_drops(docs):
    keys = line_keys(docs)
    where = defaultdict(set)
    for (d, _), (key, _) in keys.items():
        where[key].add(d)
    drops = defaultdict(list)
    for (d, pos), (key, long) in keys.items():
        if len(where[key]) >= (2 if long else 10) and d > min(where[key]):
            drops[d].append(pos)
    return {d: sorted(p) for d, p in drops.items()}


def test_op4_line_dedup(spark):
    docs = [(r["doc_id"], r["text"]) for r in rows("documents")]
    want = expected_drops(docs)
    got = {r["doc_id"]: r for r in QUERIES["op4_line_dedup"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for d, text in docs:
        lines, drop = text.split("\n"), want.get(d, [])
        kept = "\n".join(x for i, x in enumerate(lines) if i not in drop)
        assert got[d]["dropped"] == ",".join(map(str, drop)) and got[d]["n_lines"] == len(lines)
        assert got[d]["n_dropped"] == len(drop) and got[d]["kept_chars"] == len(kept)


def test_op4_variable_fields(spark):
    """Lines that differ in numbers or in one rare token share a template."""
    base = "the meeting of the {} board was held in room {} of the old house"
    docs = [(i, f"own text number one for document {chr(97 + i) * 9} stays here always\n" + base.format(w, n))
            for i, (w, n) in enumerate([("first", 1), ("second", 22), ("third", 3), ("first", 44)])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["lines"] for r in line_dedup.recurring_lines(df).collect()}
    assert got == expected_drops(docs)
    assert all(1 in got[d] for d in (1, 2, 3)) and 0 not in got


def test_op5_url_filter(spark):
    def parse(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host):]).group()

    def rule(host, path):
        fits = [r for r in URL_RULES if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0]))
                and path.startswith("/" + r.partition("/")[2])]
        return max(fits, key=len, default=None)

    pages = {r["page_id"]: parse(r["url"]) for r in rows("pages")}
    got = QUERIES["op5_url_filter"](spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        want = rule(*pages[r["page_id"]])
        assert (r["host"], r["path"]) == pages[r["page_id"]] and r["rule"] == want
        assert r["verdict"] == (URL_RULES[want] if want else "allow")


def test_op4_cuts_a_text_once(spark):
    """Not once per line: the cut text is a column, so the function of ``transform`` holds no ``split``."""
    docs = spark.createDataFrame([(1, "a 1\n\nb\nc 2"), (2, "x\ny"), (3, None), (4, "z")], "doc_id long, text string")
    hits = spark.createDataFrame([(1, [0, 2]), (4, [0])], "doc_id long, lines array<int>")
    left = line_dedup.drop_lines(docs, hits)
    assert left._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {1: "\nc 2", 2: "x\ny", 3: None, 4: ""}
    assert left.columns == docs.columns


def test_op4_parses_lines_with_and_without_fields(spark):
    """Masked texts are cut only where they differ; wide blanks count as blanks."""
    docs = spark.createDataFrame([(1, "one two 33 four\n\nno field here"), (2, "no field here"), (3, "no\u3000field\xa0here"),
                                  (4, "gr\xf6\xdfer\u2003no  field"), (5, None)], "doc_id long, text string")
    got = {(r["doc_id"], r["pos"]): r for r in line_dedup._parsed(docs, 3, 1).collect()}
    assert {k: (r["n"], r["n_var"], r["masked"]) for k, r in got.items()} == {
        (1, 0): (4, 1, "one two <*> four"), (1, 2): (3, 0, "no field here"), (2, 0): (3, 0, "no field here"),
        (3, 0): (3, 0, "no field here"), (4, 0): (3, 0, "gr\xf6\xdfer no field")}
    assert len({(got[k]["raw"], got[k]["form"], got[k]["leaf"]) for k in ((1, 2), (2, 0), (3, 0))}) == 1
    plan = line_dedup._parsed(docs, 3, 8)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"isnotnull\(masked#\d+\) THEN split\(masked", plan)) == 1


def test_op4_query_sends_no_texts_to_its_last_join(spark, tmp_path):
    """The figures of a text, not the text, are exchanged for the join with the places; they count empty and open lines."""
    rows = [(1, "a\n\nb"), (2, ""), (3, None), (4, "x\n"), (None, "y"), (1, "a\n\nb")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op4_line_dedup"](spark, str(tmp_path))
    got = sorted(tuple(r) for r in out.select(F.coalesce("doc_id", F.lit(0)), "n_lines", "n_dropped", "dropped", F.coalesce("kept_chars", F.lit(-1))).collect())
    assert got == [(0, 1, 0, "", 1), (1, 3, 0, "", 4), (1, 3, 0, "", 4), (2, 1, 0, "", 0), (3, 0, 0, "", -1), (4, 2, 0, "", 2)]
    plan = out._jdf.queryExecution().optimizedPlan()
    joins = [plan]
    while "Join" not in joins[-1].nodeName():
        joins.append(joins[-1].children().apply(0))
    assert "text" not in [a.name() for a in [joins[-1].left().output().apply(i) for i in range(joins[-1].left().output().size())]]


def test_op5_templates_learn_from_rules(spark):
    """A host's template is rejected by its blocked examples only where it has some."""
    urls = [(i, f"http://a.org/shop/{i}/buy") for i in range(20)] + [(100 + i, f"http://a.org/news/{i}") for i in range(20)]
    urls += [(200 + i, f"http://b.org/x/offer{i}.html?id=1") for i in range(20)] + [(300 + i, f"http://b.org/x/{i}/y") for i in range(4)]
    df = spark.createDataFrame(urls, "page_id long, url string")
    rules = {f"a.org/shop/{i}/": "block" for i in range(15)} | {f"b.org/x/offer{i}.html": "block" for i in range(15)}
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(df, rules).collect()}
    assert all(got[i] == "block" for i in range(20)) and all(got[100 + i] == "allow" for i in range(20))
    assert all(got[200 + i] == "block" for i in range(20)) and all(got[300 + i] == "allow" for i in range(4))


def test_op6_quality(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    got = {r["doc_id"]: r for r in QUERIES["op6_quality"](spark, sf).collect()}
    assert len(got) == 1000
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [got[d]["predicted"] == q for d, q in labels.items() if got[d]["held_out"]]
    assert np.mean(held) > 0.95


def test_op7_language_id(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    lang = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    got = {r["doc_id"]: r for r in QUERIES["op7_language_id"](spark, sf).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = [got[d]["lang_pred"] == lang[d] for d in lang if got[d]["held_out"]]
    assert len(got) == len(lang) and np.mean(held) > 0.98


def test_op7_gradients():
    rng = np.random.default_rng(0)
    net = language_id.ByteNetwork.fresh(["a", "b", "c"], rng)
    x, y = rng.integers(0, 256, (4, 40)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        p = language_id._softmax(np.maximum(net.pooled(x)[0], 0) @ net.dense + net.shift)
        return -np.log(p[np.arange(4), y]).mean()

    for param, grad in net.train_step(x, y):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        keep, eps = param[at], 1e-3
        param[at] = keep + eps
        up = loss()
        param[at] = keep - eps
        down = loss()
        param[at] = keep
        assert (up - down) / (2 * eps) == pytest.approx(grad[at], rel=0.1, abs=1e-4)


def ids_of(name, end, docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path(name))
    tok.encode_special_tokens = True
    return {r["doc_id"]: np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [end], dtype="<u4") for r in docs}


def test_op8_packing(spark):
    ids = ids_of(WORD_TOKENIZER, 1, rows("documents"))
    got = QUERIES["op8_packing"](spark, SF_SMALL).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for d, parts in pieces.items():
        parts.sort(key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in parts] == \
            [(i, s, min(4096, len(ids[d]) - s)) for i, s in enumerate(range(0, len(ids[d]), 4096))]
        assert all(r["ids_crc32"] == zlib.crc32(ids[d][r["start"]:r["start"] + r["length"]].tobytes()) for r in parts)
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 4096
    least = -(-sum(map(len, ids.values())) // 4096)
    assert len(bins) <= least + 1


def test_minimum_bin_slack_finds_fullest():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = sorted(set(rng.integers(1, 30, 6).tolist()), reverse=True)
        counts = np.zeros(31, dtype=np.int64)
        counts[lengths] = rng.integers(1, 4, len(lengths))
        room = int(rng.integers(1, 60))
        sums = {0}
        for l in lengths:
            sums = {s + l * k for s in sums for k in range(counts[l] + 1)}
        use = packing.fullest(lengths, counts, room)
        assert sum(l * u for l, u in use.items()) == max(s for s in sums if s <= room)
        assert all(u <= counts[l] for l, u in use.items())


def test_op9_token_files(spark, scratch):
    from kestrel.llm import token_files
    docs = rows("documents")
    ids = ids_of(BYTE_TOKENIZER, 2, docs)
    start, want = 0, {}
    for d in sorted(ids):
        want[d] = (start, len(ids[d]), zlib.crc32(ids[d].tobytes()))
        start += len(ids[d])
    got = QUERIES["op9_token_files"](spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want
    # several shards: the same starts, ids in order, and files as documented
    path = f"{scratch}/tokens"
    token_files.write_tokens(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), path, tokenizer_path(BYTE_TOKENIZER), shards=3)
    assert {r["doc_id"]: (r["start"], r["n_tokens"]) for r in token_files.read_metadata(spark, path).collect()} == \
        {d: w[:2] for d, w in want.items()}
    part = token_files.read_tokens(spark, path, 20, 24).collect()
    assert {r["doc_id"]: r["ids"] for r in part} == {d: ids[d].tolist() for d in range(20, 25)}
    import glob
    files = glob.glob(f"{path}/tokens/*.parquet")
    assert len(files) == 3
    meta = pq.ParquetFile(files[0]).metadata.row_group(0)
    cols = {meta.column(i).path_in_schema.split(".")[0]: meta.column(i) for i in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in cols["ids"].encodings and "DELTA_BINARY_PACKED" in cols["doc_id"].encodings
    assert all(c.has_offset_index for c in cols.values())


def test_encoder_equals_library():
    from tokenizers import Tokenizer
    from kestrel.llm.tokens import Encoder
    texts = ["", " ", "  two  blanks ", "a b", "tab\tand\nline\n\nend ", "it's we'll  can't", "é ́x Ünï code wide",
             "<|endoftext|> x <|startoftext|>", "1 22 333,4.5", "mixed   runs \n of \r\n blanks", "汉字 かな", "\x1c a \x85 b", "'s 're",
             "Plain Run, next.\nLine 2 Größe a1b22 &&& x###", "ÀÖØ ×÷ ªº µ\xad", "a\xa0b c\u3000d\x1fe", "Σ ΑΣ İI", "a\n\nb \nc\n d"]
    rng = np.random.default_rng(5)
    signs = list("abcdeEÀßÿ×'s.,!#0123 \n\t") + [" ", " ", "\xa0", "\x85", "\x1c", "\u0301", "\u0130", "\u03a3", "'LL"]
    texts += ["".join(rng.choice(signs, size=rng.integers(1, 40))) for _ in range(3000)]
    for name in (WORD_TOKENIZER, BYTE_TOKENIZER):
        tok = Tokenizer.from_file(tokenizer_path(name))
        tok.encode_special_tokens = True
        enc = Encoder(open(tokenizer_path(name), encoding="utf-8").read())
        for _ in range(2):                      # from the library, then from the cache
            got = [np.frombuffer(b, dtype="<u4").tolist() for b in enc.encode(texts)]
            assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_asks_for_runs_once():
    """New words of known runs, and words met again, are not asked for."""
    from kestrel.llm.tokens import Encoder
    asked = []

    class Counting(Encoder):
        def _ask(self, tok, new, words):
            asked.extend(new)
            super()._ask(tok, new, words)
    for name, want in ((WORD_TOKENIZER, ["one", ",", " two", "!", " one"]), (BYTE_TOKENIZER, ["one", ",", " two", "!", " one"])):
        enc = Counting(open(tokenizer_path(name), encoding="utf-8").read())
        enc.encode(["one, two!", "one! two, one", None])
        enc.encode(["one! two,", ""])
        assert sorted(asked) == sorted(want)
        asked.clear()


def test_encoder_keeps_words_met_again_when_it_is_full(monkeypatch):
    """Beyond ``CACHE`` pieces those of one call alone are forgotten."""
    from kestrel.llm import tokens
    from tokenizers import Tokenizer
    asked = []

    class Counting(tokens.Encoder):
        def _ask(self, tok, new, words):
            asked.extend(new)
            super()._ask(tok, new, words)
    monkeypatch.setattr(tokens, "CACHE", 8)
    for name in (WORD_TOKENIZER, BYTE_TOKENIZER):
        tok = Tokenizer.from_file(tokenizer_path(name))
        enc = Counting(open(tokenizer_path(name), encoding="utf-8").read())
        texts = [f"often größer {x} it's" for x in ("a", "b", "c d e f", "g h i j", "k l m n")]
        for t in texts:
            assert np.frombuffer(enc.encode([t])[0], dtype="<u4").tolist() == tok.encode(t, add_special_tokens=False).ids
        assert len(asked) == len(set(asked)) and len(enc.known) < 12
        many = "1 2 3 4 5 6 7 8 9 :"
        for _ in range(3):                      # more pieces met again than it may keep
            assert np.frombuffer(enc.encode([many])[0], dtype="<u4").tolist() == tok.encode(many, add_special_tokens=False).ids
        asked.clear()


def test_op9_files_have_no_null_ids(spark, scratch):
    """The elements of the lists are required: nothing is written or read for their absence."""
    from kestrel.llm import token_files
    path = f"{scratch}/required"
    token_files.write_tokens(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), path, tokenizer_path(BYTE_TOKENIZER), shards=1)
    import glob
    file = pq.ParquetFile(glob.glob(f"{path}/tokens/*.parquet")[0])
    assert not file.schema_arrow.field("ids").type.value_field.nullable
    assert [r["ids"][-1] for r in token_files.read_tokens(spark, path).collect()] == [2, 2]


def test_encoder_loads_the_vocabulary_again_only_for_added_tokens():
    from tokenizers import Tokenizer
    from kestrel.llm.tokens import Encoder
    enc = Encoder(open(tokenizer_path(WORD_TOKENIZER), encoding="utf-8").read(), added=True)
    enc.encode(["plain words, 12", None])
    assert enc.whole is None
    text = "a <|endoftext|> b"
    assert np.frombuffer(enc.encode([text])[0], dtype="<u4").tolist() == \
        Tokenizer.from_file(tokenizer_path(WORD_TOKENIZER)).encode(text, add_special_tokens=False).ids


def test_packing_holds_few_texts_at_a_time(spark, scratch, monkeypatch):
    """Texts reach Python in batches of a few MB and the encoder in calls of a
    million characters; the session's setting is as before."""
    from kestrel.llm import tokens
    log = f"{scratch}/sizes"

    def noted(batch, column):
        for at, texts in tokens.slices(batch, column):
            with open(log, "a") as f:
                f.write(f"{batch.nbytes} {sum(map(len, texts))} {len(texts)}\n")
            yield at, texts
    monkeypatch.setattr(packing, "slices", noted)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(400, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("abcd "), 10_000).alias("text"))
    got = packing.pack_documents(docs, tokenizer_path(WORD_TOKENIZER))
    assert got.groupBy("doc_id").agg(F.sum("length").alias("n")).distinct().count() == 400
    assert spark.conf.get(key) == before
    sizes = [tuple(map(int, x.split())) for x in open(log)]
    assert sum(n for _, _, n in sizes) == 400
    assert max(b for b, _, _ in sizes) < 8 << 20 and max(c for _, c, _ in sizes) <= 1_000_000


def test_pipeline_packing_keeps_few_pieces(spark, scratch, monkeypatch):
    """600,000 different words: a worker keeps the ids of a bounded part."""
    import corpus_pipeline as P
    import sys
    from kestrel.llm import tokens
    log = f"{scratch}/known"

    def noted(batch, column):
        for at, texts in tokens.slices(batch, column):
            yield at, texts
            held = [e for e in vars(sys.modules["_kestrel_worker_cache"]).values() if hasattr(e, "known")]
            with open(log, "a") as f:
                f.write(f"{len(texts)} {len(held)} {sum(len(e.known) for e in held)}\n")
    monkeypatch.setattr(packing, "slices", noted)
    words = F.transform(F.sequence(F.lit(0), F.lit(9_999)), lambda x: F.translate((F.col("id") * 10_000 + x + 1_000_000).cast("string"),
                                                                                  "0123456789", "abcdefghij"))
    docs = spark.range(60, numPartitions=1).select(F.col("id").alias("doc_id"), F.array_join(words, " ").alias("text"))
    got = P.pack_sequences(spark, docs, "")
    assert got.select("doc_id").distinct().count() == 60
    seen = [tuple(map(int, x.split())) for x in open(log)]
    assert sum(n for n, _, _ in seen) == 60 and {k for _, k, _ in seen} == {1}
    assert max(known for _, _, known in seen) < 330_000       # 200,000 and those of one call


def test_a_new_encoder_takes_the_place_of_others():
    """A worker holds one vocabulary, not those of earlier operators too."""
    import sys
    from types import SimpleNamespace
    from kestrel.llm import common, tokens
    common.release_worker_cache()
    common.worker_cache("earlier", lambda: "held")
    try:
        for name in (WORD_TOKENIZER, BYTE_TOKENIZER):
            json = SimpleNamespace(value=open(tokenizer_path(name), encoding="utf-8").read())
            enc = tokens.shared_encoder(json)
            assert tokens.shared_encoder(json) is enc
            assert [v for k, v in vars(sys.modules["_kestrel_worker_cache"]).items() if not k.startswith("__")] == [enc]
    finally:
        common.release_worker_cache()


def test_pipeline_joins_in_small_batches(spark, monkeypatch):
    """The n-gram stage's jobs send texts to Python a few MB at a time; the
    session's setting is as before."""
    import corpus_pipeline as P
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(key)
    join = P.ngram_join.jaccard_components
    monkeypatch.setattr(P.ngram_join, "jaccard_components", lambda docs: seen.append(int(spark.conf.get(key).rstrip("b"))) or join(docs))
    words = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, words, "en", "a", 1), (2, words, "en", "a", 1), (3, "other words", "en", "a", 1), (None, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = P.keep_one_of_each_group(spark, docs, "")
    assert seen and max(seen) <= 4 << 20 and spark.conf.get(key) == before
    assert sorted((r["doc_id"] or 0) for r in got.collect()) == [0, 1, 3]


@pytest.mark.parametrize("name", [WORD_TOKENIZER, BYTE_TOKENIZER])
def test_tokens_equal_the_default_call(spark, name, scratch):
    """Strings of added tokens get the ids of the library's default call."""
    from kestrel.llm import token_files
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path(name))
    texts = ["a b <|endoftext|> c", "<|startoftext|>x <|ENDOFTEXT|>", "plain  text", "", None, "x<|endoftext|>\n<|endoftext|> y", "<|endoftext |>",
             "a &lt;|endoftext|&gt; b", "Größe <|EndOfText|>"]
    want = {i: tok.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packed = {r["doc_id"]: r for r in packing.pack_documents(docs, tokenizer_path(name)).collect()}
    for d, ids in want.items():
        assert packed[d]["length"] == len(ids) + 1
    path = f"{scratch}/tokens"
    token_files.write_tokens(docs, path, tokenizer_path(name))
    assert {r["doc_id"]: r["ids"][:-1] for r in token_files.read_tokens(spark, path).collect()} == want


def test_op10_recall(spark):
    table = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in rows("embeddings")}
    ids = np.array(sorted(table))
    x = np.stack([table[i] for i in ids])
    got = defaultdict(list)
    for r in QUERIES["op10_ann"](spark, SF_SMALL).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in table if i % 20 == 0}
    hits = []
    for q, found in got.items():
        s = x @ table[q]
        best = [i for i in ids[np.lexsort((ids, -s))] if i != q][:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in [f[1] for f in found]
        assert all(f[2] == pytest.approx(table[q] @ table[f[1]]) for f in found)
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        hits.append(len({f[1] for f in found} & set(best)) / 20)
    assert np.mean(hits) >= 0.9


def test_op10_recall_of_the_index():
    """Windows and collisions alone, on a block where most vectors are no candidates."""
    from kestrel.llm.ann import BlockIndex
    rng = np.random.default_rng(2)
    x = rng.standard_normal((6000, 32)) * rng.uniform(0.5, 2, (6000, 1))
    q = rng.standard_normal((40, 32))
    index = BlockIndex(np.arange(6000), x, float(np.linalg.norm(x, axis=1).max()), 64, 29)
    qid, vid, score = index.search(np.arange(-40, 0), q, 20, 0.8, 0.1, 5)
    hits = [len(set(vid[qid == i - 40]) & set(np.argsort(-(x @ q[i]))[:20])) / 20 for i in range(40)]
    assert np.mean(hits) >= 0.9


def test_sketches_pass_every_linked_pair():
    rng = np.random.default_rng(3)
    linked = passed = 0
    for _ in range(400):
        n = int(rng.integers(1, 500))
        a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        new = rng.integers(0, 2 ** 63, int(rng.integers(0, n // 2 + 1))).astype(np.uint64)
        b = np.unique(np.concatenate([a[int(rng.integers(0, n // 2 + 1)):], new]))
        both = len(np.intersect1d(a, b))
        found, edges = ngram_join.close_sketches(np.array([1, 2]), np.array([1, 2]), np.array([len(a), len(b)]), np.array([0, 0]),
                                                 [ngram_join.parity_sketch(x) for x in (a, b)], 75, 100)
        near = 100 * both >= 75 * (len(a) + len(b) - both)
        assert not near or (found == {(1, 1), (2, 2)} and [sorted(e) for e in edges] == [[1, 2]])
        linked, passed = linked + near, passed + bool(found)
    assert 0 < linked <= passed < 2 * linked < 400


def test_sketches_of_unlike_sizes_do_not_pass():
    """A small set's few cells are less than the bits that a large set may differ in; the sizes rule the pair out."""
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 2 ** 63, n).astype(np.uint64) for n in (13, 60, 3000)]
    keys, sizes = np.arange(3), np.array([13, 60, 3000])
    assert ngram_join.close_sketches(keys, keys, sizes, np.zeros(3, dtype=int), [ngram_join.parity_sketch(s) for s in sets], 75, 100) == (set(), [])


@pytest.mark.parametrize("block", [2, 8, 4096])
def test_shared_passages_do_not_link(spark, monkeypatch, block):
    """Texts around a common passage share buckets; only the near copies among them link, whether sets meet by bucket
    or by blocks of their cluster."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 8)
    monkeypatch.setattr(ngram_join, "SKETCH_SETS", block)
    rng = np.random.default_rng(5)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 50_000, n)]
    passage = word(60)
    texts = [" ".join(word(20) + passage + word(25)) for _ in range(60)]
    texts += [" ".join(t.split()[:-1] + word(1)) for t in texts[:20]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(docs).collect()}
    assert got == {i: i - 60 if i >= 60 else i for i in range(80)}


def test_part_enum_never_misses():
    rng = np.random.default_rng(3)
    for t in range(600):
        u = int(rng.integers(1, 60)) if t % 3 else int(rng.integers(1, 900))
        pool = rng.integers(0, 2 ** 63, u, dtype=np.int64).view(np.uint64)
        both = -(-75 * u // 100)
        cut = both + int(rng.integers(0, u - both + 1))
        a, b = np.unique(pool[:cut]), np.unique(np.concatenate([pool[:both], pool[cut:]]))
        assert len(np.intersect1d(ngram_join.signatures(a), ngram_join.signatures(b)))


def test_hot_group_of_near_copies(spark):
    """Blocks of a few sets: large components, mixed blocks and links across blocks."""
    rng = np.random.default_rng(4)
    texts = []
    for base in range(3):
        words = [f"w{base}x{i}" for i in range(80)]
        for _ in range(40):
            w = list(words)
            for i in rng.integers(0, 80, int(rng.integers(0, 5))):
                w[i] = f"z{rng.integers(10 ** 6)}"
            texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
             if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = components(range(len(sets)), links)
    keep = ngram_join.BLOCK_SETS, ngram_join.BLOCK_FEATURES
    ngram_join.BLOCK_SETS, ngram_join.BLOCK_FEATURES = 16, 1 << 11
    try:
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(df).collect()}
    finally:
        ngram_join.BLOCK_SETS, ngram_join.BLOCK_FEATURES = keep
    assert got == want


def test_embedding_cells_and_blocks(spark):
    """Many cells, tables and blocks give the links of one block."""
    from kestrel.llm.embedding_dedup import near_duplicates
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((150, 16))
    table = []
    for i in range(600):
        v = centres[i % 150] + 0.12 * rng.standard_normal(16) * (i % 4)
        table.append({"vec_id": i, "embedding": v.tolist(), "label": 1})
    df = spark.createDataFrame([(r["vec_id"], r["embedding"], 1) for r in table], "vec_id long, embedding array<double>, label int")
    links = cosine_links(table)
    got = near_duplicates(df, cell_rows=100, block_rows=32).collect()
    found = sum(r["n_links"] for r in got) / 2
    assert 0.98 * len(links) <= found <= len(links)


def test_pipeline(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    tables, cur = [], docs
    for _, stage in P.STAGES:
        cur = spark.createDataFrame(stage(spark, cur, SF_SMALL).toArrow())
        tables.append(cur)
    lang, lines, joined, mixed, packed = (t.toPandas() for t in tables)
    whole = docs.toPandas()
    assert all(list(t.columns) == list(P.COLUMNS) for t in (lang, lines, joined, mixed))
    assert set(lang.doc_id) <= set(whole.doc_id) and len(lang) > 0.95 * len(whole)
    drops = expected_drops(list(zip(lang.doc_id, lang.text)))
    for d, t in zip(lang.doc_id, lang.text):
        kept = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in drops.get(d, []))
        now = lines[lines.doc_id == d]
        assert (list(now.text) == [kept]) if kept.strip() or not t.strip() else now.empty
    sets = {d: shingles(t) for d, t in zip(lines.doc_id, lines.text)}
    ids = sorted(sets)
    comp = components(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
                            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])])
    assert sorted(joined.doc_id) == [d for d in ids if comp[d] == d]
    assert set(mixed.doc_id) <= set(joined.doc_id)
    words = lambda t: len(WORD.findall(t.encode()))
    size = {d: words(t) for d, t in zip(joined.doc_id, joined.text)}
    taken = mixed.assign(n=mixed.text.map(words)).groupby("doc_id").n.sum()
    assert all(taken[d] <= 3 * size[d] for d in taken.index)
    assert sum(taken) == pytest.approx(sum(size.values()), rel=0.02)
    assert packed.length.sum() == sum(map(len, ids_of(WORD_TOKENIZER, 1, [{"doc_id": i, "text": t} for i, t in enumerate(mixed.text)]).values()))
