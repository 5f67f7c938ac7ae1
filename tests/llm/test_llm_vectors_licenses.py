"""Whitening, hard negatives and license scan: brute force and edge cases."""

import re

import hypothesis.strategies as st
import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kestrel.llm import hard_negatives as H
from kestrel.llm import license_scan as L
from kestrel.llm import whitening as W
from kestrel.llm.license_rules import CLASSES, rules
from kestrel.llm.queries import QUERIES

VECTORS = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.5], None), (5, None, 1),
           (6, [0.0, 0.0], 1), (7, [1.0, float("nan")], 1), (8, [1.0, None], 1), (9, [], 1), (10, [1.0, 0.1, 0.0], 1),
           (None, [1.0, 0.75], 1), (11, [1e200, 1.0], 1), (12, [float("-inf"), 0.0], 3), (13, [1.5, 0.0], 2)]


@pytest.fixture(scope="module")
def vectors(spark):
    df = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>, label int")
    for c in ("x", "n", "q", "place", "anchor", "score", "block", "kind"):
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3)


# ----------------------------------------------------------------- whitening

def reference(x):
    """Fit list, sums, covariance and eigenpairs by NumPy."""
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    centred = (u - s // n) - (s % n) / n
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    return n, s, cov, e[::-1], q[:, ::-1]


def test_op11_whitening(spark):
    table = pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pylist()
    table = [r for r in table if r["embedding"] and np.isfinite(np.array(r["embedding"], dtype=float)).all()]
    x = np.floor(64 * np.array([r["embedding"] for r in table], dtype=np.float64)).astype(np.int64) + 1_000_000
    n, s, cov, e, q = reference(x)
    got = QUERIES["op11_whitening"](spark, SF_SMALL).toPandas().sort_values(["vec_id", "component"])
    k = min(16, int((e > 1e-12 * e[0]).sum()))
    assert len(got) == len(table) * k and set(got.n) == {n}
    order = np.argsort([r["vec_id"] for r in table], kind="stable")
    assert (got.deviation.to_numpy().reshape(-1, k)[:, 0] == ((n * x - s) ** 2).sum(axis=1)[order]).all()
    mine = got.whitened.to_numpy().reshape(-1, k)
    want = ((x - s / n) @ q[:, :k] / np.sqrt(e[:k]))[order]
    assert np.abs(mine * np.sign((mine * want).sum(axis=0)) - want).max() < 1e-6
    assert np.allclose(got.explained.to_numpy().reshape(-1, k)[0], e[:k] / np.trace(cov), rtol=1e-9)
    assert got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1


@pytest.mark.parametrize("spectrum", ["flat", "steep", "ties", "low rank"])
def test_eigenpairs(spectrum):
    """The filter against dense eigenvectors, with a block smaller than the space."""
    d, k = 120, 16
    e = {"flat": np.linspace(1.05, 0.95, d), "steep": 10.0 ** -np.linspace(0, 8, d), "ties": np.repeat([5.0, 3.0, 1.0], 40),
         "low rank": np.concatenate((np.linspace(9, 1, 10), np.zeros(d - 10)))}[spectrum]
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((d, d)))[0]
    cov = (q * e) @ q.T
    values, vectors, residual = W.eigenpairs(lambda b: cov @ b, d, k)
    assert len(values) == (10 if spectrum == "low rank" else k)
    assert np.allclose(values, e[:len(values)], rtol=1e-12) and residual <= W.FLOOR
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.linalg.norm(cov @ vectors - vectors * values, axis=0).max() < 1e-12 * e[0]


def test_chebyshev_filter():
    """Eigenvectors are scaled by T_m at their place, relative to T_m at the top."""
    e = np.linspace(0.0, 2.0, 9)
    out = W.chebyshev_filter(lambda b: e[:, None] * b, np.eye(9), np.diag(e), 0.25, 1.25, 2.0, 6)
    t = np.polynomial.chebyshev.Chebyshev.basis(6)
    assert np.allclose(np.diagonal(out), t((e - 0.75) / 0.5) / t((2.0 - 0.75) / 0.5), atol=1e-12)


def test_whitening_edges(spark, vectors):
    grid = W.on_grid(vectors)
    rows = grid.collect()
    assert sorted((r["vec_id"] or 0, len(r["x"])) for r in rows) == [(0, 2), (1, 2), (2, 2), (2, 2), (3, 2), (4, 2), (6, 2), (11, 2), (13, 2)]
    assert {r["vec_id"]: r["x"][0] for r in rows}[11] == (1 << 60) + 1_000_000
    model = W.fit(grid, components=2)
    assert model.n == 7                                            # [1, 0] and [2, 0] once each
    xs = sorted({tuple(r["x"]) for r in rows})
    got = W.whiten(grid, model).collect()
    assert model.sums == [sum(x[i] for x in xs) for i in range(2)]
    exact = {tuple(r["x"]): sum((7 * v - s) ** 2 for v, s in zip(r["x"], model.sums)) for r in rows}
    by_id = {r["vec_id"]: tuple(r["x"]) for r in rows}
    for r in got:                                                  # 1e200 makes numbers beyond a long, still exact
        assert int(r["deviation"]) == exact[by_id[r["vec_id"]]]
    assert {r["component"] for r in got} == {1} and len(got) == 9  # the second direction vanishes beside the first
    none = W.on_grid(vectors.limit(0))
    assert W.whiten(none, W.fit(none)).collect() == []
    same = W.on_grid(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [])], "vec_id long, embedding array<double>"))
    assert W.fit(same).n == 1 and W.whiten(same, W.fit(same)).collect() == []
    blank = W.on_grid(spark.createDataFrame([(1, []), (2, None)], "vec_id long, embedding array<double>"))
    assert W.whiten(blank, W.fit(blank)).collect() == []


# ------------------------------------------------------------ hard negatives

@given(st.integers(1, 90), st.integers(0, 90), st.integers(1, 90), st.integers(1, 40), st.integers(0, 2 ** 32 - 1))
@settings(max_examples=40, deadline=None)
def test_strassen(m, k, n, leaf, seed):
    rng = np.random.default_rng(seed)
    top = int(rng.choice([3, 1 << 20, 1 << 26]))
    a, b = rng.integers(-top, top, (m, k)), rng.integers(-top, top, (k, n))
    assert (H.strassen(a, b, leaf) == a @ b).all()


def test_strassen_wraps_on_the_way():
    """Sums of large entries wrap inside, the product is still exact."""
    rng = np.random.default_rng(5)
    a = rng.integers((1 << 62) - 9, 1 << 62, (64, 64))
    b = np.eye(64, dtype=np.int64)
    assert (H.strassen(a, b, 4) == a).all()


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-3, 3), st.integers(0, 9)), max_size=60), st.integers(1, 4))
def test_heaps_merge(entries, k):
    """Merging heaps of pieces gives the heap of the whole."""
    cols = lambda rows: [np.array([r[i] for r in rows], dtype=np.int64) for i in range(3)]          # noqa: E731
    rows = lambda heap: list(zip(*(c.tolist() for c in heap)))                                      # noqa: E731
    whole = rows(H.best_of(*cols(entries), k))
    parts = [rows(H.best_of(*cols(entries[i::3]), k)) for i in range(3)]
    assert rows(H.best_of(*cols([r for p in parts for r in p]), k)) == whole
    assert whole == [r for o in range(4) for r in sorted((e for e in entries if e[0] == o), key=lambda e: (-e[1], e[2]))[:k]]


def mined(table, is_anchor, positives=5, negatives=3):
    """Brute force over ``(id, q, label)`` rows."""
    dot = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b))                                   # noqa: E731
    out = []
    for i, (aid, a, la) in enumerate(table):
        if not is_anchor(aid):
            continue
        score = lambda rows: sorted(((-dot(a, q), oid) for oid, q in rows))                         # noqa: E731
        others = [r for r in table if r[0] != aid and len(r[1]) == len(a)]
        for p, pid in score([(o, q) for o, q, lab in others if lab == la])[:positives]:
            hits = [(s, n) for s, n in score([(o, q) for o, q, lab in others if lab != la]) if 50 * -p <= 100 * -s <= 95 * -p]
            out += [(aid, pid, r + 1, n, -p, -s) for r, (s, n) in enumerate(hits[:negatives])]
    return sorted(out)


def test_hard_negatives_blocks_and_parts(spark, monkeypatch):
    """Many blocks and parts, copies, ties and a hot label give the answer of brute force."""
    rng = np.random.default_rng(8)
    base = rng.integers(-4, 5, (60, 6))
    table = [(i % 430, base[rng.integers(60)], int(rng.choice([0, 0, 0, 1, 2, 77 + i % 9]))) for i in range(450)]
    table += [(1000 + i, np.ones(5), i % 2) for i in range(8)]
    df = spark.createDataFrame([(i, [float(v) / 256 for v in q], lab) for i, q, lab in table], "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(H, "BLOCK_ROWS", 40)
    monkeypatch.setattr(H, "PART_ROWS", 7)
    got = H.mine(df.repartition(5), F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(table, lambda i: i % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 200


def test_hard_negatives_edges(vectors):
    got = sorted(tuple(r) for r in H.mine(vectors, F.col("vec_id").isin(1, 3, 5, 6, 7, 9), scale=2.0).collect())
    table = [(1, [2, 0], 1), (2, [4, 0], 1), (2, [4, 0], 1), (3, [2, 0], 2), (6, [0, 0], 1), (9, [], 1), (10, [2, 0, 0], 1), (13, [3, 0], 2)]
    assert got == mined(table, lambda i: i in (1, 3, 6, 9)) and got
    assert H.mine(vectors.limit(0), F.col("vec_id") > 0).collect() == []
    assert H.mine(vectors, F.lit(None).cast("boolean")).collect() == []


# -------------------------------------------------------------- license scan

PHRASE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_places(text):
    words = PHRASE_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(i, label) for phrase, label in L.BASE.items() for p in [phrase.split()]
             for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return len(words), sorted(found)


def suppressed(found, scanner):
    """Containment pair by pair."""
    inside = lambda a, b: b[0] <= a[0] and a[1] <= b[1]                                             # noqa: E731
    beats = lambda b, a: scanner.strength[b[2]] > scanner.strength[a[2]] or \
        scanner.strength[b[2]] == scanner.strength[a[2]] and ((b[0], b[1]) != (a[0], a[1]) or b[2] < a[2])
    return sorted(a for a in found if not any(b is not a and inside(a, b) and beats(b, a) for b in found))


SAMPLES = [
    "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
    "SPDX-License-Identifier: GPL-2.0-or-later", "cc by cc by CC\nBY mit license-MIT LICENSE ", "GNU Lesser General Public License v2.1",
    "https://www.apache.org/licenses/LICENSE-2.0 Apache License, Version 2.0", "dual-licensed (MIT License OR Apache-2.0); all rights reserved",
    "mit der Lizenz, ganz ohne GPL", "cc byx xcc by", "ÀMIT license mit license  apache  license", "", None,
    "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
    "Foundation; either version 2 of the License, or (at your option) any later version."]


def test_op13_license_scan(spark):
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}
    got = {r["doc_id"]: r for r in QUERIES["op13_license_scan"](spark, SF_SMALL).collect()}
    assert set(got) == set(docs)
    for d, text in docs.items():
        n, found = base_places(text)
        r, labels = got[d], {x for _, x in found}
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (n, len(found), ",".join(sorted(labels)))
        assert (r["first_word"], r["last_word"]) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert labels <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    assert any(r["labels"] for r in got.values()) and sum(not r["labels"] for r in got.values()) > len(got) // 2


def test_license_samples(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*SAMPLES, " ".join(SAMPLES[:9]) * 3000])], "doc_id long, text string")
    for c in ("n_words", "labels", "score", "base_starts"):
        df = df.withColumn(c, F.lit("clash"))
    got = {r["doc_id"]: r for r in L.scan(df.unionAll(df.limit(1)).repartition(2)).collect()}
    scanner = L.Scanner(rules(), L.BASE)
    for i, text in enumerate(SAMPLES):
        n, found = base_places(text)
        r = got[i]
        assert r["n_words"] == n and r["base_starts"] == [p for p, _ in found] and r["base_labels"] == sorted({x for _, x in found})
        joined = b" ".join((text or "").encode().translate(L._WORDS).split())
        every = [(m.start(), m.end(), k) for k, s in enumerate(rules()) for m in L.whole_words(s[3]).finditer(joined)]
        assert sorted(scanner.detections(joined)) == sorted(every)              # the prefilter loses nothing
        assert sorted(scanner.surviving(every)) == suppressed(every, scanner)
    assert got[0]["labels"] == ["cc-by", "cc-by-nc"] and got[1]["labels"] == ["gpl", "gpl-3.0", "notice"]
    assert got[2]["labels"] == ["gpl-2.0-or-later"] and got[4]["labels"] == ["lgpl-2.1"]
    assert got[7]["labels"] == ["gpl"] and got[7]["base_labels"] == [] and got[8]["labels"] == []
    assert got[12]["labels"] == ["gpl", "gpl-2.0-or-later"]
    assert got[10]["score"] == got[11]["score"] == 0.0 and got[len(SAMPLES)]["n_words"] > 200_000
    assert L.scan(df.limit(0)).collect() == []


def test_every_match_holds_its_keyword():
    """The keyword of a rule is part of whatever its regex matches."""
    signatures = rules()
    assert len(signatures) > 200 and {s[0] for s in signatures} == set(CLASSES)

    @given(st.data())
    @settings(max_examples=4, deadline=None, database=None, suppress_health_check=list(HealthCheck))
    def check(data):
        for _, _, keyword, pattern in signatures:
            assert keyword in data.draw(st.from_regex(re.compile(pattern, re.ASCII), fullmatch=True))

    check()
    short = re.compile(r"\(\?:([^()|]*)\)\?")
    for _, _, keyword, pattern in signatures:                    # and of what is left without its optional groups
        bare = pattern
        while short.search(bare):
            bare = short.sub("", bare)
        assert keyword in bare or "|" in bare or "?" in bare, (keyword, bare)
