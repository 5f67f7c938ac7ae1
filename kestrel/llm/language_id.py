"""Language identification by a byte convolutional network.

A window of ``LENGTH`` bytes is embedded, passed through one-dimensional
filters of several widths, a rectifier and a maximum over the window, and
classified by a softmax.  The network is trained in numpy on a bounded sample
of labelled documents (``per_language`` windows of every language, chosen by
a hash of the id); training texts are
also cut short at random, so that short texts are learned too.  Whole texts
are then cut into fixed-length windows that are classified in batches; the
probabilities of a text are the mean of its windows', weighted by their
bytes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from .common import materialize, release_worker_cache

LENGTH = 256
WIDTHS = (3, 4, 5)
EMBED = 8
FILTERS = 16
STEPS_FOR = 64                  # languages that the steps of `fit` are meant for
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(k, LENGTH)`` windows that cover all bytes, the last one padded with
    zeros, and the number of bytes in each."""
    k = max(1, -(-len(raw) // LENGTH))
    buf = np.zeros(k * LENGTH, dtype=np.uint8)
    buf[:len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    weight = np.full(k, LENGTH, dtype=np.float64)
    weight[-1] = len(raw) - (k - 1) * LENGTH
    return buf.reshape(k, LENGTH), weight


@dataclass
class ByteNetwork:
    """Parameters: byte embedding, one filter bank per width, softmax layer."""
    languages: list[str]
    embed: np.ndarray
    filters: list[np.ndarray] = field(default_factory=list)
    bias: list[np.ndarray] = field(default_factory=list)
    dense: np.ndarray | None = None
    shift: np.ndarray | None = None

    @classmethod
    def fresh(cls, languages: list[str], rng) -> "ByteNetwork":
        net = cls(languages, (rng.standard_normal((256, EMBED)) * 0.3).astype(np.float32))
        for w in WIDTHS:
            net.filters.append((rng.standard_normal((w, EMBED, FILTERS)) / np.sqrt(w * EMBED)).astype(np.float32))
            net.bias.append(np.zeros(FILTERS, dtype=np.float32))
        net.dense = (rng.standard_normal((FILTERS * len(WIDTHS), len(languages))) * 0.1).astype(np.float32)
        net.shift = np.zeros(len(languages), dtype=np.float32)
        return net

    def pooled(self, x: np.ndarray):
        """Maximum of every filter over each window, and where it lies."""
        e = self.embed[x]
        tops, places = [], []
        for w, f, b in zip(WIDTHS, self.filters, self.bias):
            n = x.shape[1] - w + 1
            out = sum(e[:, o:o + n] @ f[o] for o in range(w)) + b
            at = out.argmax(axis=1)
            tops.append(np.take_along_axis(out, at[:, None], axis=1)[:, 0])
            places.append(at)
        return np.concatenate(tops, axis=1), places, e

    def train_step(self, x: np.ndarray, y: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(parameter, gradient) pairs of the mean cross-entropy of a batch."""
        top, places, e = self.pooled(x)
        act = np.maximum(top, 0)
        p = _softmax(act @ self.dense + self.shift)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        grads = [(self.dense, act.T @ p), (self.shift, p.sum(axis=0))]
        back = (p @ self.dense.T) * (top > 0)
        ge = np.zeros_like(self.embed)
        rows = np.arange(len(x))[:, None]
        for k, (w, f, b) in enumerate(zip(WIDTHS, self.filters, self.bias)):
            d = back[:, k * FILTERS:(k + 1) * FILTERS]
            gf = np.empty_like(f)
            for o in range(w):
                at = places[k] + o
                gf[o] = np.einsum("bf,bfe->ef", d, e[rows, at])
                np.add.at(ge, x[rows, at], d[:, :, None] * f[o].T[None])
            grads += [(f, gf), (b, d.sum(axis=0))]
        grads.append((self.embed, ge))
        return grads

    def probabilities(self, x: np.ndarray, batch: int = 64) -> np.ndarray:
        """Class probabilities of windows ``(k, LENGTH)``; all widths run as
        one matrix product over the widest patch."""
        wide = max(WIDTHS)
        n = LENGTH - min(WIDTHS) + 1
        kernel = np.zeros((wide * EMBED, FILTERS * len(WIDTHS)), dtype=np.float32)
        for k, (w, f) in enumerate(zip(WIDTHS, self.filters)):
            kernel[:w * EMBED, k * FILTERS:(k + 1) * FILTERS] = f.reshape(w * EMBED, FILTERS)
        bias = np.concatenate(self.bias)
        out = np.empty((len(x), len(self.languages)), dtype=np.float64)
        for s in range(0, len(x), batch):
            part = x[s:s + batch]
            e = np.zeros((len(part), LENGTH + wide, EMBED), dtype=np.float32)
            e[:, :LENGTH] = self.embed[part]
            flat = np.lib.stride_tricks.as_strided(
                e, (len(part), n, wide * EMBED), (e.strides[0], e.strides[1], e.strides[2]))
            conv = np.matmul(flat.reshape(-1, wide * EMBED), kernel).reshape(len(part), n, -1)
            top = np.empty((len(part), kernel.shape[1]), dtype=np.float32)
            for k, w in enumerate(WIDTHS):
                c = slice(k * FILTERS, (k + 1) * FILTERS)
                top[:, c] = conv[:, :LENGTH - w + 1, c].max(axis=1)
            out[s:s + batch] = _softmax(np.maximum(top + bias, 0) @ self.dense + self.shift)
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score of one whole text."""
        return self.predict_all([text])[0]

    def predict_all(self, texts, group: int = 512) -> list[tuple[str, float]]:
        """Languages and scores of whole texts; windows of several texts are
        classified together, about ``group`` at a time, so a text of any
        length needs no more than that."""
        total = np.zeros((len(texts), len(self.languages)))
        held, owner, weight, size = [], [], [], 0

        def flush():
            p = self.probabilities(np.concatenate(held)) * np.concatenate(weight)[:, None]
            np.add.at(total, np.concatenate(owner), p)
            held.clear(), owner.clear(), weight.clear()

        known = [bool(t) and _LETTER.search(t) is not None and bool(self.languages) for t in texts]
        for i, t in enumerate(texts):
            if not known[i]:
                continue
            x, w = windows(t.encode("utf-8", "replace"))
            for s in range(0, len(x), group):
                held.append(x[s:s + group])
                weight.append(w[s:s + group])
                owner.append(np.full(len(held[-1]), i))
                size += len(held[-1])
                if size >= group:
                    flush()
                    size = 0
        if held:
            flush()
        out = []
        for i in range(len(texts)):
            if not known[i]:
                out.append((UNKNOWN, 0.0))
                continue
            p = total[i] / total[i].sum()
            out.append((self.languages[int(p.argmax())], float(min(1.0, p.max()))))
        return out


def train(samples: list[tuple[str, bytes]], steps: int = 600, batch: int = 64, rate: float = 0.01,
          seed: int = 11) -> ByteNetwork:
    """Train on ``(language, window bytes)`` samples with Adam; languages are
    drawn equally often.  No samples give a network without languages."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _ in samples})
    net = ByteNetwork.fresh(languages, rng)
    if len(languages) < 2:
        return net
    by = {lang: [] for lang in languages}
    for k, w in samples:
        by[k].append(w)
    params = None
    for step in range(1, steps + 1):
        x = np.zeros((batch, LENGTH), dtype=np.uint8)
        y = rng.integers(0, len(languages), batch)
        for i, c in enumerate(y):
            w = by[languages[c]][rng.integers(len(by[languages[c]]))]
            if rng.random() < 0.4 and len(w) > 24:          # short pieces, anywhere in the window
                size = int(rng.integers(12, len(w)))
                at = int(rng.integers(0, len(w) - size + 1))
                w = w[at:at + size]
            x[i, :len(w)] = np.frombuffer(w, dtype=np.uint8)
        grads = net.train_step(x, y)
        if params is None:
            params = [(p, np.zeros_like(p), np.zeros_like(p)) for p, _ in grads]
        lr = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for (p, m, v), (_, g) in zip(params, grads):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= lr * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-7)
    return net


def training_windows(docs: DataFrame, doc_id: str, text: str, lang: str, per_language: int) -> list[tuple[str, bytes]]:
    """About ``per_language`` windows of every language (8 times that at most),
    at most 4 from a document, at places spread over the whole text."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                       F.col(lang).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL AND text != ''")
    shares = materialize(rows.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(per_language / 2) / F.count(F.lit(1))).alias("share")), "shares")
    # documents without an id are told apart by their text
    point = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text")), F.lit(7)), F.lit(1_000_000)) / 1_000_000.0
    some = rows.join(broadcast_if_small(shares), "lang").filter(point < F.col("share")).select("doc_id", "text", "lang")

    def cut(batches):
        for b in batches:
            langs, ids, parts = [], [], []
            for i, t, k in zip(*(b.column(c).to_pylist() for c in range(3))):
                raw = t.encode("utf-8", "replace")
                if _LETTER.search(t) is None:
                    continue
                rng = np.random.default_rng([7, abs(i or 0)])
                spare = max(0, len(raw) - LENGTH)
                for s in sorted({int(s) for s in rng.integers(0, spare + 1, 4)}):
                    langs.append(k)
                    ids.append(i)
                    parts.append(raw[s:s + LENGTH])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(parts, pa.binary())],
                                             names=["doc_id", "lang", "part"])

    turn = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "part"))
    got = some.mapInArrow(cut, "doc_id bigint, lang string, part binary") \
              .withColumn("_turn", F.row_number().over(turn)).filter(F.col("_turn") <= 8 * per_language).drop("_turn").collect()
    got = sorted((r["lang"], r["doc_id"] or 0, bytes(r["part"])) for r in got)
    return [(lang, part) for lang, _, part in got]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = 1500, steps: int = 600, seed: int = 11) -> ByteNetwork:
    """Train on a bounded sample of the rows of ``docs`` with a language and a
    text with a letter.  Every language is learned; the bound is
    ``per_language`` windows (in the mean) of each.  With more than
    ``STEPS_FOR`` languages there are more steps in proportion, so that each
    is seen as often."""
    samples = training_windows(docs, doc_id, text, lang, per_language)
    return train(samples, steps=-(-steps * max(STEPS_FOR, len({k for k, _ in samples})) // STEPS_FOR), seed=seed)


def identify(docs: DataFrame, net: ByteNetwork, doc_id: str = "doc_id", text: str = "text",
             carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row of ``docs``, and the
    columns named in ``carry`` as ``carry_<name>``.

    Null and empty texts and texts without a letter are ``und`` with score 0;
    so is every text if the network knows no language.  Repeated rows get
    equal answers; null ids are kept.  Other columns are not read."""
    keep = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                       *[F.col(c).alias(f"carry_{c}") for c in carry])
    rest = keep.schema.fields[2:]

    def run(batches):
        release_worker_cache()
        for b in batches:
            found = [f for s in range(0, b.num_rows, 500) for f in net.predict_all(b.column(1).slice(s, 500).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 *[b.column(2 + i) for i in range(len(rest))]],
                names=["doc_id", "lang_pred", "score", *[f.name for f in rest]])

    schema = "doc_id bigint, lang_pred string, score double" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rest)
    return keep.mapInArrow(run, schema)
