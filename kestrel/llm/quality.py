"""Quality score by regularised quadratic discriminant analysis.

Every text becomes a vector of transformed document statistics (logs of
counts, log-odds of shares).  ``describe`` computes the vectors once, so labels are joined to
vectors and not to texts.  Training is one pass: the count, sum and product
sum of the vectors of each class, added up per task and then per class, so
the number of labelled documents is not limited.  Each class has a
Gaussian with its own mean and a covariance shrunk towards the pooled one and
towards its diagonal; the Cholesky factors are computed once and travel with
the scoring function.  The score is the logistic of the difference of the two
log densities (Mahalanobis terms and log determinants) and the log prior
odds, divided by a fixed temperature that keeps scores off 0 and 1.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATISTICS = ("words", "word_length", "long_words", "distinct_words", "adjacent_repeats", "upper", "symbols", "digits",
              "marks", "sentence_length", "words_per_line", "repeated_lines", "capital_words", "symbol_words", "short_lines")
_KINDS = bytes.maketrans(bytes(range(256)), bytes(
    ord("U") if 65 <= c <= 90 else ord("l") if 97 <= c <= 122 or c >= 128 else ord("d") if 48 <= c <= 57 else
    ord(" ") if c in (32, 9, 10, 11, 12, 13) else ord("p") if c in b".,;:'\"()-" else ord("m") if c in b"!?" else ord("s")
    for c in range(256)))


def _odds(part: float, whole: float) -> float:
    return float(np.log((part + 0.5) / (whole - part + 0.5))) if whole >= part else 0.0


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text; a null text is empty."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    kinds = raw.translate(_KINDS)
    chars = max(1, len(raw) - kinds.count(b" "))
    words = text.split()
    n = len(words)
    lower = [w.lower() for w in words]
    lines = [x for x in text.split("\n") if x.strip()]
    ends = kinds.count(b"m") + text.count(".")
    # the distinct-word share falls with length for any text: compare with a power law
    distinct = float(np.log((len(set(lower)) + 1.0) / (n + 1.0) ** 0.8))
    repeats = sum(a == b for a, b in zip(lower, lower[1:]))
    capitals = len(re.findall(r"(?<!\S)[^\Wa-z\d_]{2,}(?!\w)", text)) if kinds.count(b"U") * 10 > chars else 0
    dressed = sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,;:!?'\")")
    return [float(np.log(n + 1.0)), float(np.log((len(raw) - kinds.count(b" ") + 1.0) / (n + 1.0))),
            _odds(sum(len(w) > 16 for w in words), n), distinct, _odds(repeats, max(n - 1, repeats)),
            _odds(kinds.count(b"U"), chars), _odds(kinds.count(b"s"), chars), _odds(kinds.count(b"d"), chars),
            _odds(kinds.count(b"m"), chars), float(np.log((n + 1.0) / (ends + 1.0))),
            float(np.log((n + 1.0) / (len(lines) + 1.0))), _odds(len(lines) - len(set(lines)), max(1, len(lines))),
            _odds(min(capitals, n), n), _odds(dressed, n), _odds(sum(len(x) < 30 for x in lines), max(1, len(lines)))]


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors, log determinants and log priors of the two classes."""
    centre: np.ndarray
    spread: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    logdets: np.ndarray
    priors: np.ndarray
    temperature: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.spread, -8.0, 8.0)
        logs = []
        for c in (0, 1):
            y = (z - self.means[c]) @ self.factors[c].T       # whitened: |y|^2 is the Mahalanobis distance
            logs.append(self.priors[c] - 0.5 * (self.logdets[c] + np.einsum("ij,ij->i", y, y)))
        d = np.clip((logs[1] - logs[0]) / self.temperature, -30.0, 30.0)
        return 1.0 / (1.0 + np.exp(-d))


def from_moments(count: np.ndarray, total: np.ndarray, product: np.ndarray, shrink: float, pooled: float,
                 temperature: float) -> Discriminant:
    """Fit from per-class counts, sums and product sums (classes 0 and 1)."""
    dim = total.shape[1]
    if (count <= 0).any():                     # a class without examples: the prior decides
        prior = np.log((count + 0.5) / (count.sum() + 1.0))
        flat = np.zeros((2, dim))
        return Discriminant(np.zeros(dim), np.ones(dim), flat, np.zeros((2, dim, dim)), np.zeros(2), prior, 1.0)
    n = count.sum()
    centre = total.sum(axis=0) / n
    spread = np.sqrt(np.maximum(np.diagonal(product.sum(axis=0)) / n - centre ** 2, 1e-6))
    means = (total / count[:, None] - centre) / spread
    covs = np.stack([(product[c] / count[c] - np.outer(total[c], total[c]) / count[c] ** 2) / np.outer(spread, spread)
                     for c in (0, 1)])
    within = (covs * count[:, None, None]).sum(axis=0) / n
    factors, logdets = [], []
    for c in (0, 1):
        s = (1 - pooled) * covs[c] + pooled * within
        s = (1 - shrink) * s + shrink * np.diag(np.diagonal(s)) + 1e-3 * np.eye(dim)
        low = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(low))
        logdets.append(2 * np.log(np.diagonal(low)).sum())
    return Discriminant(centre, spread, means, np.stack(factors), np.array(logdets), np.log(count / n), temperature)


def _features(texts) -> np.ndarray:
    return np.array([statistics(t.as_py()) for t in texts], dtype=np.float64).reshape(-1, len(STATISTICS))


def describe(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str | None = None) -> DataFrame:
    """``(doc_id, x[, label])`` for every row of ``docs``: ``x`` holds the
    ``STATISTICS`` of the whole text, a null text counting as empty.  Null ids
    and repeated rows are kept; other columns are not read."""
    d = len(STATISTICS)

    def run(batches):
        for b in batches:
            flat = pa.array(_features(b.column(1)).ravel(), pa.float64())
            x = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * d, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([b.column(0), x, *b.columns[2:]], names=names)

    names = ["doc_id", "x", *(["label"] if label else [])]
    more = [F.col(label).cast("int").alias("label")] if label else []
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), *more) \
               .mapInArrow(run, "doc_id bigint, x array<double>" + (", label int" if label else ""))


def _vectors(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def fit(labelled: DataFrame, text: str = "text", label: str = "label", **options) -> Discriminant:
    """``fit_described`` on the texts of ``labelled``."""
    rows = labelled.filter(F.col(label).isin(0, 1)).withColumn("_id", F.lit(None).cast("bigint"))
    return fit_described(describe(rows, "_id", text, label), **options)


def fit_described(described: DataFrame, shrink: float = 0.3, pooled: float = 0.3,
                  temperature: float = 2.0) -> Discriminant:
    """Fit on every row ``(x, label)`` whose label is 0 or 1 (other and null
    labels are ignored).  No labelled rows, or rows of one class only, give a
    model whose score is the smoothed share of class 1."""
    d = len(STATISTICS)

    def moments(batches):
        count, total, product = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for b in batches:
            x, y = _vectors(b.column(0)), b.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                part = x[y == c]
                count[c] += len(part)
                total[c] += part.sum(axis=0)
                product[c] += part.T @ part
        flat = [np.concatenate(([count[c]], total[c], product[c].ravel())) for c in (0, 1)]
        size = len(flat[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], size), pa.int32()), pa.array(np.tile(np.arange(size), 2), pa.int32()),
             pa.array(np.concatenate(flat))], names=["label", "at", "value"])

    rows = described.select("x", F.col("label").cast("int").alias("label")).filter("label IN (0, 1)")
    sums = rows.mapInArrow(moments, "label int, at int, value double").groupBy("label", "at").agg(F.sum("value").alias("value"))
    flat = np.zeros((2, 1 + d + d * d))
    for r in sums.collect():                   # a fixed 2 (1 + d + d^2) numbers, whatever the corpus
        flat[r["label"], r["at"]] = r["value"]
    return from_moments(flat[:, 0], flat[:, 1:1 + d], flat[:, 1 + d:].reshape(2, d, d), shrink, pooled, temperature)


def score(docs: DataFrame, model: Discriminant, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score)`` for every row of ``docs``: the model's probability
    of class 1 for the whole text.  Null texts are scored as empty ones;
    repeated rows get equal scores; null ids are kept.  Other columns are not
    read."""
    return score_described(describe(docs, doc_id, text), model)


def score_described(described: DataFrame, model: Discriminant) -> DataFrame:
    """``(doc_id, score)`` for every row of a described table."""
    def run(batches):
        for b in batches:
            s = model.scores(_vectors(b.column(1))) if b.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])
    return described.select("doc_id", "x").mapInArrow(run, "doc_id bigint, score double")
