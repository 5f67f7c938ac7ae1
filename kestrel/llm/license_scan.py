"""License scan by ordered signature rules.

Every whole text is normalised to words (runs of digits, ``a-z`` with ``A-Z``
lower-cased, and characters beyond ASCII) joined by single blanks.  The rules
of ``license_rules`` are regexes over that string, each gated by a keyword: a
rule runs only where its keyword occurs, and a keyword is looked up once per
text.  Detections are intervals of words.  Overlaps are resolved by priority
and containment: a detection that lies inside another one of the same or a
stronger class (or equals an earlier rule's) is suppressed, so ``lesser
general public license`` does not count as ``general public license``, and
the standard notice of a licence hides the names in it.

Beside them stand the base phrases: all places where a phrase's words stand
consecutively.  Base labels are never suppressed.  A document's score is
``1 - prod(1 - weight)`` over its distinct labels, each with its strongest
detection's weight (0 without any label).

One pass over the texts without a shuffle; the working set is one text.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_cache
from .license_rules import CLASSES, rules

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BASE_WEIGHT = CLASSES["family"]
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def whole_words(pattern: str) -> re.Pattern:
    return re.compile(rb"(?<![^ ])(?:" + pattern.encode() + rb")(?![^ ])")


class Scanner:
    """Compiled rules and phrases."""

    def __init__(self, signatures, base):
        kinds = list(CLASSES)
        self.labels = [s[1] for s in signatures]
        self.weights = [CLASSES[s[0]] for s in signatures]
        self.strength = [len(kinds) - kinds.index(s[0]) for s in signatures]
        self.levels = len(kinds) + 1
        self.by_keyword: dict[bytes, list] = {}
        for i, s in enumerate(signatures):
            self.by_keyword.setdefault(s[2].encode(), []).append((i, whole_words(s[3])))
        self.base = [(p.encode(), whole_words(p), label) for p, label in base.items()]

    def detections(self, text: bytes) -> list[tuple[int, int, int]]:
        """``(start, end, rule)`` in bytes of every match of every rule."""
        return [(m.start(), m.end(), i) for keyword, gated in self.by_keyword.items() if keyword in text
                for i, pattern in gated for m in pattern.finditer(text)]

    def surviving(self, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Without those inside one of the same or a stronger class: in order
        of start, the furthest end reached so far by each class decides."""
        reach = [-1] * self.levels
        out = []
        for s, e, i in sorted(found, key=lambda d: (d[0], -d[1], -self.strength[d[2]], d[2])):
            level = self.strength[i]
            if max(reach[level:]) < e:
                out.append((s, e, i))
                reach[level] = e
        return out

    def scan(self, raw: bytes | None):
        """``(n_words, base, labels, detections, score)`` of one text; ``base``
        holds ``(first word, label)``, a detection ``(first word, words, rule)``."""
        words = (raw or b"").translate(_WORDS).split()
        if not words:
            return 0, [], [], [], 0.0
        text = b" ".join(words)
        base = [(m.start(), label) for phrase, pattern, label in self.base if phrase in text for m in pattern.finditer(text)]
        kept = self.surviving(self.detections(text))
        if not base and not kept:
            return len(words), [], [], [], 0.0
        starts = (np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)).tolist()   # of the next word
        place = lambda at: bisect_left(starts, at + 1)                # noqa: E731
        weights: dict[str, float] = {}
        for label, w in [*((label, BASE_WEIGHT) for _, label in base), *((self.labels[i], self.weights[i]) for _, _, i in kept)]:
            weights[label] = max(w, weights.get(label, 0.0))
        score = 1.0 - float(np.prod([1.0 - weights[x] for x in sorted(weights)]))
        return (len(words), sorted((place(s), label) for s, label in base), sorted(weights),
                [(place(s), text.count(b" ", s, e) + 1, i) for s, e, i in kept], score)


_DETECTION = pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("label", pa.string()), ("rule", pa.int32())]))
_SCHEMA = pa.schema([("n_words", pa.int64()), ("base_starts", pa.list_(pa.int64())), ("base_labels", pa.list_(pa.string())),
                     ("labels", pa.list_(pa.string())), ("detections", _DETECTION), ("score", pa.float64())])
_TYPES = ("n_words bigint, base_starts array<bigint>, base_labels array<string>, labels array<string>, "
          "detections array<struct<first_word:bigint,n_words:bigint,label:string,rule:int>>, score double")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", signatures=None, base: dict[str, str] | None = None) -> DataFrame:
    """``(doc_id, n_words, base_starts, base_labels, labels, detections,
    score)`` for every row of ``docs``.

    ``base_starts`` are the first words (from 0) of all places of the base
    phrases, ``base_labels`` their distinct labels, ``labels`` these and the
    labels of the surviving detections, sorted; ``rule`` numbers the rules in
    their order.  Null and empty texts have no words, no labels and score 0;
    repeated rows get equal results, null ids are kept, an empty table gives
    an empty result.  Other columns are not read."""
    signatures, base = list(signatures or rules()), dict(base or BASE)

    def run(batches):
        scanner = worker_cache("license_scanner" + str(hash((tuple(signatures), tuple(base.items())))), lambda: Scanner(signatures, base))
        for b in batches:
            found = [scanner.scan(t.as_py()) for t in b.column(1)]
            rows = [(n, [p for p, _ in at], sorted({x for _, x in at}), labels,
                     [{"first_word": f, "n_words": m, "label": scanner.labels[i], "rule": i} for f, m, i in kept], score)
                    for n, at, labels, kept, score in found]
            columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_SCHEMA)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", *_SCHEMA.names])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")) \
               .mapInArrow(run, f"doc_id bigint, {_TYPES}")
