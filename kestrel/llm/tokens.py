"""Encoding whole texts with the ``tokenizers`` library inside tasks.

Both vocabularies cut a text at a blank between two other characters before
any merge is made, so the ids of a text are the ids of its stretches in order,
each from such a blank on (the vocabulary that drops white space is cut
before all of it).  A stretch of plain characters (ASCII, accented Latin-1
letters, no apostrophe) is cut further into the runs that the vocabulary's own
first step makes of it (letters, digits, other signs, line breaks).  The texts
of a call are cut together, byte by byte in numpy, and Arrow numbers the
distinct pieces, so Python sees each distinct one once a call.  Each worker
process keeps the ids of pieces it has met (at most ``CACHE``, or what the
operator asks for, and those of one call); when these are too many, it forgets
those that one call alone has met.

For new runs the library's merge model is asked, which skips the library's
general normalising and splitting.  Any other stretch, and every stretch of a
vocabulary whose first step is not one of the two known ones (``_plan``),
goes through the whole library.

A text that holds the string of an added token (``<|endoftext|>``) is encoded
whole by the library's default call, which gives the string that token's id.
"""

from __future__ import annotations

import json as json_lib
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from .common import release_buffers, release_memory, release_worker_cache, worker_cache

CACHE = 600_000
_ASCII_SPACE = "\t\n\x0b\f\r "
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGN = r'!-&(-/:-@\[-`{-~'                         # ASCII signs without the apostrophe
# kinds of bytes; white space is where a stretch starts, all else is not plain
_OTHER, _LETTERS, _DIGIT, _SIGNS, _LINE, _SPACE = range(6)
_KINDS = np.array([_LETTERS if c.isalpha() else _DIGIT if c.isdigit() else _LINE if c == "\n" else _SPACE if c in _ASCII_SPACE
                   else _SIGNS if "!" <= c <= "~" and c != "'" else _OTHER for c in map(chr, range(128))] + [_OTHER] * 128, dtype=np.uint8)

# The first step of the word-end vocabulary, as its file states it.
_WORD_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _plan(spec: dict) -> str | None:
    """``word`` (lower case, white space dropped, single digits), ``byte``
    (runs with the blank before them) or None (not known here)."""
    norm, pre, model = spec.get("normalizer"), spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    if model.get("type") != "BPE" or model.get("dropout") or model.get("byte_fallback") or spec.get("post_processor"):
        return None
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"):
        return "byte"
    steps = pre.get("pretokenizers") or []
    if norm and [n.get("type") for n in norm.get("normalizers") or []] == _WORD_NORMALIZER and len(steps) == 2 \
            and steps[0].get("pattern") == {"Regex": _WORD_SPLIT} and steps[0].get("invert") and steps[0].get("behavior") == "Removed" \
            and steps[1].get("type") == "ByteLevel" and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space"):
        return "word"
    return None


class Encoder:
    """Little-endian unsigned 32-bit ids of whole texts.  With ``added`` the
    strings of added tokens get their own ids, as the library has it by
    default; without, they are ordinary text.  ``cache`` bounds the pieces
    kept (``CACHE``): some 200 bytes each."""

    def __init__(self, json: str, added: bool = False, cache: int | None = None):
        from tokenizers import Tokenizer, pre_tokenizers
        self.cache = CACHE if cache is None else cache
        self.tok = Tokenizer.from_str(json)
        self.tok.encode_special_tokens = True       # stretches hold none; whole texts with one go to `whole`
        self.json, self.whole, self.has_added = json, None, None
        spec = json_lib.loads(json)
        tokens = [t for t in spec.get("added_tokens") or [] if t.get("content")]
        if added and tokens:
            exact = [t["content"] for t in tokens if not t.get("normalized")]
            # the others are looked for in the normalized text, so any text may hold them
            self.has_added = (lambda t: any(c in t for c in exact)) if len(exact) == len(tokens) else (lambda t: True)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.plan = _plan(spec)
        self._forget()
        self.merges = Tokenizer(self.tok.model)     # no normalizer, no first step
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in (10, 32, *range(0xC0, 0x100))}
        digits = "[0-9]" if self.plan == "word" else " ?[0-9]+"
        blank = "" if self.plan == "word" else " ?"
        line = "" if self.plan == "word" else r"|\n"
        self.is_run = re.compile(rf"{blank}[{_LETTER}]+|{digits}|{blank}[{_SIGN}]+{line}").fullmatch

    def _forget(self) -> None:
        """Start with nothing known."""
        self.known: dict[str, int] = {}             # run or stretch, with the white space before it -> number, from 0 in order
        self.ends = np.zeros(1024, dtype=np.int64)  # the ids of number k are those from ends[k] to ends[k + 1]
        self.ids = np.empty(4096, dtype="<u4")
        self.again = np.zeros(1024, dtype=bool)     # whether a later call met the piece

    def _keep(self, words: list[str], ids: np.ndarray, sizes) -> None:
        """``words`` are known from now on: their ids, one word's after the other."""
        n, held = len(self.known), int(self.ends[len(self.known)])
        while len(self.ends) <= n + len(words):
            self.ends, self.again = (np.append(x, np.zeros_like(x)) for x in (self.ends, self.again))
        while len(self.ids) < held + len(ids):
            self.ids = np.append(self.ids, np.empty_like(self.ids))
        self.known.update(zip(words, range(n, n + len(words))))
        self.ends[n + 1:n + 1 + len(words)] = held + np.cumsum(sizes)
        self.ids[held:held + len(ids)] = ids

    def _known_lists(self) -> pa.LargeListArray:
        n = len(self.known)
        return pa.LargeListArray.from_arrays(pa.array(self.ends[:n + 1]), pa.array(self.ids[:self.ends[n]]))

    def _make_room(self) -> None:
        """Forget the pieces that one call alone has met; all, if the others
        leave too little room."""
        old = np.flatnonzero(self.again[:len(self.known)])
        words, lists = list(self.known), self._known_lists()
        self._forget()
        if len(old) <= self.cache // 2:
            kept = lists.take(pa.array(old))
            self._keep([words[i] for i in old.tolist()], kept.values.to_numpy(), np.diff(kept.offsets.to_numpy()))

    def _ask(self, tok, new: list[str], words: list[str]) -> None:
        """Keep ``tok``'s ids of ``words`` as those of ``new``."""
        for s in range(0, len(new), 4096):
            part = words[s:s + 4096]
            if tok is self.merges:              # the model alone: nothing is normalized, cut or added
                found = [[t.id for t in tokens] for tokens in map(tok.model.tokenize, part)]
                ids, sizes = list(chain.from_iterable(found)), list(map(len, found))
            else:                               # one call for all: each is a word of the input, counted by number
                e = tok.encode_batch([part], is_pretokenized=True, add_special_tokens=False)[0]
                ids, sizes = e.ids, np.bincount(np.array(e.word_ids, dtype=np.int64), minlength=len(part))
            self._keep(new[s:s + 4096], np.array(ids, dtype="<u4"), sizes)

    def _learn(self, new: list[str]) -> None:
        word, letters = self.plan == "word", self.letters
        bodies = [w.lstrip(_ASCII_SPACE) for w in new] if word else new
        is_run = self.is_run if self.plan else lambda body: None
        runs, ascii_runs, other, none = [], [], [], []
        for w, body in zip(new, bodies):
            (none if not body else other if not is_run(body) else ascii_runs if body.isascii() else runs).append(w)
        if none:
            self._keep(none, np.empty(0, dtype="<u4"), np.zeros(len(none), dtype=np.int64))
        signs = [w.lstrip(_ASCII_SPACE).lower() for w in runs] if word else runs
        self._ask(self.merges, runs, [w.translate(letters) for w in signs])
        # of ASCII only the blank and the line break have other signs; no run holds a tab
        signs = "\t".join([w.lstrip(_ASCII_SPACE) for w in ascii_runs] if word else ascii_runs)
        signs = (signs.lower() if word else signs).replace(" ", letters[32]).replace("\n", letters[10])
        self._ask(self.merges, ascii_runs, signs.split("\t"))
        self._ask(self.tok, other, other)

    def _bounds(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pieces of the texts (UTF-8, one after the other, cut at
        ``offsets``) start, and the end of the last."""
        start = np.zeros(len(data) + 1, dtype=bool)
        kind = _KINDS[data]
        ascii_only = bool((data < 128).all())
        if self.plan == "word":                     # white space goes
            space = (kind == _SPACE) | (kind == _LINE)
            kind[space] = _SPACE
            start[1:-1] = space[1:] & ~space[:-1]
        elif len(data) > 2:
            space = (kind == _SPACE) | (kind == _LINE) | ((data >= 28) & (data <= 31))
            if not ascii_only:
                _mark_wide_spaces(data, space)
            start[1:-2] = (data[1:-1] == 32) & ~space[:-2] & ~space[2:]
            ends = offsets[1:][offsets[1:] > 0]
            start[ends - 1] = False                 # the last blank of a text has nothing after it
        start[offsets] = True
        if self.plan:
            if not ascii_only:                      # accented letters are two bytes
                lead = np.flatnonzero(data == 0xC3)
                lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
                kind[lead] = kind[lead + 1] = _LETTERS
            self._cut_runs(kind, start, data)
        return np.flatnonzero(start)

    def _cut_runs(self, kind: np.ndarray, start: np.ndarray, data: np.ndarray) -> None:
        """Set ``start`` where the runs of plain stretches start as well."""
        bounds = np.flatnonzero(start)
        plain = kind != _OTHER
        if self.plan == "byte":
            signed = (kind >= _LETTERS) & (kind <= _SIGNS)
            after = np.append(signed[1:], False) & ~start[1:]          # a sign of the same stretch follows
            line = kind == _LINE                    # one, between two signs of the stretch
            plain &= ~line | (after & ~start[:-1] & np.concatenate(([False], signed[:-1])))
            plain &= (kind != _SPACE) | ((data == 32) & start[:-1] & after)
        fine = np.logical_and.reduceat(plain, bounds[:-1])
        new = np.empty(len(kind), dtype=bool)
        new[0] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:])
        if self.plan == "word":
            new |= kind == _DIGIT
        new[1:] &= kind[:-1] != _SPACE
        start[:-1] |= new & np.repeat(fine, np.diff(bounds))

    def _encode_whole(self, text: str) -> bytes:
        if self.whole is None:                      # a second copy of the vocabulary: few corpora need it
            from tokenizers import Tokenizer
            self.whole = Tokenizer.from_str(self.json)
            self.whole.no_padding()
            self.whole.no_truncation()
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        held = [bool(t) and self.has_added(t) for t in texts] if self.has_added else [False] * len(texts)
        rest = iter(self._encode([t for t, h in zip(texts, held) if not h]))
        release_buffers()                           # those of the cut texts, several times their size
        return [self._encode_whole(t) if h else next(rest) for t, h in zip(texts, held)]

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        joined = pa.array([t or "" for t in texts], pa.large_string())
        if not len(joined):
            return []
        _, at, held = joined.buffers()
        offsets = np.frombuffer(at, dtype=np.int64)[:len(texts) + 1]
        if not offsets[-1]:
            return [b""] * len(texts)
        bounds = self._bounds(np.frombuffer(held, dtype=np.uint8)[:offsets[-1]], offsets)
        cut = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), held).dictionary_encode()
        if len(self.known) > self.cache:
            self._make_room()
        words, known = cut.dictionary.to_numpy(zero_copy_only=False).tolist(), self.known
        numbers = list(map(known.get, words))
        new = [i for i, k in enumerate(numbers) if k is None]
        self._learn([words[i] for i in new])
        for i in new:
            numbers[i] = known[words[i]]
        numbers = np.array(numbers, dtype=np.int64)
        self.again[np.delete(numbers, new)] = True
        lists = self._known_lists().take(pa.array(numbers)).take(cut.indices)   # the call's own first: they lie close
        flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        ends = ends[np.searchsorted(bounds, offsets)]
        return [flat[s:e].tobytes() for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _mark_wide_spaces(data: np.ndarray, space: np.ndarray) -> None:
    """Set ``space`` at the bytes of the white space beyond ASCII."""
    for lead, rest in ((0xC2, (b"\x85", b"\xa0")), (0xE1, (b"\x9a\x80",)), (0xE3, (b"\x80\x80",)),
                       (0xE2, (*(bytes([0x80, x]) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), b"\x81\x9f"))):
        at = np.flatnonzero(data == lead)           # the bytes of a character are all there
        for tail in rest if len(at) else ():
            hit = at[np.logical_and.reduce([data[at + 1 + k] == b for k, b in enumerate(tail)])]
            for k in range(len(tail) + 1):
                space[hit + k] = True


def shared_encoder(json, cache: int | None = None) -> Encoder:
    """The worker's encoder for a broadcast tokenizer file (its text), which
    keeps at most ``cache`` pieces.  A new one takes the place of whatever the
    worker held for another operator."""
    import hashlib
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # Spark runs one task per core
    text = json.value

    def make() -> Encoder:
        release_worker_cache()
        enc = Encoder(text, added=True, cache=cache)
        release_memory()                            # the parsed file is several times its text
        return enc

    return worker_cache(f"encoder_{hashlib.sha1(text.encode()).hexdigest()[:12]}_{cache}", make)


def broadcast_tokenizer(spark, path: str):
    """The tokenizer file's text (a few MB, whatever the corpus) for all
    executors; ``path`` is read on the driver only."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def slices(batch, column: int, rows: int = 1024, chars: int = 1_000_000):
    """``(start, texts)`` pieces of a batch of bounded size (a longer text is
    a piece of its own)."""
    texts, start, held = [], 0, 0
    for i in range(batch.num_rows):
        t = batch.column(column)[i].as_py()
        if texts and (len(texts) >= rows or held + len(t or "") > chars):
            yield start, texts
            texts, start, held = [], i, 0
        texts.append(t)
        held += len(t or "")
    if texts:
        yield start, texts
