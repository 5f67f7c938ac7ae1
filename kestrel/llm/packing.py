"""Best-fit packing by minimum bin slack.

A document's tokens, with an end id, are cut into pieces of at most
``capacity`` tokens; the pieces are packed into sequences of ``capacity``.
Packing looks at lengths only.  Per bin, the longest length left is set and a
subset-sum over the lengths left, held as one bitset of ``capacity + 1`` bits,
finds the fullest combination that still fits; the combination is removed, as
often as the lengths left allow.  As every combination uses a length up (or
almost up), a shard takes at most a few thousand searches whatever its size.

Pieces are dealt by hash into shards of about ``shard_pieces`` pieces, each
packed in one task; the number of shards grows with the corpus and a shard
wastes less than one sequence.  Only lengths and ids reach a shard, not
tokens.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches
from .tokens import broadcast_tokenizer, shared_encoder, slices


def fullest(lengths: list[int], counts: np.ndarray, room: int) -> dict[int, int]:
    """Use of each length in the combination with the largest sum up to
    ``room``; ``lengths`` are distinct, ``counts[l]`` of each are there."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for l in lengths:
        left = min(int(counts[l]), room // l) if l <= room else 0
        k = 1
        while left > 0:                     # 1, 2, 4, ... copies at a time
            k = min(k, left)
            steps.append((l, k, reach))
            reach |= (reach << (l * k)) & mask
            left -= k
            k *= 2
        if reach >> room & 1:
            break
    best = reach.bit_length() - 1
    use: dict[int, int] = {}
    for l, k, before in reversed(steps):
        if not before >> best & 1:
            use[l] = use.get(l, 0) + k
            best -= l * k
    return use


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every item (lengths 1 to ``capacity``)."""
    n = len(lengths)
    bins, offsets = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    order = np.argsort(lengths, kind="stable")
    counts = np.bincount(lengths, minlength=capacity + 1)
    at = np.concatenate(([0], np.cumsum(counts)))[:-1].copy()    # next item of each length in order
    free = [int(l) for l in np.flatnonzero(counts)[::-1]]        # distinct lengths, longest first
    used = 0
    while free:
        top = free[0]
        counts[top] -= 1
        use = fullest(free, counts, capacity - top)
        counts[top] += 1
        use[top] = use.get(top, 0) + 1
        times = min(int(counts[l]) // u for l, u in use.items())
        place = 0
        for l, u in sorted(use.items(), reverse=True):
            items = order[at[l]:at[l] + times * u].reshape(times, u)
            bins[items] = used + np.arange(times)[:, None]
            offsets[items] = place + l * np.arange(u)[None, :]
            at[l] += times * u
            counts[l] -= times * u
            place += l * u
        used += times
        free = [l for l in free if counts[l]]
    return bins, offsets


def token_pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 capacity: int = 4096, end_id: int = 1, cache: int | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every piece of every
    row; the checksum is over little-endian unsigned 32-bit ids."""
    json = broadcast_tokenizer(docs.sparkSession, tokenizer)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        enc = shared_encoder(json, cache)
        for b in batches:
            for at, texts in slices(b, 1):
                rows: list[tuple] = []
                for i, ids in enumerate(enc.encode(texts)):
                    ids += end
                    for p, s in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[s:s + 4 * capacity]
                        rows.append((b.column(0)[at + i].as_py(), p, s // 4, len(part) // 4, zlib.crc32(part)))
                cols = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")) \
               .mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(pieces: DataFrame, capacity: int = 4096, shard_pieces: int = 200_000, seed: int = 3) -> DataFrame:
    """``pieces`` (with ``doc_id, piece, start, length, ids_crc32``) plus
    ``sequence_id`` and ``offset``; lengths are 1 to ``capacity``."""
    shards = max(1, math.ceil(pieces.count() / shard_pieces))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    dealt = pieces.select(*names, F.pmod(F.xxhash64("doc_id", "start", "length", "ids_crc32", F.lit(seed)), F.lit(shards)).alias("shard"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in names])
        bins, offsets = pack_lengths(table["length"].to_numpy(), capacity)
        shard = table["shard"][0].as_py()
        return table.select(names).append_column("sequence_id", pa.array(shard * (1 << 40) + bins)) \
                    .append_column("offset", pa.array(offsets))

    return dealt.groupBy("shard").applyInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                   capacity: int = 4096, end_id: int = 1, shard_pieces: int = 200_000, cache: int | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``: one
    row per piece of every row of ``docs``.

    Null and empty texts have the end id only.  Repeated rows are documents of
    their own; null ids are kept.  An empty table gives an empty result.
    Other columns are not read.  ``cache`` bounds the pieces of text whose ids
    a worker keeps (``tokens.CACHE``): a smaller one takes less memory and
    more time."""
    with small_batches(docs.sparkSession):
        pieces = materialize(token_pieces(docs, tokenizer, doc_id, text, capacity, end_id, cache), "pieces")
    return pack(pieces, capacity, shard_pieces)
