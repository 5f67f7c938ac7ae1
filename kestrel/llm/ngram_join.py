"""N-gram Jaccard join by PartEnum signatures, and its connected groups.

Two texts link when the Jaccard similarity of their word 5-gram sets is at
least 0.75 (``num / den``).  The join is exact:

1. **Sets.**  Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; each
   5-gram is a 64-bit hash.  Documents with the same set (exact copies) share
   one node, so a group of copies, however large, is one row from here on.
2. **Frequency test.**  A set with more than a quarter of its features unique
   cannot reach 0.75 with any other set and leaves the join (the test never
   removes a linked set).  First one aggregate over the features whose hash
   lies in a fixed 30 % of the hash range drops the sets that share next to
   nothing; then one over all features of the sets that are left, in which
   features shared only with dropped sets count as unique too.
3. **Signatures.**  Sets fall into size bands whose limits grow by 4/3, so a
   linked pair shares a band or lies in neighbouring ones; every set is coded
   for its own band and the next.  Within a code, sizes at most ``R`` and
   similarity 0.75 bound the Hamming distance by ``2 R / 7``.  The feature
   domain is partitioned into ``n1`` groups of ``n2`` parts, and every subset
   of ``n2 - k2`` parts of a group gives one signature (the hash of the
   features that fall into it).  Linked sets differ in at most ``k2`` parts
   of some group, so they share a signature.  Empty projections are not
   signatures; a set for which they might hide a partner (counted exactly
   from its own occupied parts) is coded again under another partition, and
   after sixteen partitions under one signature per code (fewer than one set
   in a million: a twentieth of the sets of the worst size fails three).  Sets of up to 11
   features use the finest partition: every subset left after deleting at
   most a quarter of the features.
4. **Verification** without making rows of a bucket's pairs.  First every set
   is intersected with the set that is the smallest member of most of its
   buckets, which connects most of a group of near copies with one check per
   member.  A
   bucket whose sets all lie in one component is done with.  In the others
   the sets meet as parity sketches (one bit per cell of a hash, flipped by
   every feature that falls into it; two to four bits a feature): two sketches
   differ in no more bits than the sets differ in features, so a pair whose
   sketches differ in more than a linked pair may is none, nor is one whose
   sizes are further apart than 0.75.  The pairs that
   pass connect components to clusters; sets without one are done with.  A
   cluster is dealt into blocks (large components into blocks of their own),
   and every pair of blocks that may hold a link between different components
   is one piece of work for one task, which counts common features by postings
   and returns at most one edge per component.  Buckets and clusters are cut
   into blocks bounded in sets and in features, so that one of any size is
   spread over many tasks.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from .common import drop_tables, hashed_documents, materialize, mix64, release_shuffles, release_worker_cache
from .components import connected_components

WIDTH = 5
TINY = 11                       # sets up to this size are coded by deletion
SEEDS = 16
FREQUENCY_SHARE = 0.30          # share of the hash range counted in step 2
BLOCK_SETS = 1024               # sets, and features, of a block in step 4
BLOCK_FEATURES = 1 << 20
SKETCH_SETS = 4096              # sets, and features, of a block of sketches
SKETCH_FEATURES = 1 << 24
SMALL_TABLE = 16 << 20          # a written table of at most this size (in bytes) may be broadcast
_U = np.uint64
# one odd multiplier per place in a shingle, so that word order matters
_SHIFT = mix64(np.arange(1, 9, dtype=np.uint64)) | _U(1)


def shingle_set(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of a word-hash sequence; fewer words
    than ``width`` form one shingle, no words none."""
    n = len(words)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    k = min(n, width)
    acc = np.full(n - k + 1, k, dtype=np.uint64) * _U(0xA0761D6478BD642F)
    for i in range(k):
        acc += words[i:n - k + 1 + i] * _SHIFT[i % len(_SHIFT)] ** _U(i // len(_SHIFT) + 1)
    return np.unique(mix64(acc))


def _set_key(s: np.ndarray) -> int:
    """64-bit identity of a set, as a signed integer."""
    acc = np.add.reduce(mix64(s ^ _U(0x5851F42D4C957F2D)), dtype=np.uint64, keepdims=True)
    acc = acc + np.array([len(s)], dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    return int(mix64(acc).view(np.int64)[0])


def _small(batches, rows: int = 1000):
    """Batches of at most ``rows`` rows: what is made of one is held at once."""
    for b in batches:
        for s in range(0, b.num_rows, rows):
            yield b.slice(s, rows)


def _documents(batch: pa.RecordBatch, width: int):
    """(row number, shingle set) of every row of an Arrow batch (id, text)."""
    texts = (x.as_py() for x in batch.column(1))
    for i, words in enumerate(hashed_documents(texts)):
        yield i, shingle_set(words, width)


def set_table(docs: DataFrame, doc_id: str, text: str, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_shingles, set_key)`` per row; no words give size 0 and a
    null key."""
    def run(batches):
        release_worker_cache()
        for b in _small(batches):
            sizes, keys = [], []
            for _, s in _documents(b, width):
                sizes.append(len(s))
                keys.append(_set_key(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())],
                names=["doc_id", "n_shingles", "set_key"])
    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return src.mapInArrow(run, "doc_id bigint, n_shingles bigint, set_key bigint")


def _counted_features(docs: DataFrame, width: int, share: float) -> DataFrame:
    """``(feature, set_key)`` for features in the counted part of the hash range."""
    limit = int(share * 2 ** 64)

    def run(batches):
        for b in _small(batches):
            feats, keys = [], []
            for _, s in _documents(b, width):
                if len(s):
                    f = s[:np.searchsorted(s, _U(limit))]
                    feats.append(f)
                    keys.append(np.full(len(f), _set_key(s), dtype=np.int64))
            if feats:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(feats).view(np.int64)), pa.array(np.concatenate(keys))],
                    names=["feature", "set_key"])
    return docs.mapInArrow(run, "feature bigint, set_key bigint")


def _unique_features(features: DataFrame) -> DataFrame:
    """``(set_key, unique)``: features that no other set of ``features`` has."""
    return (features.groupBy("feature").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi"))
                    .filter("lo = hi").groupBy(F.col("lo").alias("set_key")).agg(F.count(F.lit(1)).alias("unique")))


# ------------------------------------------------------------- signatures

def band_limits(upto: int) -> list[int]:
    """Largest size of each band: 11, 14, 18, 24, ... (factor 4/3)."""
    out = [TINY]
    while out[-1] < upto:
        out.append(out[-1] * 4 // 3)
    return out


def code_shape(limit: int) -> tuple[int, int, int]:
    """``(n1, n2, k2)`` of the code for sets of at most ``limit`` features:
    groups, parts per group, parts of a group that may differ."""
    k = 2 * limit // 7
    if limit <= 14:
        return 1, 9, k
    if limit <= 56:
        n1 = k // 3 + 1
        return n1 + n1 // 6, 5, 2
    return -(-62 * k // 100) + 3, 3, 1


def _code(s: np.ndarray, code: int, limit: int, seed: int) -> tuple[np.ndarray, bool]:
    """Signatures of one set in one code, and whether they are sure to meet
    every linked set's."""
    n1, n2, k2 = code_shape(limit)
    salt = mix64(np.array([code * 64 + seed + 1], dtype=np.uint64))[0]
    x = mix64(s ^ salt)
    cell = ((x >> _U(32)) * _U(n1) >> _U(32)) * _U(n2) + ((x & _U(0xFFFFFFFF)) * _U(n2) >> _U(32))
    cell = cell.astype(np.int64)
    order = np.argsort(cell, kind="stable")
    cs = cell[order]
    first = np.flatnonzero(np.concatenate(([True], cs[1:] != cs[:-1])))
    value = np.zeros(n1 * n2, dtype=np.uint64)
    value[cs[first]] = mix64(np.add.reduceat(mix64(s[order] + salt), first) + _U(1))
    value = value.reshape(n1, n2)
    filled = np.zeros(n1 * n2, dtype=bool)
    filled[cs[first]] = True
    filled = filled.reshape(n1, n2)
    subsets = np.array(list(combinations(range(n2), n2 - k2)))
    groups = np.arange(n1, dtype=np.uint64) * _U(1 << 20) + salt
    sigs = groups[:, None] + np.arange(len(subsets), dtype=np.uint64)[None, :]
    for j in range(n2 - k2):
        sigs = mix64(sigs + value[:, subsets[:, j]])
    some = filled[:, subsets].any(axis=2)
    n = len(s)
    k = (n + min(limit, n * 4 // 3)) // 7           # most that a linked set can differ
    hidden = int((filled.sum(axis=1) <= min(k2, k)).sum())
    return sigs[some], n1 - k // (k2 + 1) > hidden


def signatures(s: np.ndarray) -> np.ndarray:
    """All PartEnum signatures of a set (distinct, uint64).  Any two sets
    with Jaccard similarity of at least 0.75 share at least one."""
    n = len(s)
    out: list[np.ndarray] = []
    limits = band_limits(n)
    own = len(limits) - 1
    if own == 0:                                    # tiny: subsets after deletions
        parts = mix64(s + _U(0x2545F4914F6CDD1D))
        total = np.add.reduce(parts, dtype=np.uint64, keepdims=True)
        out.append(mix64(total))
        for r in range(1, n // 4 + 1):
            gone = np.array(list(combinations(range(n), r)))
            out.append(mix64(total - np.add.reduce(parts[gone], axis=1, dtype=np.uint64)))
    nxt = limits[-1] * 4 // 3
    for code, limit in ((own, limits[-1]), (own + 1, nxt)):
        if code == 0 or n * 4 // 3 <= (limits[own] if code > own else 0):
            continue                                # no partner can lie in that band
        for seed in range(SEEDS):
            sigs, sure = _code(s, code, limit, seed)
            out.append(sigs)
            if sure:
                break
        else:
            out.append(mix64(np.array([code], dtype=np.uint64) + _U(0xD1B54A32D192ED03)))
    return np.unique(np.concatenate(out))


def _signature_rows(sets: DataFrame) -> DataFrame:
    def run(batches):
        for b in _small(batches):
            offsets = b.column(1).offsets.to_numpy()
            flat = b.column(1).values.to_numpy().view(np.uint64)
            keys = b.column(0).to_numpy()
            sigs, owner = [], []
            for i in range(b.num_rows):
                g = signatures(flat[offsets[i]:offsets[i + 1]])
                sigs.append(g)
                owner.append(np.full(len(g), keys[i], dtype=np.int64))
            if sigs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(owner))],
                    names=["sig", "set_key"])
    return sets.select("set_key", "features").mapInArrow(run, "sig bigint, set_key bigint")


def _sets_of(docs: DataFrame, width: int) -> DataFrame:
    """``(set_key, features)`` of the given documents."""
    def run(batches):
        for b in _small(batches):
            keys, sets = [], []
            for _, s in _documents(b, width):
                if len(s):
                    keys.append(_set_key(s))
                    sets.append(s)
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))],
                names=["set_key", "features"])
    return docs.mapInArrow(run, "set_key bigint, features array<bigint>")


# ------------------------------------------------------------- the join

def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b)`` whose similarity reaches ``num / den``."""
    sa = sets.select(F.col("set_key").alias("a"), F.col("features").alias("fa"))
    sb = sets.select(F.col("set_key").alias("b"), F.col("features").alias("fb"))
    both = F.size(F.array_intersect("fa", "fb"))
    union = F.size("fa") + F.size("fb") - both
    return (pairs.join(sa, "a").join(sb, "b")
                 .filter(den * both >= num * union).select("a", "b").distinct())


def _with_component(df: DataFrame, comp: DataFrame, key: str, name: str) -> DataFrame:
    c = comp.select(F.col("node").alias(key), F.col("component").alias("_c"))
    return df.join(c, key, "left").withColumn(name, F.coalesce("_c", key)).drop("_c")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       num: int = 75, den: int = 100, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest document id reachable by links, the
    document's own included.  Null or empty texts and texts without words
    have size 0 and stand alone; documents with equal sets are linked;
    repeated rows are returned as often as they occur; a row with a null id
    belongs to the component of its set if some row with an id has that set,
    else its component is null.  Other columns of ``docs`` are not read.  The code
    is built for the similarity 0.75 (``num / den`` may only be higher).
    """
    if num * 4 < den * 3:
        raise ValueError("the signatures cover similarities of 0.75 and more")
    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    base = materialize(set_table(src, "doc_id", "text", width), "sets")
    comp = _set_components(src, base, num, den, width)
    # per component the smallest document id; sets without links are their own component
    keyed = base.join(comp.select(F.col("node").alias("set_key"), "component"), "set_key", "left") \
                .withColumn("component", F.coalesce("component", "set_key"))
    roots = keyed.filter(F.col("set_key").isNotNull()).groupBy("component").agg(F.min("doc_id").alias("root"))
    return (keyed.join(roots, "component", "left")
                 .select("doc_id", "n_shingles",
                         F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("root")).alias("component_id")))


def _set_components(src: DataFrame, base: DataFrame, num: int, den: int, width: int) -> DataFrame:
    """``(node, component)`` over set keys, for sets with at least one link."""
    spark = src.sparkSession
    single = _unique_features(_counted_features(src, width, FREQUENCY_SHARE))
    alive = (base.filter(F.col("set_key").isNotNull())
                 .groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"))
                 .join(single, "set_key", "left")
                 .filter(den * (F.col("n") - F.coalesce("unique", F.lit(0))) >= num * F.col("n"))
                 .filter(F.col("doc_id").isNotNull()).select("doc_id"))
    alive = materialize(alive, "alive")
    release_shuffles(spark)
    near = materialize(_sets_of(src.join(broadcast_if_small(alive, SMALL_TABLE), "doc_id", "left_semi"), width), "features")
    single = _unique_features(near.select(F.explode("features").alias("feature"), "set_key"))
    n = F.size("features")
    sets = materialize(near.join(single, "set_key", "left")
                           .filter(den * (n - F.coalesce("unique", F.lit(0))) >= num * n)
                           .select("set_key", "features"), "features")
    drop_tables(near, alive)
    release_shuffles(spark)
    # one exchange for both uses; a set has one row per signature, so a signature of many sets is a small share of the rows
    sigs = _signature_rows(sets).repartition("sig")
    shared = sigs.groupBy("sig").agg(F.min("set_key").alias("rep"), F.max("set_key").alias("top")) \
                 .filter("rep < top").select("sig", "rep")
    members = materialize(sigs.join(shared, "sig"), "members")
    release_shuffles(spark)

    # every set against the smallest member of most of its buckets
    often = members.filter("set_key > rep").groupBy("set_key", "rep").agg(F.count(F.lit(1)).alias("times"))
    first = often.groupBy(F.col("set_key").alias("b")).agg(F.max_by("rep", F.struct("times", "rep")).alias("a"))
    first = materialize(first, "first")
    edges = materialize(_verify(first, sets, num, den), "links")
    comp = materialize(connected_components(edges, "a", "b"), "components")

    # buckets that hold sets of different components, and what is left to compare among those
    named = _with_component(_with_component(members, comp, "set_key", "c"), comp, "rep", "rep_c")
    named = materialize(named.select("sig", "set_key", "c", "rep_c"), "members")
    drop_tables(members)
    release_shuffles(spark)
    close = materialize(_sketch_pairs(named, sets, num, den), "close")
    drop_tables(named)
    joined = connected_components(close.filter("other IS NOT NULL"), "c", "other")
    left = close.filter("other IS NULL").select("set_key", "c")
    clusters = materialize(left.join(joined.select(F.col("node").alias("c"), F.col("component").alias("cluster")), "c"), "clusters")
    drop_tables(close)
    release_shuffles(spark)
    more = materialize(_between_components(clusters, first, sets, num, den), "links")
    if not more.isEmpty():
        comp = materialize(connected_components(edges.unionByName(more), "a", "b"), "components")
    drop_tables(sets, clusters)
    return comp


def parity_sketch(s: np.ndarray) -> bytes:
    """Bits of the cells that an odd number of the features falls into; the
    number of cells is a power of two, at least 64 and twice the set's size.
    Halves that are XORed give the sketch of half as many cells."""
    cells = max(64, 1 << int(2 * len(s) - 1).bit_length())
    at = (mix64(s ^ _U(0x8CB92BA72F3D8DD7)) & _U(cells - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=cells).astype(np.uint8) & 1, bitorder="little").tobytes()


def _sketches(sets: DataFrame) -> DataFrame:
    def run(batches):
        for b in _small(batches):
            offsets = b.column(1).offsets.to_numpy()
            flat = b.column(1).values.to_numpy().view(np.uint64)
            made = [parity_sketch(flat[offsets[i]:offsets[i + 1]]) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(made, pa.binary())],
                                             names=["set_key", "n", "sketch"])
    return sets.select("set_key", "features").mapInArrow(run, "set_key bigint, n bigint, sketch binary")


def close_sketches(keys: np.ndarray, comps: np.ndarray, sizes: np.ndarray, sides: np.ndarray, sketches: list[bytes],
                   num: int, den: int) -> tuple[set, list]:
    """The rows ``(key, component)`` with a close sketch of a set of like size
    in another component (on the other side, if there are two sides), and
    edges that connect the components of all close pairs."""
    lens = np.array([len(x) for x in sketches])
    near = np.zeros(len(keys), dtype=bool)
    edges: list = []
    root = {c: c for c in comps.tolist()}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    two = bool(sides.min() != sides.max())
    for length in np.unique(lens):
        wide = np.flatnonzero(lens >= length)
        bits = np.empty((len(wide), length // 8), dtype=np.uint64)
        for row, i in enumerate(wide):
            x = np.frombuffer(sketches[i], dtype=np.uint64)
            while len(x) > length // 8:
                x = x[:len(x) // 2] ^ x[len(x) // 2:]
            bits[row] = x
        for row in np.flatnonzero(lens[wide] == length):
            i = wide[row]
            apart = np.bitwise_count(bits ^ bits[row]).sum(axis=1, dtype=np.int64)
            hit = ((den + num) * apart <= (den - num) * (sizes[i] + sizes[wide])) & (comps[wide] != comps[i])
            # of sets of very different size the smaller one's few cells say nothing, but the sizes do
            hit &= den * np.minimum(sizes[i], sizes[wide]) >= num * np.maximum(sizes[i], sizes[wide])
            if two:
                hit &= sides[wide] != sides[i]
            if not hit.any():
                continue
            near[i] = True
            near[wide[hit]] = True
            for c in set(comps[wide[hit]].tolist()):
                a, b = find(int(comps[i])), find(c)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    edges.append((int(comps[i]), c))
    return set(zip(keys[near].tolist(), comps[near].tolist())), edges


def _sketch_pairs(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``(set_key, c, other)``: sets (``other`` null) that have a close sketch
    of another component in a bucket of ``members`` (``sig, set_key, c,
    rep_c``, the component of the bucket's smallest set), and pairs of
    components (``set_key`` null) that connect those.

    Sets meet once per bucket, or once per pair of blocks of their cluster
    (components that share open buckets) where that sends fewer sketches: a
    long set lies in hundreds of buckets, a cluster of most sets in many
    blocks.  Both compare every pair that shares an open bucket."""
    sketches = materialize(_sketches(sets), "sketches")
    # near sets share many buckets of the same sets: one of those is enough, told by count and hash sums
    low = lambda seed: F.sum(F.pmod(F.xxhash64(F.lit(seed), "set_key"), F.lit(1 << 32)))
    content = [F.count(F.lit(1)).alias("count"), *(low(i).alias(f"sum{i}") for i in range(4))]
    apart = F.col("c") != F.col("rep_c")
    # most buckets hold one component: the others are told first, and only their rows are grouped
    open_ = materialize(members.filter(apart).select("sig").distinct(), "open")
    members = materialize(members.join(broadcast_if_small(open_, SMALL_TABLE), "sig", "left_semi"), "open")
    once = (members.groupBy("sig").agg(*content)
                   .groupBy("count", *(f"sum{i}" for i in range(4))).agg(F.min("sig").alias("sig")).select("sig"))
    once = materialize(once, "once")
    rows = materialize(members.join(broadcast_if_small(once, SMALL_TABLE), "sig", "left_semi").select("sig", "set_key", "c"), "buckets")
    joined = connected_components(members.filter(apart).select(F.col("c").alias("a"), F.col("rep_c").alias("b")).distinct(), "a", "b")
    rows = rows.join(joined.select(F.col("node").alias("c"), F.col("component").alias("cluster")), "c")
    each = rows.groupBy("cluster", "set_key").agg(F.count(F.lit(1)).alias("times")).join(sketches.select("set_key", "n"), "set_key")
    total = each.groupBy("cluster").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("all_n"))
    blocks = F.greatest(F.ceil(F.col("m") / SKETCH_SETS), F.ceil(F.col("all_n") / SKETCH_FEATURES)).cast("int")
    whole = total.select("cluster", (F.col("m") * blocks <= F.col("times")).alias("whole"))
    unit = F.when(F.col("whole"), F.xxhash64(F.lit("cluster"), "cluster")).otherwise(F.col("sig"))
    rows = rows.join(whole, "cluster").select(unit.alias("sig"), "set_key", "c").distinct()
    rows = materialize(rows.join(sketches.select("set_key", "n"), "set_key"), "units")
    size = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("all_n"))
    dealt = (rows.drop("n").join(size.select("sig", blocks.alias("blocks")), "sig")
                 .withColumn("side", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int"))
                 .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("sig", F.least("side", "o").alias("x"), F.greatest("side", "o").alias("y"), "side", "set_key", "c"))
    work = dealt.join(sketches, "set_key").select("sig", "x", "y", "side", "set_key", "c", "n", "sketch")
    work = work.repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y")

    def pieces(batches):
        """Tables of whole (sig, x, y) groups: the last one waits for the next batch."""
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            if not t.num_rows:
                continue
            k = [t[c].to_numpy() for c in ("sig", "x", "y")]
            new = np.flatnonzero((k[0][1:] != k[0][:-1]) | (k[1][1:] != k[1][:-1]) | (k[2][1:] != k[2][:-1])) + 1
            cut = int(new[-1]) if len(new) else 0
            if cut:
                yield t.slice(0, cut), np.concatenate(([0], new))
            held = t.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield held, np.array([0, held.num_rows])

    def run(batches):
        for t, ends in pieces(batches):
            keys, comps, sizes, sides = (t[c].to_numpy() for c in ("set_key", "c", "n", "side"))
            sketch = t["sketch"].to_pylist()
            found, edges = set(), set()
            for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist()):
                if (comps[lo:hi] == comps[lo]).all():
                    continue
                f, e = close_sketches(keys[lo:hi], comps[lo:hi], sizes[lo:hi], sides[lo:hi], sketch[lo:hi], num, den)
                found |= f
                edges.update(e)
            out = [(k, c, None) for k, c in found] + [(None, a, b) for a, b in edges]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["set_key", "c", "other"])

    return work.mapInArrow(run, "set_key bigint, c bigint, other bigint").distinct()


def _between_components(clusters: DataFrame, first: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``(a, b)``: edges that connect the components of each cluster wherever
    two of its sets (``set_key, c, cluster``; ``c`` the component) are linked.
    Clusters of two sets that ``first`` (``b, a``) names have been compared."""
    member = clusters.join(sets.select("set_key", F.size("features").alias("n")), "set_key")
    open_ = member.groupBy("cluster").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("in_cluster"),
                                          F.sum("n").alias("cluster_n")) \
                  .filter("lo < hi").drop("lo", "hi")
    two = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("in_cluster"), F.max("set_key").alias("b"), F.min("set_key").alias("a"))
    done = two.filter("in_cluster = 2").join(first, ["b", "a"]).select("cluster")
    open_ = open_.join(done, "cluster", "left_anti")
    size = member.groupBy("c").agg(F.count(F.lit(1)).alias("in_c"), F.sum("n").alias("c_n"))
    blocks = lambda count, n: F.greatest(F.ceil(count / BLOCK_SETS), F.ceil(n / BLOCK_FEATURES))
    large = (F.col("in_c") >= BLOCK_SETS // 4) | (F.col("c_n") >= BLOCK_FEATURES // 4)
    placed = (member.join(open_, "cluster").join(size, "c")
                    .withColumn("pure", F.when(large, F.col("c")))
                    .withColumn("block", F.when(large, F.xxhash64("c", F.pmod(F.xxhash64("set_key"), blocks(F.col("in_c"), F.col("c_n")))))
                                .otherwise(F.xxhash64("cluster", F.pmod(F.xxhash64("c"), blocks(F.col("in_cluster"), F.col("cluster_n"))))))
                    .select("cluster", "block", "pure", "set_key", "c"))
    placed = materialize(placed, "placed")
    table = placed.select("cluster", "block", "pure").distinct()
    other = table.select("cluster", F.col("block").alias("o"), F.col("pure").alias("o_pure"))
    pairs = table.join(other, "cluster").filter("NOT (pure <=> o_pure AND pure IS NOT NULL)") \
                 .select("block", F.least("block", "o").alias("x"), F.greatest("block", "o").alias("y"))
    work = placed.select("block", "set_key", "c").join(pairs, "block").join(sets, "set_key") \
                 .select("x", "y", "block", "set_key", "c", "features")
    edge = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        x, y = group["x"][0].as_py(), group["y"][0].as_py()
        group = group.combine_chunks()
        keys, comps, block = (group[c].to_numpy() for c in ("set_key", "c", "block"))
        lists = group["features"].chunk(0) if group["features"].num_chunks else pa.array([], pa.list_(pa.int64()))
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        left = np.flatnonzero(block == x)
        right = left if x == y else np.flatnonzero(block == y)
        a, b = linked_components(flat, ends, keys, comps, left, right, num, den)
        return pa.table({"a": a, "b": b}, schema=edge)

    return work.groupBy("x", "y").applyInArrow(run, "a bigint, b bigint")


def linked_components(flat: np.ndarray, ends: np.ndarray, keys: np.ndarray, comps: np.ndarray, left: np.ndarray,
                      right: np.ndarray, num: int, den: int) -> tuple[list[int], list[int]]:
    """Edges between linked sets of ``left`` and ``right`` (row numbers) that
    connect different components; each edge merges two of them.  ``flat`` and
    ``ends`` hold the feature lists."""
    sizes = np.diff(ends)
    # postings of the right side: rows by feature
    at = np.concatenate([np.arange(ends[r], ends[r + 1]) for r in right]) if len(right) else np.empty(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(flat[at], kind="stable")
    feats, owner = flat[at][order], owner[order]
    values, starts = np.unique(feats, return_index=True)
    stops = np.append(starts[1:], len(feats))
    root = {c: c for c in set(comps.tolist())}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out_a, out_b = [], []
    for i in left:
        f = flat[ends[i]:ends[i + 1]]
        p = np.searchsorted(values, f)
        inside = p < len(values)
        p, f = p[inside], f[inside]
        p = p[values[p] == f]
        lens = stops[p] - starts[p]
        total = int(lens.sum())
        if not total:
            continue
        gather = np.repeat(starts[p] - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(total)
        both = np.bincount(owner[gather], minlength=len(right))
        hit = np.flatnonzero((den * both >= num * (sizes[i] + sizes[right] - both)) & (comps[right] != comps[i]))
        for j in hit:
            ca, cb = find(int(comps[i])), find(int(comps[right[j]]))
            if ca != cb:
                root[max(ca, cb)] = min(ca, cb)
                out_a.append(int(keys[i]))
                out_b.append(int(keys[right[j]]))
    return out_a, out_b
