"""Shared helpers of the operators: tables in the shared work folder, worker
caches, vectorised word hashing."""

from __future__ import annotations

import ctypes
import sys
import types
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import work_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder of the session
    (``spark.checkpoint.dir``) and read it back: lineage is cut, the files
    survive lost executors, and the planner sees the real size."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark, size: int = 4 << 20):
    """Rows of the jobs run inside go to Python in batches of about ``size``
    bytes (a longer row is one of its own).  By default a batch may hold 64 MB
    of texts, and the executor holds it several times over: as it is made, as
    it is read, and the one before."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(size, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop_tables(*dfs: DataFrame) -> None:
    """Delete the files of tables made by ``materialize`` that no later step
    reads."""
    for df in dfs:
        spark = df.sparkSession
        jvm = spark._jvm
        for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark) -> None:
    """Ask the driver's JVM to collect plans that are no longer referenced,
    so that the executors delete the shuffle files of finished jobs."""
    import gc
    gc.collect()
    spark._jvm.System.gc()


def worker_cache(name: str, make):
    """``make()`` once per Python worker process: the value outlives the task
    (functions of this package travel by value, so module globals do not)."""
    holder = sys.modules.setdefault("_kestrel_worker_cache", types.ModuleType("_kestrel_worker_cache"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def release_worker_cache() -> None:
    """Drop what an earlier operator keeps in this worker process: workers
    outlive a stage, and their memory is the executor's."""
    holder = sys.modules.get("_kestrel_worker_cache")
    if holder is not None:
        for name in [n for n in vars(holder) if not n.startswith("__")]:
            delattr(holder, name)
    release_memory()


def release_memory() -> None:
    """Give back what this process has freed: Arrow's pool and glibc keep it
    for their next use."""
    release_buffers()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def release_buffers() -> None:
    """Give the memory that Arrow's pool keeps of freed buffers back: a pool
    never shrinks by itself, so a worker would hold its largest call's."""
    pa.default_memory_pool().release_unused()


# ------------------------------------------------------------- word hashing

_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (xor-shift-multiply, a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables():
    space = np.zeros(256, dtype=bool)
    space[[32, *range(9, 14)]] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return space, lower


def hash_words(buf: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (uint64) and start offsets of the words ``[^\\x20\\x09-\\x0D]+``
    of ``buf`` with A-Z lower-cased."""
    space, lower = _tables()
    b = np.frombuffer(buf, dtype=np.uint8)
    gap = np.concatenate(([True], space[b], [True]))
    starts = np.flatnonzero(gap[:-1] & ~gap[1:])
    ends = np.flatnonzero(~gap[:-1] & gap[1:])
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    lens = ends - starts
    power = np.cumprod(np.full(int(lens.max()) + 1, _BASE, dtype=np.uint64))
    inside = ~space[b]
    pos = np.arange(len(b))[inside] - np.repeat(starts, lens)
    terms = (lower[b[inside]].astype(np.uint64) + np.uint64(1)) * power[pos]
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    return mix64(np.add.reduceat(terms, first) + lens.astype(np.uint64) * _MUL), starts


def _segments(text: bytes, size: int):
    """Pieces of a long text, cut before white space so that no word is cut."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(c, at + 1, at + size) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut <= at:                      # one word longer than a piece
            cuts = [c for c in (text.find(w, at + size) for w in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if c >= 0]
            if not cuts:
                break
            cut = min(cuts)
        yield text[at:cut]
        at = cut
    yield text[at:]


def hashed_documents(texts, size: int = 1 << 18):
    """Yield the word-hash array of each text in order.  Texts are hashed
    together in buffers of about ``size`` bytes; a longer text is cut at white
    space, so the working set does not grow with the longest text's bytes."""
    group: list[bytes] = []
    held = 0

    def flush():
        buf = b" ".join(group)
        hashes, starts = hash_words(buf)
        edges = np.cumsum([0, *[len(g) + 1 for g in group]])
        at = np.searchsorted(starts, edges)
        return [hashes[at[i]:at[i + 1]] for i in range(len(group))]

    for t in texts:
        raw = t.encode("utf-8", "surrogatepass") if t else b""
        if len(raw) > size:
            if group:
                yield from flush()
                group, held = [], 0
            yield np.concatenate([hash_words(s)[0] for s in _segments(raw, size)])
            continue
        group.append(raw)
        held += len(raw)
        if held > size:
            yield from flush()
            group, held = [], 0
    if group:
        yield from flush()
