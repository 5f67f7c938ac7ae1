"""Folds that depend on the order of a key's rows, for keys of any size.

Rows are range-partitioned on (key, order), so a hot key spans several
partitions that follow each other; every task folds the runs of its keys while
its sorted Arrow batches pass by, and leaves one segment per key.  For an
operation that may be grouped (``(a . b) . c = a . (b . c)``, such as joining
strings) the few segments of a key, at most one per partition, are then folded
in partition order.  Any other function sees the rows of a key one after
another in one task, which holds one batch and one accumulator.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _runs(keys: pa.Array) -> np.ndarray:
    """Starts of the runs of equal keys (nulls are equal) of a batch, and its end."""
    codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.flatnonzero(np.diff(codes)) + 1, [len(codes)]))


def _sorted_runs(df: DataFrame, key: str, order: Sequence[Column], value: str, spread: bool, falling: bool = False) -> DataFrame:
    tie = F.xxhash64(F.col(value))
    rows = df.filter(F.col(value).isNotNull()).select(F.col(key).alias("_k"), *[c.alias(f"_o{i}") for i, c in enumerate(order)],
                                                      F.col(value).alias("_v"), tie.alias("_t"))
    after = [F.col(c).desc() if falling else F.col(c) for c in [*[f"_o{i}" for i in range(len(order))], "_t"]]
    cols = [F.col("_k"), *after]
    rows = rows.repartitionByRange(*cols) if spread else rows.repartition("_k")
    return rows.sortWithinPartitions(*cols).select("_k", "_v")


def ordered_concat(df: DataFrame, key: str, order: Sequence[str | Column], value: str, sep: str = ", ", out: str = "text",
                   falling: bool = False) -> DataFrame:
    """``(key, out)``: the strings of each key joined by ``sep`` in ``order``
    (``falling``: in reverse).

    A null key is a key, null values are left out, rows that tie on ``order``
    come in the order of their value's hash.  The result of a key is one string
    and must fit one row; nothing else of a key is held together."""
    kind = df.schema[key].dataType.simpleString()

    def joined(batches):
        from pyspark import TaskContext
        place = TaskContext.get().partitionId()
        key_now, pieces = None, None                       # the open run

        def segment():
            return pa.RecordBatch.from_arrays([key_now, pa.array([place], pa.int32()), pa.array([sep.join(pieces)], pa.string())],
                                              names=["_k", "_p", "_v"])

        for b in batches:
            keys, texts = b.column(0), b.column(b.num_columns - 1)
            if not len(keys):
                continue
            edges = _runs(keys)
            runs = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), texts), sep)
            heads = keys.take(pa.array(edges[:-1]))
            start = 0
            if pieces is not None and heads[0].equals(key_now[0]):
                pieces.append(runs[0].as_py())
                start = 1
            if start < len(runs):
                if pieces is not None:
                    yield segment()
                done = len(runs) - 1 - start               # whole runs of this batch
                if done > 0:
                    yield pa.RecordBatch.from_arrays([heads.slice(start, done), pa.array(np.full(done, place), pa.int32()),
                                                      runs.slice(start, done).cast(pa.string())], names=["_k", "_p", "_v"])
                key_now, pieces = heads.slice(len(runs) - 1, 1), [runs[len(runs) - 1].as_py()]
        if pieces is not None:
            yield segment()

    rows = _sorted_runs(df, key, [F.col(c) if isinstance(c, str) else c for c in order], value, spread=True, falling=falling)
    schema = f"_k {kind}, _p int, _v string"
    segments = rows.mapInArrow(joined, schema)
    whole = segments.repartition("_k").sortWithinPartitions("_k", "_p").mapInArrow(joined, schema)
    return whole.select(F.col("_k").alias(key), F.col("_v").alias(out))


def fold_in_order(df: DataFrame, key: str, order: Sequence[str | Column], value: str, fn: Callable, out: str = "fold",
                  associative: bool = False) -> DataFrame:
    """``(key, out)``: ``fn(fn(v1, v2), v3)...`` over each key's values in
    ``order``; a single value is its own fold, null values are left out.

    ``associative`` lets Spark fold a hot key in segments; otherwise all rows
    of a key pass through one task, in order and in bounded memory."""
    kind, result = df.schema[key].dataType.simpleString(), df.schema[value].dataType.simpleString()

    def folded(batches):
        from pyspark import TaskContext
        place = TaskContext.get().partitionId()
        head, acc, kept = None, None, ([], [])
        for b in batches:
            keys, values = b.column(0), b.column(b.num_columns - 1).to_pylist()
            if not len(keys):
                continue
            edges = _runs(keys)
            heads = keys.take(pa.array(edges[:-1])).to_pylist()
            for i, (s, e) in enumerate(zip(edges, edges[1:])):
                if head is not None and head[0] == heads[i]:
                    at = s
                else:
                    if head is not None:
                        kept[0].append(head[0])
                        kept[1].append(acc)
                    head, acc, at = (heads[i],), values[s], s + 1
                for v in values[at:e]:
                    acc = fn(acc, v)
            if len(kept[0]) > 10_000:
                yield _batch(kept, place)
                kept = ([], [])
        if head is not None:
            kept[0].append(head[0])
            kept[1].append(acc)
            yield _batch(kept, place)

    key_type, value_type = (_arrow_type(df, c) for c in (key, value))

    def _batch(kept, place):
        return pa.RecordBatch.from_arrays([pa.array(kept[0], key_type), pa.array([place] * len(kept[0]), pa.int32()),
                                           pa.array(kept[1], value_type)], names=["_k", "_p", "_v"])

    rows = _sorted_runs(df, key, [F.col(c) if isinstance(c, str) else c for c in order], value, spread=associative)
    schema = f"_k {kind}, _p int, _v {result}"
    segments = rows.mapInArrow(folded, schema)
    if associative:
        segments = segments.repartition("_k").sortWithinPartitions("_k", "_p").mapInArrow(folded, schema)
    return segments.select(F.col("_k").alias(key), F.col("_v").alias(out))


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[column].dataType)
