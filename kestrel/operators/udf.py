"""The escape hatch for arbitrary Python: Arrow-batched pandas UDFs,
per-group functions, user folds, and frames generated by functions.

Built-in Column expressions stay the default everywhere else; these exist
for code Spark cannot express.  Memory per task is bounded by Arrow batches,
whatever the size of a group, and no answer depends on a measured size:

* ``map_values`` / ``filter_values`` run vectorised on Arrow batches;
* ``apply_in_groups`` hands the function each whole group as an iterator of
  pieces in a stated order;
* ``apply_in_chunks`` hands it pieces of a group next to the group's
  statistics, computed by Spark, and needs no shuffle of the rows;
* ``fold_by`` folds each partition into one accumulator per key and merges
  the accumulators per key.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from ..plans.joins import broadcast_if_small

#: Rows gathered into one output batch, and accumulators held before they are
#: passed on; both bound memory only, results do not depend on them.
OUT_ROWS = 10_000
HELD_KEYS = 100_000
_NAN = float("nan")


def map_values(fn: Callable[[pd.Series], pd.Series], return_type: DataType | str):
    """Wrap a vectorised ``Series -> Series`` function as a pandas UDF."""
    return F.pandas_udf(fn, return_type)


def filter_values(df: DataFrame, col: str, pred: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Keep rows where the Python predicate (vectorised) is true."""
    keep = F.pandas_udf(pred, "boolean")
    return df.filter(keep(F.col(col)))


def _pieces(pdf: pd.DataFrame, cols: list[str]):
    """``(key, rows)`` for every run of equal keys of a batch; NULL is a key."""
    change = np.zeros(len(pdf), dtype=bool)
    change[0] = True
    for c in cols:
        v = pdf[c].to_numpy()
        gone = pd.isna(v)
        change[1:] |= (v[1:] != v[:-1]) & ~(gone[1:] & gone[:-1])
    starts = np.flatnonzero(change)
    for a, b in zip(starts, [*starts[1:], len(pdf)]):
        key = tuple(None if pd.isna(pdf[c].iat[a]) else pdf[c].iat[a] for c in cols)
        yield key, pdf.iloc[a:b].reset_index(drop=True)


def _batched(frames):
    """Join small output frames, about ``OUT_ROWS`` rows at a time."""
    held, n = [], 0
    for f in frames:
        if len(f):
            held.append(f)
            n += len(f)
        if n >= OUT_ROWS:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def apply_in_groups(df: DataFrame, keys: Sequence[str], fn, schema: str, order: Sequence[str] = ()) -> DataFrame:
    """``groupby(keys).apply(fn)`` on whole groups of any size.

    ``fn(key, frames)`` is called once per group (NULL keys are groups too);
    ``frames`` iterates over the group's rows as pandas pieces of at most one
    Arrow batch, sorted by ``order``, and ``fn`` yields output frames.  Spark
    hash-partitions the rows on the keys and sorts each partition, which
    spills, so a task holds one batch and what ``fn`` keeps.  One group runs in
    one task, since ``fn`` sees it in order; for functions that only need the
    group's statistics, ``apply_in_chunks`` spreads a hot group.
    """
    cols = list(keys)

    def run(batches):
        runs = (piece for pdf in batches if len(pdf) for piece in _pieces(pdf, cols))
        groups = itertools.groupby(runs, key=lambda piece: piece[0])
        yield from _batched(out for key, own in groups for out in fn(key, (frame for _, frame in own)))

    return df.repartition(*cols).sortWithinPartitions(*cols, *order).mapInPandas(run, schema)


def run_sorted_groups(df: DataFrame, group_cols: Sequence[str], fn, schema: str) -> DataFrame:
    """``apply_in_groups`` for a function of one pandas frame: the task joins
    the pieces of each group, so it holds the largest group in memory."""
    return apply_in_groups(df, group_cols,
                           lambda _, frames: [fn(pd.concat(list(frames), ignore_index=True))], schema)


def with_group_stats(df: DataFrame, keys: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    """``df`` plus group-level aggregates on every row (NULL keys form a group):
    a partial and final aggregate, joined back on the keys null-safely."""
    own = {k: f"_group_{i}" for i, k in enumerate(keys)}
    found = df.groupBy(*[F.col(k).alias(a) for k, a in own.items()]).agg(*[c.alias(n) for n, c in stats.items()])
    same = functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(a)) for k, a in own.items()])
    return df.join(broadcast_if_small(found), same).drop(*own.values())


def apply_in_chunks(df: DataFrame, keys: Sequence[str], fn, schema: str,
                    context: dict[str, Column] | None = None) -> DataFrame:
    """Per-group function over pieces of each group.

    ``context`` names group-level aggregates (computed by Spark, partial
    then final) that are joined onto every row before the function runs, so
    a function that needs, say, the group mean sees it in every piece.  A
    piece holds the rows of one group in one Arrow batch: ``fn`` must not
    depend on how a group is cut, and a hot group is spread over all tasks
    that read its rows.
    """
    rows = with_group_stats(df, keys, context) if context else df

    def run(batches):
        yield from _batched(fn(piece.reset_index(drop=True)) for pdf in batches if len(pdf)
                            for _, piece in pdf.groupby(list(keys), sort=False, dropna=False))
    return rows.mapInPandas(run, schema)


def _fold(op, acc, values):
    if isinstance(op, np.ufunc):
        return op(acc, op.reduce(values)) if len(values) else acc
    return functools.reduce(op, values, acc)


def _plain(x):
    return x.item() if isinstance(x, np.generic) else x


def fold_by(df: DataFrame, key: Column | str, value: Column | str,
            binop: Callable | np.ufunc, initial,
            combine: Callable | np.ufunc | None = None, combine_initial=None,
            value_type: str = "double") -> DataFrame:
    """``foldby(key, binop, initial, combine, combine_initial)`` as
    ``(key, value)``; ``value_type`` is the type of the accumulator.

    Each partition starts every key from ``initial`` and applies ``binop(acc,
    value)`` once per row; the accumulators are shuffled by key and merged
    with ``combine(acc, acc)``, from ``combine_initial`` where it is given.
    ``combine`` defaults to ``binop``, which is right only where accumulator
    and value are alike.  ``initial`` must be neutral for ``combine`` or the
    answer depends on the partitioning, as in the reference.  NumPy ufuncs
    (``np.maximum``, ``np.add``) run vectorised and skip NULL values; other
    functions get ``None``.  NULL and NaN are keys.

    A task holds at most about ``HELD_KEYS`` accumulators and passes them on
    beyond that, so a key has one accumulator per partition, or some more
    where keys are many; the merge streams over key-sorted accumulators.
    """
    merge = combine or binop
    kcol = F.col(key) if isinstance(key, str) else key
    vcol = F.col(value) if isinstance(value, str) else value
    pairs = df.select(kcol.alias("key"), vcol.alias("value"))
    key_type = pairs.schema["key"].dataType.simpleString()
    value_arrow = to_arrow_type(DataType.fromDDL(value_type))

    def batch(rows, key_arrow):
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], key_arrow),
                                           pa.array([_plain(v) for _, v in rows], value_arrow)], names=["key", "value"])

    def partials(batches):
        held: dict = {}
        key_arrow = None
        for b in batches:
            key_arrow = b.schema.field(0).type
            coded = pc.dictionary_encode(b.column(0), null_encoding="encode")
            names = [_NAN if k != k else k for k in coded.dictionary.to_pylist()]
            for k in names:
                held.setdefault(k, initial)
            at = coded.indices.to_numpy(zero_copy_only=False)
            column = b.column(1)
            if isinstance(binop, np.ufunc):
                there = pc.is_valid(column)
                at = at[there.to_numpy(zero_copy_only=False)]
                values = column.filter(there).to_numpy(zero_copy_only=False)
            else:
                values = column.to_pylist()
            order = np.argsort(at, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                if len(rows):
                    k = names[at[rows[0]]]
                    own = values[rows] if isinstance(binop, np.ufunc) else [values[i] for i in rows]
                    held[k] = _fold(binop, held[k], own)
            if len(held) > HELD_KEYS:
                yield batch(list(held.items()), key_arrow)
                held = {}
        if held:
            yield batch(list(held.items()), key_arrow)

    def final(batches):
        # the accumulators of a key lie together in this partition (hash exchange and sort on the key)
        out, cur, acc = [], None, None
        for b in batches:
            key_arrow = b.schema.field(0).type
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                k = _NAN if k != k else k
                if cur is not None and (k is cur[0] or k == cur[0]):
                    acc = _plain(merge(acc, v))
                    continue
                if cur is not None:
                    out.append((cur[0], acc))
                cur, acc = (k,), v if combine_initial is None else _plain(merge(combine_initial, v))
            if len(out) >= OUT_ROWS:
                yield batch(out, key_arrow)
                out = []
        if cur is not None:
            yield batch([*out, (cur[0], acc)], key_arrow)

    schema = f"key {key_type}, value {value_type}"
    return pairs.mapInArrow(partials, schema).repartition("key").sortWithinPartitions("key").mapInArrow(final, schema)


def flat_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """One row to many rows with arbitrary Python (a table function): ``fn``
    maps a pandas batch of input rows to the output rows of that batch.
    Vectorised over Arrow batches; prefer ``explode`` when a Column
    expression can say it."""
    def run(batches):
        for pdf in batches:
            out = fn(pdf)
            if len(out):
                yield out
    return df.mapInPandas(run, schema)


def flat_map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``flat_map`` whose function maps an Arrow batch of input rows to an
    Arrow batch of output rows, so that lists are unnested in whole columns."""
    def run(batches):
        for b in batches:
            out = fn(b)
            if out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def unnest(batch: pa.RecordBatch, list_col: str, parent_cols: Sequence[str]) -> pa.RecordBatch:
    """One row per element of the structs in ``list_col`` with the parent's
    columns beside it; null and empty lists give none."""
    lists = batch.column(batch.schema.get_field_index(list_col))
    parents, rows = pc.list_parent_indices(lists), pc.list_flatten(lists)
    own = [batch.column(batch.schema.get_field_index(c)).take(parents) for c in parent_cols]
    names = [f.name for f in rows.type]
    return pa.RecordBatch.from_arrays([*own, *[pc.struct_field(rows, n) for n in names]], names=[*parent_cols, *names])


def from_functions(args: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                   schema: str, batched: bool = False) -> DataFrame:
    """A frame made of the sub-frames that ``fn`` returns for each argument
    row (``from_delayed``): the argument table is distributed and every task
    generates the sub-frames of its own arguments.  ``batched`` functions take
    many argument rows at once and return the sub-frames of all of them."""
    def gen(batches):
        for pdf in batches:
            if batched:
                yield from _batched([fn(pdf)] if len(pdf) else [])
            else:
                yield from _batched(fn(pdf.iloc[i:i + 1].reset_index(drop=True)) for i in range(len(pdf)))
    return args.mapInPandas(gen, schema)
