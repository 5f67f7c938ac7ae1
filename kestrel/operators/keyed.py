"""Keyed tables: upserts, look-ups with default, conditional replace,
counters, key=value concatenation, first match, and the ordered fold.

The reference demonstrates these on a concurrent in-memory map; here a map
is a DataFrame ``(k, v)`` and each map call becomes a join or an aggregate
over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from .ordered import fold_in_order, ordered_concat


def upsert_if_absent(base: DataFrame, updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """``putIfAbsent`` for every update row: base rows win, new keys added.
    Of several updates of one key the first by ``order`` counts (a column of
    ``updates`` alone; without it, the one with the smallest values)."""
    rest = [c for c in base.columns if c != key]
    first = F.min(F.struct(*([F.col(order).alias("_at")] if order else []), *rest))
    once = updates.groupBy(key).agg(first.alias("_first")).select(key, *[f"_first.{c}" for c in rest])
    return base.unionByName(once.join(base.select(key), key, "left_anti"))


def upsert_merge(base: DataFrame, updates: DataFrame, key: str, value: str, combine: Callable | None = None,
                 order: str | None = None, associative: bool = False) -> DataFrame:
    """``merge(k, v, f)``: keys in both get ``combine(new, old)`` (by default
    the text ``new was old``); others keep whichever side has them.

    Several updates of one key are merged one after another by ``order`` (a
    column of ``updates``; without it, by value), so the result has one row
    per key; NULL values merge nothing.  The default text is joined from
    ordered segments, so a key may have any number of updates.  ``combine`` is
    a Python function of two values; say ``associative`` if it may be grouped,
    otherwise a key's updates pass through one task one by one."""
    kind = base.schema[value].dataType
    news = updates.select(key, *dict.fromkeys([order or value, value])).filter(F.col(value).isNotNull()) \
        .withColumn("_new", F.col(value).cast(kind))
    at = [order, "_new"] if order else ["_new"]
    old = base.select(key, F.col(value).alias("_old"))
    if combine is None:
        u = ordered_concat(news, key, at, "_new", " was ", "_news", falling=True)
        both = F.concat("_news", F.lit(" was "), "_old")
        return old.join(u, key, "full_outer").select(key, F.coalesce(both, "_news", "_old").alias(value))
    turned = lambda acc, new: combine(new, acc)                 # noqa: E731
    if associative:
        u = fold_in_order(news, key, at, "_new", turned, "_news", associative=True)
        last = F.pandas_udf(lambda n, o: pd.Series([combine(x, y) for x, y in zip(n, o)]), kind)
        j = old.join(u, key, "full_outer")
        both = j.filter("_news IS NOT NULL AND _old IS NOT NULL").select(key, last("_news", "_old").alias(value))
        one = j.filter("_news IS NULL OR _old IS NULL").select(key, F.coalesce("_news", "_old").alias(value))
        return both.unionByName(one)
    # the old value is the first of a key's values, the updates follow
    first = old.filter("_old IS NOT NULL").select(key, F.lit(0).alias("_side"), F.lit(None).cast(news.schema[at[0]].dataType).alias("_at"),
                                                  F.col("_old").alias("_new"))
    rest = news.select(key, F.lit(1).alias("_side"), F.col(at[0]).alias("_at"), "_new")
    done = fold_in_order(first.unionByName(rest), key, ["_side", "_at", "_new"], "_new", turned, value)
    none = old.filter("_old IS NULL").select(key, F.lit(None).cast(kind).alias(value)).join(done.select(key), key, "left_anti")
    return done.unionByName(none)


def lookup_default(keys: DataFrame, base: DataFrame, key: str, value: str, default) -> DataFrame:
    """``getOrDefault`` for every key in ``keys`` (left join + coalesce)."""
    b = broadcast_if_small(base.select(key, F.col(value).alias("_v")))
    return keys.select(key).join(b, key, "left") \
        .select(key, F.coalesce(F.col("_v"), F.lit(default)).alias(value))


def replace_where(df: DataFrame, cond: Column, value: str, new_value) -> DataFrame:
    """``replaceAll((k, v) -> cond ? new : v)`` over the whole table."""
    nv = new_value if isinstance(new_value, Column) else F.lit(new_value)
    return df.withColumn(value, F.when(cond, nv).otherwise(F.col(value)))


def counter_totals(df: DataFrame, col: str) -> DataFrame:
    """Shared-counter totals: increments, the ``+2`` counter and the running
    sum of ``col`` - exact totals from one aggregate."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("increments"), (n * 2).alias("plus_two_total"),
                  F.sum(col).alias("sum_of_i"))


def kv_strings(df: DataFrame, key: str, value: str, sep: str = "=") -> Column:
    return F.concat(F.col(key).cast("string"), F.lit(sep), F.col(value).cast("string"))


def kv_entries(df: DataFrame, group: str, key: str, value: str) -> DataFrame:
    """``(group, position, kv)``: the ``k=v`` strings of each group in key
    order, in long form, so that a group of any size is sorted and written by
    many tasks."""
    from ..plans.ranking import positions_in_groups
    rows = df.select(group, F.col(key).alias("_k"), kv_strings(df, key, value).alias("kv"))
    return positions_in_groups(rows, group, ["_k", "kv"], "position").select(group, "position", "kv")


def kv_text(df: DataFrame, group: str, key: str, value: str, sep: str = ", ") -> DataFrame:
    """``(group, text)``: the ``k=v`` strings of each group as one string, in
    key order, joined from ordered segments."""
    rows = df.select(group, F.col(key).alias("_key"), kv_strings(df, key, value).alias("kv"))
    return ordered_concat(rows, group, ["_key", "kv"], "kv", sep, "text")


def search_first(df: DataFrame, group: str, cond: Column, order: str,
                 cols: Sequence[str]) -> DataFrame:
    """Per group, the matching row with the lowest ``order`` value
    (``search`` made deterministic).

    One aggregate, partial before the shuffle: the smallest struct of order
    value and wanted columns.  Rows tied on ``order`` give the one with the
    smallest columns; rows without an order value come last.
    """
    first = F.min(F.struct(F.col(order).isNull().alias("_last"), F.col(order).alias("_at"),
                           *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)]))
    return df.filter(cond).groupBy(group).agg(first.alias("_first")) \
        .select(group, *[F.col(f"_first._c{i}").alias(c) for i, c in enumerate(cols)])


# ----------------------------------------------------------- ordered fold
# acc <- mult * acc + v (mod m), starting from ``init``, over each key's
# values in a stated order.  The operator is not associative, but its
# closed form  acc_n = mult^n * init + sum_i v_i * mult^(n-i)  combines
# contiguous segments:  S_ab = S_a * mult^(n_b) + S_b.  So the rows are
# range-partitioned on (key, order) - a hot key spans several partitions -
# each partition folds its runs (vectorised), and the few runs of one key
# are combined in partition order.

def _modpow_np(base: int, exps: np.ndarray, m: int) -> np.ndarray:
    result = np.ones(len(exps), dtype=np.int64)
    b = np.full(len(exps), base % m, dtype=np.int64)
    e = exps.astype(np.int64).copy()
    while (e > 0).any():
        odd = (e & 1) == 1
        result = np.where(odd, result * b % m, result)
        b = b * b % m
        e >>= 1
    return result


def modpow(base: Column, exp: Column, m: int) -> Column:
    """``base ** exp mod m`` as a Column: square-and-multiply over the bits
    of ``exp`` (the loop runs bit-length + 1 steps, so small exponents are
    cheap)."""
    e0 = exp.cast("bigint")
    init = F.struct(F.lit(1).cast("bigint").alias("r"),
                    F.pmod(base.cast("bigint"), F.lit(m)).alias("b"), e0.alias("e"))
    steps = F.when(e0 > 0, F.floor(F.log2(e0)).cast("int") + 1).otherwise(F.lit(0))

    def step(acc, _):
        odd = F.pmod(acc["e"], F.lit(2)) == 1
        return F.struct(F.when(odd, F.pmod(acc["r"] * acc["b"], F.lit(m))).otherwise(acc["r"]).alias("r"),
                        F.pmod(acc["b"] * acc["b"], F.lit(m)).alias("b"),
                        F.shiftright(acc["e"], 1).alias("e"))
    return F.aggregate(F.sequence(F.lit(0), steps), init, step, lambda a: a["r"])


def ordered_fold(df: DataFrame, key: str, order: Sequence[str], value: str,
                 init: int = 1, mult: int = 2, modulus: int = 1_000_003,
                 partitions: int | None = None, out: str = "fold") -> DataFrame:
    """``(key, fold)`` for ``acc <- (mult * acc + v) mod modulus``.

    ``order`` should be unique within a key (ties leave the order, and so
    the result, undefined).  NULL values are skipped.
    """
    if not 1 < modulus < 3_000_000_000:
        raise ValueError("modulus must be in (1, 3e9) so products fit in 64 bits")
    key_type = df.schema[key].dataType.simpleString()
    cols = ["_k", *order]
    rows = df.filter(F.col(value).isNotNull()).select(
        F.col(key).alias("_k"), *[F.col(c) for c in order], F.col(value).cast("bigint").alias("_v"))
    # without an explicit count AQE may coalesce neighbouring ranges, which
    # keeps partitions contiguous and ordered, so the fold stays exact
    rows = (rows.repartitionByRange(partitions, *cols) if partitions
            else rows.repartitionByRange(*cols)).sortWithinPartitions(*cols)

    def runs(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        carry = None                                  # (key, n, s) of the open run
        for pdf in batches:
            if pdf.empty:
                continue
            k = pdf["_k"].to_numpy()
            v = np.mod(pdf["_v"].to_numpy(dtype=np.int64), modulus)
            new_run = np.r_[True, k[1:] != k[:-1]]
            run_id = np.cumsum(new_run) - 1
            starts = np.flatnonzero(new_run)
            ends = np.r_[starts[1:], len(k)]
            lengths = ends - starts
            after = ends[run_id] - 1 - np.arange(len(k))      # rows after, same run
            terms = v * _modpow_np(mult, after, modulus) % modulus
            s = np.zeros(len(starts), dtype=np.int64)
            np.add.at(s, run_id, terms)
            s %= modulus
            keys = k[starts]
            out_k, out_n, out_s = list(keys), list(lengths.astype(np.int64)), list(s)
            if carry is not None:
                if carry[0] == out_k[0]:
                    n0 = out_n[0]
                    out_s[0] = (carry[2] * int(_modpow_np(mult, np.array([n0]), modulus)[0])
                                + out_s[0]) % modulus
                    out_n[0] = carry[1] + n0
                else:
                    out_k.insert(0, carry[0]); out_n.insert(0, carry[1]); out_s.insert(0, carry[2])
            carry = (out_k[-1], out_n[-1], out_s[-1])
            if len(out_k) > 1:
                yield pd.DataFrame({"_k": out_k[:-1], "pid": pid, "n": out_n[:-1], "s": out_s[:-1]})
        if carry is not None:
            yield pd.DataFrame({"_k": [carry[0]], "pid": pid, "n": [carry[1]], "s": [carry[2]]})

    segs = rows.mapInPandas(runs, f"_k {key_type}, pid int, n long, s long")
    w = Window.partitionBy("_k").orderBy(F.desc("pid")).rowsBetween(Window.unboundedPreceding, -1)
    segs = segs.withColumn("after", F.coalesce(F.sum("n").over(w), F.lit(0)))
    term = F.pmod(F.col("s") * modpow(F.lit(mult), F.col("after"), modulus), F.lit(modulus))
    total = segs.groupBy("_k").agg(F.sum(term).alias("_s"), F.sum("n").alias("_n"))
    res = F.pmod(modpow(F.lit(mult), F.col("_n"), modulus) * F.lit(init % modulus) + F.col("_s"),
                 F.lit(modulus))
    return total.select(F.col("_k").alias(key), res.alias(out))
