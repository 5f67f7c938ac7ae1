"""Mixing sources to target weights by Sainte-Lague apportionment.

1. **Targets.**  Sources share the whole token count by weight; a source
   stops at ``max_repeats`` times its size and the excess is shared again by
   weight until no source is above.
2. **Apportionment.**  The targets of the sources with at least
   ``MIN_BLOCKS`` blocks are cut into equal blocks of ``block_tokens`` tokens,
   those of smaller sources, in a second pass, into blocks of one.  Blocks go
   to the sources by highest quotients ``target / (2 s + 1)`` (Sainte-Lague),
   and a source's blocks go to its shards the same way by shard size: one
   integer quota per shard.  Shards
   are hash buckets of about ``shard_docs`` documents, so a source with a
   third of all rows is spread over many.
3. **Block selection.**  In a shard the documents stand in a seeded order and
   form one run of tokens.  The quota first takes the whole run as often as
   it fits, and then the run of blocks that starts at a seeded block
   (wrapping around at the end), so at most two documents of a shard are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from ..plans.ranking import global_row_number
from .common import materialize

MIN_BLOCKS = 200                # a source of fewer blocks is dealt in blocks of one token
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    """Number of words of a text column; null texts count 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("bigint")


def highest_quotients(parties: DataFrame, group: str, seats: str, weight: str, order: list[str]) -> DataFrame:
    """``parties`` plus ``quota``: ``seats`` of each ``group`` given to its
    parties by highest quotients ``weight / (2 s + 1)``; ties go to the party
    first by ``order``, whose columns (with ``group``) name a party and are not null.

    Every party starts with its rounded share; the seats that are missing (or
    too many) after rounding are then given to the highest next quotients (or
    taken from the lowest last ones).  A party can gain or lose at most its
    share of that difference and of the party count, so each offers only that
    many quotients and the work grows with the number of parties, not of
    seats.  Parties of weight 0 get nothing; a group of weight 0 gets nothing.
    """
    g = Window.partitionBy(group)
    p = (parties.withColumn("_w", F.sum(weight).over(g)).withColumn("_n", F.count(F.lit(1)).over(g))
                .withColumn("_share", F.when(F.col("_w") > 0, F.col(seats) * F.col(weight) / F.col("_w")).otherwise(0.0))
                .withColumn("_start", F.round("_share").cast("bigint"))
                .withColumn("_miss", F.when(F.col("_w") > 0, F.col(seats) - F.sum("_start").over(g)).otherwise(0)))
    most = F.least(F.abs("_miss"), (F.ceil(F.when(F.col("_w") > 0, F.col(weight) * (F.abs("_miss") + F.col("_n")) / F.col("_w"))
                                           .otherwise(0.0)) + 1))
    most = F.when(F.col("_miss") < 0, F.least(most, F.col("_start"))).otherwise(most)
    most = F.when(F.col(weight) > 0, most).otherwise(0).cast("bigint")
    offers = (p.withColumn("_most", most).filter("_most > 0")
               .select(group, *order, weight, "_start", "_miss", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_most") - 1)).alias("_j"))
               .withColumn("_quotient", F.when(F.col("_miss") > 0, F.col(weight) / (2 * (F.col("_start") + F.col("_j")) + 1))
                                         .otherwise(-F.col(weight) / (2 * (F.col("_start") - F.col("_j")) - 1))))
    rank = Window.partitionBy(group).orderBy(F.col("_quotient").desc(), *order)
    moved = (offers.withColumn("_rank", F.row_number().over(rank)).filter(F.col("_rank") <= F.abs("_miss"))
                   .groupBy(group, *order).agg(F.count(F.lit(1)).alias("_moved")))
    quota = F.col("_start") + F.signum("_miss").cast("bigint") * F.coalesce("_moved", F.lit(0))
    return p.join(moved, [group, *order], "left").select(*parties.columns, quota.alias("quota"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_repeats: int) -> DataFrame:
    """``(source, source_size, docs, place, weight, target)`` from
    ``(source, size)`` rows.  Sources stand in code point order, null last,
    and weigh ``weights`` in turn."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    per = per.withColumn("_last", F.col("source").isNull().cast("int"))
    per = global_row_number(per, ["_last", "source"], name="place").drop("_last")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    per = materialize(per.withColumn("weight", F.element_at(turn, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))),
                      "sources")
    limit = F.col("source_size") * max_repeats
    full = None                                   # sources that stopped, as limit / weight below this level
    while True:
        stopped = F.lit(False) if full is None else limit / F.col("weight") <= full
        s = per.agg(F.sum("source_size").alias("all"), F.sum(F.when(stopped, limit).otherwise(0)).alias("fixed"),
                    F.sum(F.when(stopped, 0.0).otherwise(F.col("weight"))).alias("open"),
                    F.sum(stopped.cast("int")).alias("n")).first()
        level = (s["all"] - s["fixed"]) / s["open"] if s["open"] else None
        if level is None or (full is not None and level <= full):
            break
        if per.filter(~stopped & (limit / F.col("weight") < level)).isEmpty():
            break
        full = level
    stopped = F.lit(False) if full is None else limit / F.col("weight") <= full
    share = F.col("weight") * float(level) if level is not None else F.lit(0.0)
    return per.withColumn("target", F.when(stopped, limit.cast("double")).otherwise(share))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_repeats: int = 3, block_tokens: int = 32,
        shard_docs: int = 4096, seed: int = 5, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size,
    target, taken, copies, spans`` and the columns named in ``carry``.

    ``taken`` counts the words the mix takes from the document: ``copies``
    times the whole text and the word ranges ``spans`` (``start, length``,
    counted in words from 0).  Null and empty texts have size 0 and are taken
    0 times; null sources form one source that stands last; repeated rows are
    documents of their own; null ids are allowed.  An empty table gives an
    empty result; if no document has a word, all targets are 0.  The result
    depends on the rows and the seed only, not on their order.
    """
    keep = [F.col(c).alias(f"carry_{c}") for c in carry]
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                        word_count(text).alias("size"), *keep)
    small = materialize(sized.select("doc_id", "source", "size"), "sizes")
    src = source_targets(small, weights, max_repeats)
    # a source of few blocks is dealt word by word, so that rounding to blocks never shows in it, whatever the corpus
    src = src.withColumn("block", F.when(F.col("target") >= MIN_BLOCKS * block_tokens, block_tokens).otherwise(1).cast("bigint"))
    seats = src.groupBy("block").agg(F.sum("target").alias("_all")) \
               .select("block", F.round(F.col("_all") / F.col("block")).cast("bigint").alias("blocks"))     # two rows at most
    src = src.join(F.broadcast(seats), "block")
    src = highest_quotients(src, "block", "blocks", "target", ["place"]).withColumnRenamed("quota", "source_blocks") \
        .withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("docs") / shard_docs)).cast("bigint"))
    src = materialize(src.select("source", "source_size", "place", "target", "block", "source_blocks", "shards"), "targets")

    def placed(df: DataFrame) -> DataFrame:
        s = broadcast_if_small(src)
        return df.join(s, df["source"].eqNullSafe(s["source"])).drop(s["source"]) \
                 .withColumn("shard", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.col("shards")))

    shards = placed(small).groupBy("place", "shard").agg(
        F.sum("size").alias("shard_size"), F.max("source_blocks").alias("source_blocks"), F.max("block").alias("block"))
    shards = highest_quotients(shards, "place", "source_blocks", "shard_size", ["shard"])
    tokens = F.least(F.col("quota") * F.col("block"), F.col("shard_size") * max_repeats)
    copies = F.when(F.col("shard_size") > 0, F.expr("_tokens div shard_size")).otherwise(0)
    n_blocks = F.ceil(F.col("shard_size") / F.col("block")).cast("bigint")
    shards = (shards.withColumn("_tokens", tokens).withColumn("copies", copies)
                    .withColumn("run", F.when(F.col("shard_size") > 0, F.col("_tokens") - F.col("copies") * F.col("shard_size")).otherwise(0))
                    .withColumn("first", F.when(n_blocks > 0, F.col("block") * F.pmod(F.xxhash64("place", "shard", F.lit(seed + 1)), n_blocks)).otherwise(0))
                    .select("place", "shard", "shard_size", "copies", "run", "first"))
    shards = materialize(shards, "quotas")

    order = Window.partitionBy("place", "shard").orderBy(F.xxhash64("doc_id", F.lit(seed + 2)), "doc_id", "size") \
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = placed(sized).withColumn("end", F.sum("size").over(order)) \
                       .join(broadcast_if_small(shards), ["place", "shard"]) \
                       .withColumn("begin", F.col("end") - F.col("size"))
    # the run [first, first + run) of the shard's tokens, wrapped around its end
    lo1, hi1 = F.greatest("begin", "first"), F.least("end", F.col("first") + F.col("run"))
    lo2, hi2 = F.col("begin"), F.least("end", F.col("first") + F.col("run") - F.col("shard_size"))
    span = lambda lo, hi: F.struct((lo - F.col("begin")).alias("start"), F.greatest(hi - lo, F.lit(0)).alias("length"))
    spans = F.filter(F.array(span(lo2, hi2), span(lo1, hi1)), lambda s: s["length"] > 0)
    taken = F.col("copies") * F.col("size") + F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["length"])
    return run.withColumn("spans", spans).select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "copies", "spans",
        *[F.col(f"carry_{c}") for c in carry])
