"""Grouping that keeps members, and group reductions.

A group's members are never gathered into one row unless the group is
proven small: the default long form keeps one row per member with its group
key (and the group size), which Spark can partition, spill and skew-split
like any other table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small


def group_members(df: DataFrame, key: Column, member: str, key_name: str = "key") -> DataFrame:
    """``(key, member, group_size)``: the grouping ``b.groupby(f)`` in long form.

    Group sizes come from a partial/final aggregate and are joined back on
    the key, null-safely, so the members with a NULL key stay; a hot key is
    handled by AQE's skew-join split of the member side, and the size table is
    broadcast only if it is proven small.
    """
    m = df.select(key.alias(key_name), F.col(member))
    sizes = m.groupBy(F.col(key_name).alias("_group")).agg(F.count(F.lit(1)).alias("group_size"))
    return m.join(broadcast_if_small(sizes), F.col(key_name).eqNullSafe(F.col("_group"))).drop("_group")


def ordered_members(df: DataFrame, key: Column, member: str, key_name: str = "key",
                    name: str = "position") -> DataFrame:
    """``(key, position, member)``: the members of each group in ascending
    order, counted from 1, in long form.  Positions come from the distributed
    global rank, so a hot group is sorted by many tasks."""
    from ..plans.ranking import positions_in_groups
    m = df.select(key.alias(key_name), F.col(member))
    return positions_in_groups(m, key_name, [member], name).select(key_name, name, member)


def group_reduce(df: DataFrame, key: Column, aggs: dict[str, Column],
                 key_name: str = "key") -> DataFrame:
    """Group then reduce each group with built-in aggregates (members are
    never materialised)."""
    return df.groupBy(key.alias(key_name)).agg(*[a.alias(n) for n, a in aggs.items()])
