"""Neighbours and positions in a global order, without one ordered task.

Rows are dealt into ranges of the order and each range is sorted on its own. What a range must
know of the others (its successor's first row, the rows of a group that lie in earlier ranges)
is carried from one row per range, so only as many rows as there are ranges are ever ordered
in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlattice.session import store

RANGE = "range_no"


def in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """`df` dealt into ranges of `order` and stored; `range_no` numbers them in order.

    Stored, as the bounds are sampled: every reader must see the same ranges. Only rows equal in
    all of `order` are sure to share a range, so a hot first column is spread over the others.
    """
    dealt = df.repartitionByRange(*[F.col(c) for c in order])
    return store(dealt.withColumn(RANGE, F.spark_partition_id()), "ranges")


def with_next(df: DataFrame, key: str, wrap: bool = False) -> DataFrame:
    """`df` with `next`, a struct of the columns of the row after it in the order of column `key`.

    `key` must be unique and orderable, and may be a struct. The last row has no next; with
    `wrap` it is followed by the first.
    """
    ranged, row = in_ranges(df, key), F.struct(*[F.col(c) for c in df.columns])
    heads = ranged.groupBy(RANGE).agg(F.min_by(row, key).alias("head"))
    by_range = W.orderBy(RANGE)
    follower = F.lead("head").over(by_range)
    if wrap:
        everything = by_range.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        follower = F.coalesce(follower, F.first("head").over(everything))
    after = heads.select(F.col(RANGE).alias("of_range"), follower.alias("follower"))
    inside = ranged.withColumn("inner_next", F.lead(row).over(W.partitionBy(RANGE).orderBy(key)))
    # Rows in the middle of a range need no follower, so their key is null and meets nothing.
    asked = F.when(F.col("inner_next").isNull(), F.col(RANGE))
    return inside.join(after, asked == F.col("of_range"), "left").select(
        *df.columns, F.coalesce("inner_next", "follower").alias("next")
    )


def carried_before(ranged: DataFrame, group: str, **totals) -> DataFrame:
    """(range_no, group, <totals>): for groups that earlier ranges hold rows of, the totals of those rows.

    `ranged` must be in ranges ordered by `group` first: then only the first group of a range can
    go on from earlier ones, and only a range's last group can go on in later ones. `totals` are
    pairs of an aggregate within a range and one that adds such aggregates up.
    """
    per_range = ranged.groupBy(RANGE, group).agg(*[inner.alias(name) for name, (inner, _) in totals.items()])
    ends = ranged.groupBy(RANGE).agg(F.min(group).alias("first_group"), F.max(group).alias("last_group"))
    edges = per_range.join(ends, RANGE).where(F.col(group).isin(F.col("first_group"), F.col("last_group")))
    # At most two rows a range.
    before = W.partitionBy(group).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    summed = [outer(F.col(name)).over(before).alias(name) for name, (_, outer) in totals.items()]
    some = F.col(next(iter(totals)))
    return edges.select(RANGE, group, *summed).where(some.isNotNull())
