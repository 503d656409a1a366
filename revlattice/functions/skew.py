"""Joins that stay spread out when one key, or NULL, holds a large share of the rows.

Between two plainly shuffled sides AQE splits a hot partition: of either side in an inner
join, of the left in a left or anti join. It does not when a side comes straight out of an
aggregate on the join key, since that side is then not shuffled for the join. These
helpers aggregate the right side, which removes its hot keys, and have it shuffled again,
which lets AQE split the left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _reshuffled(key: str) -> Column:
    """The same text as a new expression, by which the side is not yet partitioned."""
    return F.concat(F.col(key), F.lit(""))


def keep_unmatched(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Left rows whose (text) key does not occur on the right; NULL keys are kept."""
    known = right.where(F.col(right_key).isNotNull()).select(F.col(right_key).alias("_any"))
    known = known.distinct().select(_reshuffled("_any").alias("_key"))
    return left.join(known, F.col(left_key) == F.col("_key"), "left_anti")


def attach_unique(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Left join to an aggregate with one row per (text) key; its key column is dropped."""
    kept = [c for c in right.columns if c != right_key]
    keyed = right.where(F.col(right_key).isNotNull()).select(
        _reshuffled(right_key).alias("_key"), *kept
    )
    return left.join(keyed, F.col(left_key) == F.col("_key"), "left").drop("_key")
