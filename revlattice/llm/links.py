"""Links inside buckets without one task per bucket, and components of links.

Near-duplicate operators put rows into buckets and check the pairs inside each. A bucket can
hold a third of all rows, so its rows are dealt into blocks and every pair of blocks is a group
of its own; a group gives back at most one row per member, never its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.session import store

BLOCK = 512


def in_blocks(members: DataFrame, key: str, by: str, block: int = BLOCK, drop_single: bool = False) -> DataFrame:
    """`members`, once for each pair of blocks of their bucket that they are in.

    Adds `bucket_i`, `bucket_j` (the pair of blocks) and `bucket_b` (the row's own block, by a
    hash of column `by`). Only buckets of more than `block` rows are cut; one of n rows is sent
    ceil(n / block) times. `drop_single` leaves out rows that are alone in their bucket, which
    costs a shuffle of whole rows and pays where rows are long and mostly alone.
    """
    sizes = members.groupBy(key).agg(F.count("*").alias("bucket_n"))
    if drop_single:
        sized = members.join(sizes.where("bucket_n > 1"), key)
    else:
        sized = members.join(sizes.where(F.col("bucket_n") > block), key, "left")
    blocks = F.ceil(F.coalesce("bucket_n", F.lit(1)) / block)
    dealt = sized.withColumn("bucket_b", F.pmod(F.xxhash64(by), blocks).cast("int")).withColumn(
        "bucket_o", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    )
    return dealt.select(
        *members.columns,
        F.least("bucket_b", "bucket_o").alias("bucket_i"),
        F.greatest("bucket_b", "bucket_o").alias("bucket_j"),
        "bucket_b",
    )


def by_group(
    dealt: DataFrame, key: str, fn: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch], schema: str
) -> DataFrame:
    """Run `fn(rows, group)` over whole groups of `in_blocks`; `group` numbers them, ascending.

    Groups stream through sorted partitions, many small ones at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            group = _numbers(rows, key)
            # The last group may go on in the next batch.
            cut = int(np.searchsorted(group, group[-1])) if len(group) else 0
            kept = rows.slice(cut)
            if cut:
                yield fn(_one(rows.slice(0, cut)), group[:cut])
        if kept is not None and kept.num_rows:
            yield fn(_one(kept), _numbers(kept, key))

    names = [key, "bucket_i", "bucket_j"]
    return dealt.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, schema)


def _one(rows: pa.Table) -> pa.RecordBatch:
    return rows.combine_chunks().to_batches()[0]


def _numbers(rows: pa.Table, key: str) -> np.ndarray:
    new = np.zeros(rows.num_rows, dtype=bool)
    for name in (key, "bucket_i", "bucket_j"):
        values = rows[name].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


def pairs_within(group: np.ndarray, block: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (u < v) of rows of one group, by their distance in the sorted rows.

    In a group of two different blocks (`cross`) only pairs between the blocks: the others are
    in the groups of one block.
    """
    n = len(group)
    u = np.arange(n)
    for d in range(1, n):
        u = u[u + d < n]
        u = u[group[u] == group[u + d]]
        if not len(u):
            return
        v = u + d
        keep = ~cross[u] | (block[u] != block[v])
        if keep.any():
            yield u[keep], v[keep]


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Of each of n items the smallest item that the links u-v reach."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        # Also carry the low label to the label's own item, then jump.
        np.minimum.at(label, before[u], low)
        np.minimum.at(label, before[v], low)
        label = label[label]
        if np.array_equal(label, before):
            return label


def anew(key: str) -> Column:
    """The same integer as a new expression: an aggregate on `key` is not yet dealt by it, so it is
    shuffled for a join, whose other side AQE can then split."""
    return F.bitwise_not(F.bitwise_not(key))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that links reach, for every node of `edges` (u, v).

    Alternating large and small stars: in each round every node links its larger neighbours,
    then itself and its smaller ones, to the smallest of them, until nothing changes. Rounds
    grow with the logarithm of the longest chain. Every round is written to the shared folder.
    Hot nodes only meet an aggregate, which is shuffled once more, so that AQE can split them.
    """
    pair = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links, seen = store(pair.distinct(), "links"), None
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(anew("u").alias("k"), F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(anew("u").alias("k"), "m")
        small = (
            large.join(low, F.col("u") == F.col("k"))
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
            .select(F.col("x.v").alias("u"), F.col("x.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        links = store(small, "links")
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots_ = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots_)
