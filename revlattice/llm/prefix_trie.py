"""Trie of the common beginnings of conversations, and its subtree totals by tree contraction.

A node is a distinct sequence of first turns. Its name is the XOR of the hashes of (depth, turn) along
the sequence: it adds up in any order, so a conversation of very many turns is named in pieces, and a
node's parent is its name without its own last turn.

Subtree totals come from parallel tree contraction: each round rakes the leaves (a leaf's
total is final and goes to its parent) and compresses unary chains (a node with one child left is
cut out, and its total is put on the edge above the child). Rounds grow with the logarithm of the nodes,
also for a trie that is one long chain. Then the cut-out nodes are put back, last round first, and take
their totals from their child's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from revlattice.functions.ordered import RANGE, carried_before, in_ranges
from revlattice.functions.skew import attach_unique
from revlattice.session import store

#: Conversations that share a beginning, and at most how many of its turns (HEADS - 1).
FAMILY, HEADS = 20, 4
WORDS = r"[^\x20\x09-\x0D]+"
_TOTALS = ("n_leaves", "saved_tokens")


def _half(digest: Column, at: int) -> Column:
    """16 hex digits of a digest as a signed long."""
    parts = [F.conv(F.substring(digest, at + 8 * i, 8), 16, 10).cast("long") for i in (0, 1)]
    return F.shiftleft(parts[0], 32).bitwiseOR(parts[1])


def turns_of(conversations: DataFrame) -> DataFrame:
    """Short rows, one per turn, stored in ranges of their order: conv_id, place (1, 2, ...), turn_hash
    (of role and text, null as empty) and words of the text.

    Turns are in the order of `turn`, null first; those that share it in that of their hash. Rows
    without a conv_id belong to no conversation and are left out. Other columns are ignored.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = conversations.where("conv_id is not null").select(
        "conv_id",
        F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at")).alias("turn"),
        # The role's length keeps role and text apart.
        F.md5(F.concat_ws(":", F.char_length(role).cast("string"), role, text)).alias("turn_hash"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )
    ranged = in_ranges(named, "conv_id", "turn", "turn_hash")
    inside = W.partitionBy(RANGE, "conv_id").orderBy("turn", "turn_hash")
    before = carried_before(ranged, "conv_id", earlier=(F.count("*"), F.sum))
    placed = ranged.withColumn("within", F.row_number().over(inside)).join(before, [RANGE, "conv_id"], "left")
    placed = placed.withColumn("place", F.col("within") + F.coalesce("earlier", F.lit(0)))
    return store(placed.select("conv_id", RANGE, F.col("place").cast("long"), "turn_hash", "words"), "trie-turns")


def _base(conv_id: str = "conv_id") -> Column:
    return F.col(conv_id) - F.col(conv_id) % FAMILY


def _taken(conv_id: str = "conv_id") -> Column:
    return F.crc32(F.col(conv_id).cast("string").cast("binary")) % HEADS


def rebuilt(turns: DataFrame) -> DataFrame:
    """`turns` with each conversation's beginning taken from the first one of its family.

    Conversation c begins with the first h turns of c - c % 20 (all if fewer, none if it is
    absent) and goes on with its own after its first h; h is crc32(c) % 4. Rows as in `turns_of`, with
    `place` counted anew; a conversation without a turn left has one row of place 0.
    """
    heads = turns.where(f"place < {HEADS} and conv_id % {FAMILY} = 0").select(
        F.col("conv_id").alias("base"), F.col("place").alias("head_place"), F.col("turn_hash").alias("head_hash"), F.col("words").alias("head_words")
    )
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("turns")).withColumn("base", _base()).withColumn("h", _taken())
    sizes = heads.groupBy("base").agg(F.count("*").alias("base_turns"))
    convs = lengths.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_turns", F.lit(0))))
    convs = store(convs.select("conv_id", "base", "turns", "h", "taken"), "trie-convs")
    begun = convs.join(heads, "base").where("head_place <= taken").select(
        "conv_id", F.lit(-1).alias(RANGE), F.col("head_place").alias("place"), F.col("head_hash").alias("turn_hash"), F.col("head_words").alias("words")
    )
    # Where the beginning is shorter than h, the own turns move up. Few conversations need it.
    short = convs.where("taken < h").select(F.col("conv_id").cast("string").alias("key"), (F.col("h") - F.col("taken")).alias("less"))
    own = attach_unique(turns.where(F.col("place") > _taken()).withColumn("key", F.col("conv_id").cast("string")), "key", short, "key")
    own = own.select("conv_id", RANGE, (F.col("place") - F.coalesce("less", F.lit(0))).alias("place"), "turn_hash", "words")
    nothing = convs.where("taken = 0 and turns <= h").select(
        "conv_id", F.lit(-1).alias(RANGE), F.lit(0).cast("long").alias("place"), F.lit(None).cast("string").alias("turn_hash"), F.lit(0).cast("long").alias("words")
    )
    return store(begun.unionByName(own).unionByName(nothing), "trie-rebuilt")


def named(turns: DataFrame) -> DataFrame:
    """Per turn its node: conv_id, depth, node, parent (names), words. Rows of place 0 are no turns."""
    mix = F.md5(F.concat_ws(":", F.col("place").cast("string"), "turn_hash"))
    rows = turns.withColumn("hash", mix).select("*", _half(F.col("hash"), 1).alias("x"), _half(F.col("hash"), 17).alias("y"))
    rows = rows.where("place > 0")
    # Within a range, then what lies in the conversation's earlier ranges (its beginning is range -1).
    inside = W.partitionBy(RANGE, "conv_id").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    own = rows.where(F.col(RANGE) >= 0)
    before = carried_before(own, "conv_id", x0=(F.bit_xor("x"), F.bit_xor), y0=(F.bit_xor("y"), F.bit_xor))
    heads = rows.where(F.col(RANGE) < 0).groupBy("conv_id").agg(F.bit_xor("x").alias("x1"), F.bit_xor("y").alias("y1"))
    heads = heads.select(F.col("conv_id").cast("string").alias("key"), "x1", "y1")
    summed = rows.select("*", *[F.bit_xor(c).over(inside).alias(f"{c}_so_far") for c in ("x", "y")])
    summed = summed.join(before, [RANGE, "conv_id"], "left").withColumn(
        "key", F.when(F.col(RANGE) >= 0, F.col("conv_id").cast("string"))
    )
    summed = attach_unique(summed, "key", heads, "key")
    zero = F.lit(0).cast("long")
    x, y = (F.col(f"{c}_so_far").bitwiseXOR(F.coalesce(f"{c}0", zero)).bitwiseXOR(F.coalesce(f"{c}1", zero)) for c in ("x", "y"))

    def name(depth: Column, x: Column, y: Column) -> Column:
        return F.concat_ws(":", depth.cast("string"), F.hex(x), F.hex(y))

    return summed.select(
        "conv_id", F.col("place").alias("depth"), name(F.col("place"), x, y).alias("node"),
        name(F.col("place") - 1, x.bitwiseXOR(F.col("x")), y.bitwiseXOR(F.col("y"))).alias("parent"), "words",
    )


ROOT = "0:0:0"


def members_digest(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of `ends` (node, conv_id): the SHA-256 of a node's ids, ascending and joined by commas.

    Ids are joined within ranges of (node, conv_id) first, so a node at which very many conversations end
    comes to its task as few rows; these run through the hash one after the other.
    """
    ranged = in_ranges(ends, "node", "conv_id")
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",")
    pieces = ranged.groupBy(RANGE, "node").agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for name, ids in zip(batch["node"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if name == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256(ids.encode())
            yield _digest_rows(done)
        if node is not None:
            yield _digest_rows([(node, state.hexdigest())])

    return pieces.repartition("node").sortWithinPartitions("node", RANGE).mapInArrow(run, "node string, ends_sha256 string")


def _digest_rows(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    names, digests = zip(*rows, strict=True) if rows else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(digests, pa.string())], ["node", "ends_sha256"])


def subtree_totals(nodes: DataFrame, totals: tuple[str, ...] = _TOTALS, max_rounds: int = 200) -> DataFrame:
    """(node, <totals>): for every node the sums over its subtree, itself included.

    `nodes` has node, parent (null for the root) and each of `totals`, the node's own share. Parallel
    tree contraction; every round is written to the shared folder. A node keeps what is
    raked into it in its own columns, and what was cut out between it and its parent in
    `edge_` ones, so its contribution to the parent is both.
    """
    edge = [f"edge_{c}" for c in totals]
    alive = store(nodes.select("node", "parent", *totals, *[F.lit(0).cast("long").alias(c) for c in edge]), "trie-alive")
    finished, cut_out = [], []
    for number in range(max_rounds):
        kids = alive.where("parent is not null").select(F.col("parent").alias("of")).distinct()
        marked = alive.join(kids, alive["node"] == kids["of"], "left").withColumn("leaf", F.col("of").isNull()).drop("of")
        marked = store(marked, "trie-marked")
        leaves = marked.where("leaf")
        if leaves.isEmpty():
            break
        finished.append(leaves.select("node", *totals))
        # Rake: sums go to the parents. What is left of a parent's children is counted beside them.
        raked = marked.where("parent is not null").groupBy(F.col("parent").alias("of")).agg(
            *[F.sum(F.when(F.col("leaf"), F.col(c) + F.col(e)).otherwise(0)).alias(f"raked_{c}") for c, e in zip(totals, edge, strict=True)],
            F.count_if(~F.col("leaf")).alias("left_over"),
            F.min(F.when(~F.col("leaf"), F.col("node"))).alias("only"),
        )
        inner = marked.where("not leaf").join(raked, F.col("node") == F.col("of")).select(
            "node", "parent", *[(F.col(c) + F.col(f"raked_{c}")).alias(c) for c in totals], *edge, F.when(F.col("left_over") == 1, F.col("only")).alias("only")
        )
        # Compress: of a chain's nodes those that drew 1 and whose child drew 0, so no two side by side.
        goes = F.col("only").isNotNull() & F.col("parent").isNotNull() & (_coin("node", number) == 1) & (_coin("only", number) == 0)
        inner = store(inner.withColumn("goes", F.coalesce(goes, F.lit(False))), "trie-inner")
        gone = inner.where("goes").select(
            F.col("node").alias("cut_node"), F.col("parent").alias("cut_parent"), F.col("only").alias("child"),
            *[F.col(c).alias(f"cut_{c}") for c in (*totals, *edge)],
        )
        stay = inner.where("not goes").drop("goes", "only").join(gone, F.col("node") == F.col("child"), "left")
        stay = store(stay, "trie-stay")
        # A cut-out node's total is its child's, the child's old edge and its own.
        cut_out.append(
            stay.where("cut_node is not null").select(
                F.col("cut_node").alias("node"), F.col("node").alias("child"),
                *[(F.col(f"cut_{c}") + F.col(e)).alias(c) for c, e in zip(totals, edge, strict=True)],
            )
        )
        alive = stay.select(
            "node",
            F.coalesce("cut_parent", "parent").alias("parent"),
            *totals,
            *[(F.col(e) + F.coalesce(F.col(f"cut_{c}") + F.col(f"cut_{e}"), F.lit(0))).alias(e) for c, e in zip(totals, edge, strict=True)],
        )
    else:
        raise RuntimeError(f"the trie did not contract in {max_rounds} rounds")
    known = _union(finished) if finished else alive.select("node", *totals)
    for cut in reversed(cut_out):
        below = known.select(F.col("node").alias("below"), *[F.col(c).alias(f"below_{c}") for c in totals])
        back = cut.join(below, F.col("child") == F.col("below")).select(
            "node", *[(F.col(c) + F.col(f"below_{c}")).alias(c) for c in totals]
        )
        known = known.unionByName(store(back, "trie-back"))
    return known


def _coin(name: str, number: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(number), F.col(name)), F.lit(2))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def trie(turns: DataFrame) -> DataFrame:
    """Per node of the trie of `turns` (as from `turns_of` or `rebuilt`): conv_id (the smallest
    that begins with it), depth, parent_conv_id (its parent's; null for the root), n_convs, n_children,
    n_leaves (childless nodes in its subtree), saved_tokens (in its subtree: words that need not be
    worked on again where conversations share a turn) and ends_sha256 (of those that end there).

    Every turn counts, repeated ones as well. Without conversations there is no node.
    """
    rows = store(named(turns), "trie-named")
    last = turns.groupBy("conv_id").agg(F.max("place").alias("depth"))
    per_node = rows.groupBy("node", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words")
    )
    root = last.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
        "conv_id", "n_convs", F.lit(0).cast("long").alias("words"),
    )
    nodes = store(per_node.unionByName(root), "trie-nodes")
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("of")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(kids, F.col("node") == F.col("of"), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).drop("of")
    counted = store(counted, "trie-counted")
    shares = counted.select(
        "node", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    )
    totals = subtree_totals(shares).select(F.col("node").alias("total_of"), *_TOTALS)
    # A conversation ends at its deepest node; those without a turn end at the root.
    deepest = rows.groupBy("conv_id").agg(F.max_by("node", "depth").alias("node"))
    ends = deepest.unionByName(last.where("depth = 0").select("conv_id", F.lit(ROOT).alias("node")))
    digests = members_digest(ends).select(F.col("node").alias("ends_at"), "ends_sha256")
    full = counted.join(totals, F.col("node") == F.col("total_of")).join(digests, F.col("node") == F.col("ends_at"), "left")
    above = counted.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id")).groupBy("above").agg(
        F.min("parent_conv_id").alias("parent_conv_id")
    )
    return attach_unique(full, "parent", above, "above").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *_TOTALS,
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


#: The same results in SQL, on lists of turns. CRC-32 is worked out bit by bit.
TRIE_SQL = r"""
WITH own AS (
    SELECT conv_id, list([coalesce(role, ''), coalesce(text, '')]
                         ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
drawn AS (
    SELECT conv_id, turns, list_reduce([4294967295] || [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(conv_id AS VARCHAR), '')],
               lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS crc
    FROM own),
begun AS (
    SELECT d.conv_id, CAST(xor(crc, 4294967295) % 4 AS INTEGER) AS h, d.turns AS mine, coalesce(b.turns, []) AS base
    FROM drawn d LEFT JOIN own b ON b.conv_id = d.conv_id - d.conv_id % 20),
made AS (SELECT conv_id, base[1:h] || mine[h + 1:] AS turns FROM begun),
prefixes AS (SELECT conv_id, len(turns) AS total, turns[1:d] AS path, d FROM made, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d)),
nodes AS (
    SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (total = d), '')) AS ends_sha256
    FROM prefixes GROUP BY 1, 2),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children,
           CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(n.path[depth][2], '[^\x20\x09-\x0D]+')) END AS saved
    FROM nodes n LEFT JOIN kids k ON k.path = n.path),
above AS (SELECT path[1:d] AS path, CAST(sum(saved) AS BIGINT) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
          FROM counted, LATERAL (SELECT unnest(range(depth + 1)) AS d) GROUP BY 1)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, a.n_leaves, a.saved_tokens, c.ends_sha256
FROM counted c JOIN above a ON a.path = c.path LEFT JOIN nodes p ON c.depth > 0 AND p.path = c.path[1:c.depth - 1]"""
