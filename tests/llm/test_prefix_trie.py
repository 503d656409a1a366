"""The conversation trie against one built in Python, node by node."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from revlattice.llm import prefix_trie
from revlattice.llm.queries import ORACLE, QUERIES
from tests.compare import compare, duck
from tests.conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string, node string, parent string, words string"


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small data stays in several partitions, so that ranges have neighbours."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def tidy(rows):
    """conv_id -> turns in order."""
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            found.setdefault(conv, []).append((turn is not None, turn or 0, key, role, text))
    return {conv: [t[3:] for t in sorted(turns)] for conv, turns in found.items()}


def rebuild(own):
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        out[conv] = own.get(conv - conv % 20, [])[:h] + turns[h:]
    return out


def slow(conversations):
    members, ends = {}, {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
        ends.setdefault(tuple(turns), []).append(conv)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        below = kids.get(path, [])
        leaves[path] = sum(leaves[k] for k in below) or 1
        saved[path] = (len(members[path]) - 1) * words + sum(saved[k] for k in below)
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def made(seed=3, convs=90):
    rnd = random.Random(seed)
    rows = []
    for conv in range(convs):
        if conv % 20 == 0 and rnd.random() < 0.4:
            continue  # its family begins with nothing
        for turn in range(rnd.choice([1, 1, 2, 3, 4, 7])):
            at = None if rnd.random() < 0.1 else turn // rnd.choice([1, 1, 2])
            rows.append((conv, at, rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "hi there", "", None, "a\tb c", "é 😀"])))
    rows += [rows[0]] * 2 + [(None, 1, "user", "no conversation"), (41, None, None, None)]
    rows += [(1000 + i, t, "user", "the same") for i in range(30) for t in range(3)]  # many copies
    rows += [(2000, t, "user", f"turn {t}") for t in range(30)]  # one long chain
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", "p", "w") for r in rows], SCHEMA)


def test_equals_a_trie_built_in_python(spark):
    rows = made()
    turns = prefix_trie.turns_of(frame(spark, rows))
    own = tidy(rows)
    got = sorted(map(tuple, prefix_trie.trie(prefix_trie.rebuilt(turns)).collect()))
    assert got == slow(rebuild(own))
    assert any(not turns for turns in rebuild(own).values())  # one without a turn left
    # Without the rebuilding step, the operator serves any conversations.
    assert sorted(map(tuple, prefix_trie.trie(turns).collect())) == slow(own)


def test_no_conversations(spark):
    none = prefix_trie.turns_of(frame(spark, []))
    assert prefix_trie.trie(prefix_trie.rebuilt(none)).count() == 0
    assert prefix_trie.trie(prefix_trie.turns_of(frame(spark, [(None, 1, "user", "x")]))).count() == 0


def test_a_long_conversation_is_spread_and_named_in_pieces(spark):
    n = 3000
    long = spark.range(n).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.col("id").cast("string").alias("text"))
    turns = prefix_trie.turns_of(long)
    spread = turns.groupBy("range_no").count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < n * 0.6
    assert [r[0] for r in turns.orderBy("place").select("place").collect()] == list(range(1, n + 1))
    names = prefix_trie.named(turns)
    assert names.select("node").distinct().count() == n
    # Every node but the first has the node before it as parent.
    before = names.select(F.col("node").alias("up"), (F.col("depth") + 1).alias("next_depth"))
    assert names.join(before, names["parent"] == before["up"]).where("depth = next_depth").count() == n - 1


def test_rounds_grow_with_the_logarithm_of_a_chain(spark):
    """A chain of 150 nodes and a star of 200: few rounds, exact sums."""
    chain = [(f"c{i}", f"c{i - 1}" if i else "top", 1, i) for i in range(150)]
    star = [(f"s{i}", "hub", 1, 2) for i in range(200)]
    nodes = spark.createDataFrame([("top", None, 0, 0), ("hub", "c7", 5, 5), *chain, *star], "node string, parent string, n_leaves long, saved_tokens long")
    got = {r["node"]: (r["n_leaves"], r["saved_tokens"]) for r in prefix_trie.subtree_totals(nodes, max_rounds=40).collect()}
    hub = (205, 405)
    want = {"top": (150 + 205, sum(range(150)) + 405), "hub": hub} | {f"s{i}": (1, 2) for i in range(200)}
    want |= {f"c{i}": (150 - i + (205 if i <= 7 else 0), sum(range(i, 150)) + (405 if i <= 7 else 0)) for i in range(150)}
    assert got == want


def test_many_members_reach_a_digest_as_few_rows(spark):
    ends = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("n"), "id")).alias("node"), F.col("id").alias("conv_id"))
    got = {r["node"]: r["ends_sha256"] for r in prefix_trie.members_digest(ends).collect()}
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got["hot"] == sha([i for i in range(5000) if i % 3])
    assert len(got) == 1 + len(range(0, 5000, 3)) and got["n9"] == sha([9])


def test_query_equals_its_sql(spark):
    problem, n = compare(QUERIES["op13_prefix_trie"](spark, SF), duck(SF), ORACLE["op13_prefix_trie"])
    assert problem is None and n > 50
