"""What must stay in proportion: copies, hubs, long texts, and what is shuffled or sent."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlattice.llm import embedding_dedup, links, mixing, secrets, tiling


@pytest.fixture
def plain_joins(spark):
    """No broadcasts by size, no merging of small partitions."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- 2 mixing


def test_texts_of_the_mix_are_shuffled_once(spark, plain_joins):
    docs = spark.range(300).selectExpr("id as doc_id", "concat('text ', id) as text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source")
    mixed = mixing.mix_sources(docs)
    text = plan(mixed)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and text.count("Exchange") - text.count("BroadcastExchange") == 1
    want = sorted(map(str, mixed.collect()))
    # Beyond the bound the rates are joined by source, with the same result.
    few, mixing.SENT_SOURCES = mixing.SENT_SOURCES, 1
    try:
        joined = mixing.mix_sources(docs)
        assert "SortMergeJoin" in plan(joined) and sorted(map(str, joined.collect())) == want
    finally:
        mixing.SENT_SOURCES = few


# --- 3 embeddings


def test_copies_of_a_vector_are_sent_once(spark, monkeypatch):
    """Two classes of many copies that link, and some vectors alone: rows sent do not grow with copies."""
    sent = []
    by_group = links.by_group
    monkeypatch.setattr(links, "by_group", lambda dealt, *more: sent.append(dealt.count()) or by_group(dealt, *more))
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    near = base + rng.normal(size=16) * 0.01
    alone = [rng.normal(size=16) for _ in range(20)]
    for copies in (50, 1500):
        rows = [(i, (base if i % 2 else near).tolist(), 1) for i in range(2 * copies)]
        rows += [(10_000 + i, v.tolist(), 1) for i, v in enumerate(alone)] + [(20_000, base.tolist(), 2), (20_001, base.tolist(), None)]
        got = {r["vec_id"]: r for r in embedding_dedup.near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
        assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (2 * copies - 1, 0, i == 0) for i in range(2 * copies))
        assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i in (20_000, 20_001))
        want = {(i, j) for i, j in embedding_dedup.brute_links([(0, base, 1), (1, near, 1), *((n, v, 1) for n, v in enumerate(alone, 2))], 0.98)}
        assert want == {(0, 1)}
    assert sent[0] == sent[1]


def test_a_hub_of_links_can_be_split(spark, plain_joins):
    """The aggregate that hot nodes meet is shuffled for the join, which AQE needs to split the other side."""
    edges = spark.range(500).select(F.floor(F.col("id") / 1000).cast("long").alias("u"), (F.col("id") + 1).alias("v"))
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select(links.anew("u").alias("k"), "m")
    joined = edges.join(low, F.col("u") == F.col("k"))
    joined.collect()
    assert plan(joined).split("== Initial Plan ==")[0].count("ShuffleQueryStage") == 3
    assert {r["root"] for r in links.components(edges).collect()} == {0}


# --- 8 secrets


def test_many_matches_in_one_text_cost_in_proportion(spark):
    def took(n):
        text = " ".join(f"{i:016x}" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.time()
        row = secrets.find_secrets(docs).collect()[0]
        assert row["n_hex"] == n and row["spans"].startswith("hex:0:16,hex:17:33")
        return time.time() - start

    took(100)
    few, many = took(4000), took(24_000)
    assert many < 6 * max(few, 1.0) + 5


def test_ends_of_pieces(spark):
    texts = ["", "a", "a/b", "//", "é/☃😀/x//y", "/".join("ab" * (i % 4) for i in range(300))]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", secrets.ends_of(F.split("t", "/", -1), between=1).alias("ends"))
    for r in frame.collect():
        at, want = 0, []
        for piece in r["t"].split("/"):
            at += len(piece)
            want.append(at)
            at += 1
        assert r["ends"] == want


def battery(token, symbols, excess=secrets.TEXT_EXCESS):
    """(passes, step) of a token, by the tests' definitions: chi-squared, runs about the middle, serial
    correlation, and the chance that text of its length looks as uniform."""
    below = lambda z: 1 / (1 + math.exp(-1.5976 * max(-12, min(12, z)) - 0.07056 * max(-12, min(12, z)) ** 3))
    n, a = len(token), len(symbols)
    p = [symbols.index(c) + 1 for c in token]
    chi = sum(token.count(c) ** 2 for c in set(token)) * a / n - n
    df = a - 1
    uniform = ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    high = [v > a / 2 for v in p]
    twice = 2 * sum(high) * (n - sum(high))
    runs = 1 + sum(u != v for u, v in zip(high, high[1:], strict=False))
    mean = sum(p) / n
    spread = sum((v - mean) ** 2 for v in p)
    if not twice or not spread:
        return False, None
    z_runs = (runs - twice / n - 1) / math.sqrt(max(twice * (twice - n) / (n * n * (n - 1)), 1e-9))
    serial = sum((u - mean) * (v - mean) for u, v in zip(p, p[1:], strict=False)) / spread
    z_serial = (serial + 1 / (n - 1)) * math.sqrt(n)
    least = min(below(-uniform), 2 * below(-abs(z_runs)), 2 * below(-abs(z_serial)))
    far = (n - 1) * a * excess
    text_like = below((chi - df - far) / math.sqrt(2 * df + 4 * far))
    return 3 * least >= 0.01, min(secrets.LAST_STEP, math.floor(-math.log10(text_like) * secrets.STEPS))


def test_battery_and_control_against_plain_python(spark):
    rnd = random.Random(11)
    kinds = {name: symbols for name, _, symbols in secrets.ENCODINGS if symbols}
    order = [(name, pattern) for name, pattern, _ in secrets.ENCODINGS]
    import re

    named = lambda t: next((n for n, p in order if re.match(p, t)), "mixed")
    tokens = []
    for name, symbols in kinds.items():
        tokens += ["".join(rnd.choice(symbols) for _ in range(rnd.randint(16, 64))) for _ in range(25)]
        tokens += ["".join(rnd.choice(symbols[:4] + "a1") for _ in range(rnd.randint(16, 40))) for _ in range(5)]
    tokens = [t for t in dict.fromkeys(tokens) if "/" not in t]
    docs = spark.createDataFrame([(i, f"see {t} there") for i, t in enumerate(tokens)], "doc_id long, text string")
    rate, least, tested = 0.01, secrets.shortest_of(0.01), {}
    for i, t in enumerate(tokens):
        name = named(t)
        if name in kinds and len(t) >= least[name]:
            tested[i] = (name, *battery(t, kinds[name]))
    # Benjamini-Hochberg within an encoding, on steps.
    found = set()
    for name in kinds:
        group = [(step or 0, ok, i) for i, (of, ok, step) in tested.items() if of == name]
        good = [s for s in {g[0] for g in group} if 10.0 ** (-s / secrets.STEPS) * len(group) <= rate * sum(ok for s2, ok, _ in group if s2 >= s)]
        found |= {i for s, ok, i in group if good and ok and s >= min(good)}
    got = {r["doc_id"] for r in secrets.find_secrets(docs, rate).collect() if "random:4:" in r["spans"]}
    assert got == found and len(found) > 100


def test_random_tokens_of_one_case(spark):
    rnd = random.Random(15)
    some = lambda symbols, n: "".join(rnd.choice(symbols) for _ in range(n))
    texts = [(i, f"see {some(secrets.LOWER if i % 2 else secrets.UPPER, 48)} there") for i in range(100)]
    texts += [(200 + i, f"no {some(secrets.DIGITS, 120)} there") for i in range(20)]
    plain = "pneumonoultramicroscopicsilicovolcanoconiosis ANTIDISESTABLISHMENTARIANISM Internationalization uncopyrightable 4111111111111111 20240131120000"
    texts += [(300 + i, f"{plain} {'donaudampfschifffahrtsgesellschaft' * (1 + i % 2)} {some('aeinrst', 40)}") for i in range(40)]
    got = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for odd in (0, 1):
        assert sum(got[i] == "random:4:52" for i in range(odd, 100, 2)) > 45
    assert sum("random:3:123" in got[200 + i] for i in range(20)) >= 15
    assert not any("random" in got[300 + i] for i in range(40))


# --- 9 tiling


def test_runs_equal_those_of_all_pairs():
    rnd = random.Random(2)
    for _ in range(100):
        text, item = ([rnd.randint(0, 2) for _ in range(rnd.randint(0, 25))] for _ in range(2))
        want = set()
        for p in range(len(text)):
            for q in range(len(item)):
                n = 0
                while p + n < len(text) and q + n < len(item) and text[p + n] == item[q + n] > 0:
                    n += 1
                if n >= 2 and not (p and q and text[p - 1] == item[q - 1] > 0):
                    want.add((n, q, p))
        got = tiling.runs_of(np.array(text, np.int64), np.array(item, np.int64), 2)
        assert {tuple(r) for r in got.tolist()} == want


def test_a_text_of_one_word_a_million_times():
    start = time.time()
    assert tiling.tiled(["word"] * 1_000_000, ["word"] * 200, 5) == (1.0, 1, 200)
    # Only half of the item is there; its other words take no time.
    mixed = ["word"] * 100_000
    assert tiling.tiled(mixed, ["word"] * 100 + ["other"] * 100, 5) == (0.5, 1, 100)
    assert time.time() - start < 60


def test_short_items_match_whole(spark):
    bench = spark.createDataFrame([(1, "only three words"), (2, "one"), (3, ""), (4, "six words are in this item")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "here are Only three, words."), (2, "only three other words"), (3, "one"), (4, None)], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in tiling.contaminated(docs, bench).collect()}
    assert got == {(1, 1), (3, 2)}


def test_the_join_equals_tiling_every_pair(spark, plain_joins):
    """A passage that a third of all texts hold, copies of texts and items, and random rows."""
    rnd = random.Random(13)
    words = [f"w{i}" for i in range(12)]
    line = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    items = [(i, line(rnd.randint(1, 14))) for i in range(25)]
    items += [(25, items[0][1]), (None, items[1][1]), (27, None)]
    common = items[3][1]
    docs = [(i, f"{line(rnd.randint(0, 30))} {common if i % 3 == 0 else line(3)} {line(4)}") for i in range(90)]
    docs += [(200 + i, docs[0][1]) for i in range(20)] + [(300, None), (None, docs[1][1])]
    plain = tiling.Items([(n, t) for n, t in enumerate(t for _, t in items)], 5)
    want = sorted(str((d, items[n][0], c, k, longest)) for d, t in docs for n, c, k, longest in plain.covered(t) if c >= 0.5)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(str(tuple(r)) for r in tiling.contaminated(*frames).collect()) == want
    left = {(r["doc_id"], r["text"]) for r in tiling.drop_contaminated(*frames).collect()}
    assert left == {(d, t) for d, t in docs if not any(c >= 0.5 for _, c, *_ in plain.covered(t))}


# --- 4 pages


def test_scripts_with_a_slash_are_scripts():
    from revlattice.llm import html_text

    page = '<article><script src="x"/>var a=1;</script><p>hi</p><style/>p{}</style><textarea/>typed</textarea><svg/><p>there</p></article>'
    assert html_text.main_text(page) == "hi\nthere"


def test_a_deeply_nested_page_takes_memory_in_proportion():
    import tracemalloc

    from revlattice.llm import html_text

    tracemalloc.start()
    assert html_text.main_text("<div>" * 200_000 + "deep") == "deep"
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
