"""Fill-in-middle against a version that works on code points, one unit at a time."""

import hashlib
import random
import re

import numpy as np
import pytest

from revlattice.llm import fill_middle
from revlattice.llm.queries import QUERIES, ORACLE
from tests.compare import compare, duck
from tests.conftest import SF

MARKS = ("<P>", "<S>", "<M>")


def slow(doc_id, text, seed=1):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rnd = random.Random(12)
    odd = ["", None, " ", "a", "é", "☃☃☃", "😀a😀", "<P>", "x<S>y", "ends with <M", "<", "S>", "a<P", "\u0000\n\r\t", "ÀÉ word ß ﬁ é", "P>" * 9]
    made = ["".join(rnd.choice("ab Z.,\n<>PSM é☃😀́") for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    return [*odd, *made, "".join(rnd.choice(["word", " ", "é", "😀"]) for _ in range(200_000))]


def test_equals_the_version_on_code_points(spark):
    docs = [(i, t) for i, t in enumerate(texts())] + [(None, "no id"), (None, None), (3, "a third row of this id"), (3, "a")]
    frame = spark.createDataFrame([(i, t, "n", "f", "o") for i, t in docs], "doc_id long, text string, n string, form string, output string")
    got = fill_middle.fill_in_middle(frame.repartition(3))
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted(map(tuple, got.collect()), key=key) == sorted((slow(i, t) for i, t in docs), key=key)
    forms = {r["form"] for r in got.collect()}
    assert forms == {"plain", "psm", "spm"}
    want = sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in docs)
    assert sorted(r["restored_sha256"] for r in fill_middle.digests(got).collect()) == want
    assert fill_middle.fill_in_middle(frame.limit(0)).count() == 0


@pytest.mark.parametrize("text", [t for t in texts()[:60] if t])
def test_index_converts_cuts_both_ways(text):
    found = fill_middle.Exceptions(np.frombuffer(text.encode(), np.uint8))
    assert found.n_chars == len(text)
    assert len(found.at_byte) == sum(c > "\x7f" for c in text)  # nothing is kept for ASCII
    at = np.arange(len(text) + 1)
    bytes_before = np.array([len(text[:i].encode()) for i in at])
    assert np.array_equal(np.broadcast_to(found.byte_of(at), len(at)), bytes_before)
    assert np.array_equal(np.broadcast_to(found.char_of(bytes_before), len(at)), at)


def test_other_shares(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "concat('some words ', id) as text")
    count = lambda df: {r["form"]: r["count"] for r in df.groupBy("form").count().collect()}
    assert count(fill_middle.fill_in_middle(docs, plain_share=0, spm_share=100)) == {"spm": 400}
    assert count(fill_middle.fill_in_middle(docs, plain_share=100)) == {"plain": 400}
    assert 20 <= count(fill_middle.fill_in_middle(docs, seed=5))["plain"] <= 65


def test_query_equals_its_sql(spark):
    problem, n = compare(QUERIES["op12_fill_middle"](spark, SF), duck(SF), ORACLE["op12_fill_middle"])
    assert problem is None and n >= 200
