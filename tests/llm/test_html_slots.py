"""Templates, slots and articles of hosts, against a plain deduction over all pages of a host."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from revlattice.llm import html_text as h

SCHEMA = "page_id long, url string, html string"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n)).capitalize() + "."


def layout(rng, i, fixed="All rights reserved here", swap=False):
    """A page without article, main or telling names, and its text."""
    links = "".join(f'<li><a href="/{k}">{words(rng, 1)}</a></li>' for k in range(rng.randint(2, 5)))
    text = [words(rng, 4), *[words(rng, rng.randint(10, 60)) for _ in range(rng.randint(1, 4))]]
    body = f"<h1>{text[0]}</h1>" + "".join(f"<p>{t}</p>" for t in text[1:])
    parts = [f'<div class="a1"><ul>{links}</ul></div>', f'<div class="b2"><p>{words(rng, 3)}</p></div>', f'<div class="c3">{body}</div>',
             f'<div class="d4"><p>{fixed}</p><p>{words(rng, 2)}</p></div>']
    if swap:
        parts.reverse()
    return f"<html><head><title>{text[0]}</title></head><body>{''.join(parts)}</body></html>", "\n".join(text)


def result(spark, rows):
    return {r["page_id"]: r["text"] for r in h.extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_classes_alone_find_the_article(spark):
    rng = random.Random(4)
    made = [layout(rng, i) for i in range(30)]
    rows = [(i, f"http://plain.example/{i}", page) for i, (page, _) in enumerate(made)]
    got = result(spark, rows)
    assert got == {i: text for i, (_, text) in enumerate(made)}
    # One page of the host alone has no template: tags cannot tell its blocks from one another.
    assert result(spark, rows[:1])[0] != made[0][1]


def test_names_do_not_empty_an_article(spark):
    rng = random.Random(5)
    made = [(f"{words(rng, 5)}", f"{words(rng, 40)}") for _ in range(12)]
    page = '<html><body><article><header><h1>{0}</h1></header><div class="notice"><p>{1}</p></div><div class="ads">{0}</div></article></body></html>'
    got = result(spark, [(i, "http://notice.example", page.format(*m)) for i, m in enumerate(made)])
    assert got == {i: "\n".join(m) for i, m in enumerate(made)}
    page = '<html><body><div class="sidebar-left"><p>{1}</p></div><footer>{0}</footer></body></html>'
    got = result(spark, [(i, "http://names.example", page.format("me", m[1])) for i, m in enumerate(made)])
    assert got == {i: m[1] for i, m in enumerate(made)}


def test_a_passage_on_half_of_the_articles_stays(spark):
    rng = random.Random(6)
    page = "<html><body><article><p>{}</p>{}</article><footer>me</footer></body></html>"
    made = [(words(rng, 20), "<p>Read on below.</p><p>As seen before.</p>" if i % 3 else "") for i in range(30)]
    got = result(spark, [(i, "http://half.example", page.format(*m)) for i, m in enumerate(made)])
    assert got == {i: m[0] + ("\nRead on below.\nAs seen before." if m[1] else "") for i, m in enumerate(made)}


def test_an_empty_article_is_empty_and_other_pages_go_by_tags(spark):
    rng = random.Random(7)
    page = "<html><body><nav>{1}</nav><article><p>{0}</p></article></body></html>"
    rows = [(i, "http://some.example", page.format(words(rng, 20), words(rng, 2))) for i in range(20)]
    rows += [(50, "http://some.example", page.format("", "Menu")), (51, "http://some.example", "<main><p>Other</p></main>"), (52, "http://some.example", None)]
    got = result(spark, rows)
    assert (got[50], got[51], got[52]) == ("", "Other", "")


def deduce(pages: list[str], min_pages=5, min_share=0.5):
    """{token: is fixed} of a host's template, all vectors held at once; pages are all different."""
    vectors, parents, texts = defaultdict(Counter), {}, set()
    for i, html in enumerate(pages):
        page = h.Page(html)
        for (sign, path, around), n in page.tags.items():
            token = h.tag_token(sign, path)
            vectors[token][i] += n
            parents[token] = h.tag_token("+", around) if around != h.TOP else None
        for path, text, *_ in page.blocks:
            token = h.block_token(path, text)
            vectors[token][i] += 1
            parents[token] = h.tag_token("+", path) if path != h.TOP else None
            texts.add(token)
    classes = defaultdict(set)
    for token, vector in vectors.items():
        classes[frozenset(vector.items())].add(token)
    of = {t: vector for vector, members in classes.items() for t in members
          if len(members) >= 2 and len(vector) >= min_pages and len(vector) >= min_share * max(len(pages), min_pages)}
    tags = set(of) - texts
    out = {t: False for t in tags if parents[t] is None or parents[t] in tags}
    return out | {t: True for t in texts & set(of) if parents[t] in tags and of[parents[t]] == of[t]}


def test_templates_equal_a_plain_deduction(spark):
    rng = random.Random(8)
    hosts = {}
    for k in range(4):
        pages = [layout(rng, i, fixed=f"Ours {rng.randint(0, k)}")[0] for i in range(rng.randint(3, 25))]
        pages += ["<html><body>" + words(rng, 9) + "</body></html>"] * (k % 2)
        hosts[f"h{k}.example"] = pages
    rows = [(0, u, page) for u, pages in hosts.items() for page in pages]
    known = h.templates(spark.createDataFrame(rows, "page_id long, host string, html string"))
    got = {r["host"]: {t["token"]: t["fixed"] for t in r["tokens"]} for r in known.collect()}
    want = {u: deduce(pages) for u, pages in hosts.items()}
    assert got == {u: w for u, w in want.items() if w} and len(got) >= 3


def test_classes_out_of_order_bound_no_slot(spark):
    rng = random.Random(9)
    made = [layout(rng, i, swap=i % 2 == 0) for i in range(24)]
    df = spark.createDataFrame([(i, "swap.example", page) for i, (page, _) in enumerate(made)], "page_id long, host string, html string")
    known = h.templates(df)
    places = h.article_places(df, known).collect()
    assert not [s for p in places for s in p["slots"]]
    pages = [layout(rng, i) for i in range(24)] + made[:1]
    got = result(spark, [(i, "http://once.example", page) for i, (page, _) in enumerate(pages)])
    assert got == {i: text for i, (_, text) in enumerate(pages)}
