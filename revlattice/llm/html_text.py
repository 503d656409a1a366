"""Main text of web pages by equivalence classes of their hosts' tokens.

Tokens of a page are its container tags and its text blocks, told apart by their place in the
tree. Tokens of a host with equal occurrence vectors (how often each occurs on the pages of every
article) form a class; classes of two tokens or more on enough pages, nested in a container that is template
itself and in the same order on all pages, make the host's template. What lies after one template token and before
the next is a slot. The slot whose text varies most from page to page is the article's (`article_places`); tags
and names only choose between slots that come near to it, and decide alone on pages without a template.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.session import store

# Fixed values of HTML: raw text, void and block elements.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "object", "textarea", "select", "math", "canvas", "audio", "video"}
CONTAINERS = {"html", "head", "body", "article", "main", "section", "div", "nav", "header", "footer", "aside", "form", "ul", "ol", "dl",
              "table", "figure", "dialog", "menu", "fieldset", "details", "button", "title", "label", "address", "blockquote"}
BLOCKS = CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "pre", "hr", "figcaption", "caption", "summary"}
SPACES = {"br", "td", "th", "wbr", "img"}
# Containers that never hold main text, and the words in class, id or role that say so.
ASIDE = {"head", "title", "nav", "header", "footer", "aside", "form", "dialog", "menu", "button", "label", "fieldset"}
ASIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion",
               "banner", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header", "masthead",
               "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "comment", "comments", "commentlist",
               "disqus", "replies", "reply", "respond", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe",
               "subscription", "signup", "login", "search", "widget", "toolbar", "pagination", "pager", "copyright", "complementary",
               "contentinfo", "hidden"}
#: Of those, what takes an article or main element out as well.
ASIDE_ARTICLE = {"ad", "ads", "advert", "advertisement", "sponsored", "promo", "comment", "comments", "reply", "related"}
#: Names that say too little to take a container out of the article that it stands in.
WEAK_WORDS = {"banner", "complementary", "contentinfo", "header", "hidden", "masthead", "notice", "promotion", "search", "toolbar", "widget"}
#: A slot with this share of the text of the largest one is a rival that tags may prefer to it.
RIVAL_SHARE = 0.05
#: A class is in order if this share of the pages that hold all of it agree.
ORDER_SHARE = 0.9

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>\x00]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<(?=[a-zA-Z/][^<>]*\Z).*",
    re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[a-z]+")
#: Raw elements of other languages, and the key of the path that a page begins with.
FOREIGN = {"svg", "math"}
TOP = 0


def _names(attributes: str) -> list[str]:
    if "=" not in attributes:
        return []
    return sorted((a or b or c).lower() for _, a, b, c in _NAMES.findall(attributes))


def _is_aside(tag: str, names: list[str], attributes: str, in_article: bool) -> bool:
    if (tag in ASIDE and not (in_article and tag == "header")) or (attributes and _HIDDEN.search(attributes)):
        return True
    if tag in ("html", "body"):
        return False
    words = ASIDE_ARTICLE if tag in ("article", "main") else ASIDE_WORDS - WEAK_WORDS if in_article else ASIDE_WORDS
    for value in names:
        for name in value.split():
            parts = _WORD.findall(name)
            if parts and parts[0] not in ("no", "with", "has", "without") and words.intersection(parts):
                return True
    return False


class Page:
    """A page as containers and text blocks in page order.

    `blocks`: (path, text, characters of links in it, is aside, "article"/"main"/"", is the page's heading).
    `tags`: how often each container tag occurs, opened (+) or closed (-), by its path and that around it.
    `order`: tags (sign, path) and blocks ("", number) as they come; `around`: the path around each path.
    Paths are keys (`path_key`) of one size, however deep a page is nested.
    """

    def __init__(self, html: str):
        self.blocks: list[tuple[int, str, int, bool, str, bool]] = []
        self.order: list[tuple[str, int]] = []
        self.around: dict[int, int] = {}
        self.kinds: set[str] = set()
        self.tags: Counter[tuple[str, int, int]] = Counter()
        self.stack: list[tuple[str, int, bool, str]] = [("", TOP, False, "")]
        self.text: list[str] = []
        self.linked, self.in_link, self.in_heading = 0, 0, False
        self._read(html)
        self._end_block()

    def _end_block(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            _, path, aside, kind = self.stack[-1]
            self.order.append(("", len(self.blocks)))
            self.blocks.append((path, text, self.linked, aside, kind, self.in_heading))
        self.text, self.linked = [], 0

    def _add(self, raw: str) -> None:
        if raw:
            text = unescape(raw) if "&" in raw else raw
            self.text.append(text)
            if self.in_link:
                self.linked += len(text)

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            found = _TOKEN.search(html, at)
            if not found:
                self._add(html[at:])
                return
            self._add(html[at : found.start()])
            at = found.end()
            tag = (found[2] or "").lower()
            if not tag:
                continue
            if found[1]:
                self._close(tag)
            else:
                self._open(tag, found[3] or "")
                # Only svg and math can end in themselves; HTML ignores the slash.
                if tag in RAW and not (tag in FOREIGN and (found[3] or "").endswith("/")):
                    close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
                    at = close.end() if close else end

    def _open(self, tag: str, attributes: str) -> None:
        if tag in SPACES:
            self.text.append(" ")
        if tag in BLOCKS:
            self._end_block()
            self.in_heading = tag == "h1"
        if tag == "a":
            self.in_link += 1
        if tag in CONTAINERS:
            _, path, aside, kind = self.stack[-1]
            names = _names(attributes)
            around, path = path, path_key(path, f"{tag}{'.'.join(['', *names])}")
            own = _is_aside(tag, names, attributes, kind == "article")
            if tag in ("article", "main") or "main" in names:
                kind = "article" if tag == "article" or kind == "article" else "main"
            if kind and not (aside or own):
                self.kinds.add(kind)
            self.tags["+", path, around] += 1
            self.order.append(("+", path))
            self.around[path] = around
            self.stack.append((tag, path, aside or own, kind))

    def _close(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_block()
            self.in_heading = False
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if tag in CONTAINERS:
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i][0] == tag:
                    self.tags["-", self.stack[i][1], self.stack[i - 1][1]] += 1
                    self.order.append(("-", self.stack[i][1]))
                    del self.stack[i:]
                    return


def path_key(around: int, step: str) -> int:
    """The key of a path: of the path around it and its last step."""
    return xxhash.xxh64_intdigest(step.encode("utf-8", "surrogatepass"), around)


#: Containers that hold asides and article alike.
BODY = {path_key(TOP, "body"), path_key(TOP, "html"), path_key(path_key(TOP, "html"), "body")}


def block_token(path: int | str, text: str) -> int:
    """The token of a text block in a container, which is given by its key or as `/step/step`."""
    if isinstance(path, str):
        key = TOP
        for step in path.split("/")[1:]:
            key = path_key(key, step)
        path = key
    return xxhash.xxh64_intdigest(b"\n" + text.encode("utf-8", "surrogatepass"), path) - (1 << 63)


def tag_token(sign: str, path: int) -> int:
    return xxhash.xxh64_intdigest(sign.encode(), path) - (1 << 63)


def main_blocks(page: Page) -> list[tuple[int, str]]:
    """(path, text) of the blocks of a page's article.

    Where a page has an article element, its main text is there; else in the main element; else
    anywhere but in asides and blocks that are mostly links.
    """
    blocks = [b for b in page.blocks if not b[3]]
    for kind in ("article", "main"):
        inside = [b for b in blocks if b[4] == kind]
        if inside:
            blocks = inside
            break
    else:
        blocks = [b for b in blocks if b[2] * 2 <= len(b[1])]
    return [(path, text) for path, text, *_ in blocks]


def article_key(page: Page) -> int:
    """Equal for pages that hold the same article: of its blocks, or of all where names leave none."""
    return block_token("", "\n".join(text for _, text in main_blocks(page) or [b[:2] for b in page.blocks]))


def main_text(html: str | None, fixed: frozenset[int] | set[int] = frozenset()) -> str:
    """The article of a page by its tags alone: its blocks, one to a line.

    `fixed` are tokens of text blocks that the host's template holds. An article of nothing else
    is no template and stays whole.
    """
    return _lines(main_blocks(Page(html or "")), fixed)


def _lines(blocks: list[tuple[int, str]], fixed: frozenset[int] | set[int]) -> str:
    slots = [b for b in blocks if block_token(*b) not in fixed] if fixed else blocks
    return "\n".join(text for _, text in slots or blocks)


def _within(page: Page, path: int, containers: set[int] | dict[int, int], known: dict[int, int]) -> int:
    """The innermost path of `containers` at or around `path`, TOP if none; `known` holds earlier answers."""
    passed = []
    while path != TOP and path not in known and path not in containers:
        passed.append(path)
        path = page.around[path]
    found = known.get(path, path)
    known.update(dict.fromkeys(passed, found))
    return found


def slots_of(page: Page, template: dict[int, int]) -> tuple[list[int | None], list[int]]:
    """Per block its slot, which is named by the template token before it (None for template text and
    before the first one), and the template's tokens as they come on the page."""
    tokens: dict[tuple[str, int], int] = {}
    slots: list[int | None] = []
    seen: list[int] = []
    last = None
    for sign, at in page.order:
        if sign:
            token = tokens.get((sign, at))
            if token is None:
                token = tokens[sign, at] = tag_token(sign, at)
        else:
            token = block_token(*page.blocks[at][:2])
            slots.append(None if token in template else last)
        if token in template:
            seen.append(token)
            last = token
    return slots, seen


def slot_text(html: str | None, place: dict | None) -> str:
    """The article of a page: what is in its host's slots; by tags where the page has none of them.

    `place`: tokens of the host's template, `fixed` texts, and of the article its `kind` of element, or its
    `container` (None for the page's body) and `slots`. Containers that asides are named by are left out, unless
    nothing else is there; the heading (h1) before the article belongs to it.
    """
    page = Page(html or "")
    if not place:
        return _lines(main_blocks(page), frozenset())
    fixed = frozenset(place["fixed"])
    if place["kind"]:
        inside = [b for b in page.blocks if b[4] == place["kind"]]
        there = place["kind"] in page.kinds
    else:
        slots, _ = slots_of(page, dict.fromkeys(place["tokens"], 0))
        kept, container, known = set(place["slots"]), place["container"], {}
        below = {container} if container is not None else set()
        own = [
            s in kept or (container is not None and _within(page, b[0], below, known) == container)
            for b, s in zip(page.blocks, slots, strict=True)
        ]
        first = own.index(True) if True in own else 0
        inside = [
            b for i, b in enumerate(page.blocks)
            if own[i] or (i < first and b[5] and not b[3] and block_token(*b[:2]) not in fixed)
        ]
        there = container is not None and container in page.around
    told = [b for b in inside if not b[3]]
    if not (told if place["kind"] else inside) and not there:
        return _lines(main_blocks(page), fixed)
    # Names alone do not empty an article that varies as one; within an article element they have been weighed.
    return _lines([b[:2] for b in (told if told or place["kind"] else inside)], fixed)


def occurrences(pages: DataFrame) -> DataFrame:
    """Per page and token: host, article (hash of the page's article), token, parent (token of
    the container around it), is_text, n; and a row per page without a token."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for host, html in zip(batch["host"], batch["html"], strict=True):
                page = Page(html or "")
                article = article_key(page)
                out.append((host, article, None, None, False, 1))
                for (sign, path, around), n in page.tags.items():
                    parent = tag_token("+", around) if around != TOP else None
                    out.append((host, article, tag_token(sign, path), parent, False, n))
                texts = Counter((path, text) for path, text, *_ in page.blocks)
                for (path, text), n in texts.items():
                    out.append((host, article, block_token(path, text), tag_token("+", path) if path != TOP else None, True, n))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = ["object", "int64", "Int64", "Int64", "bool", "int32"]  # nullable, as floats lose digits
            names = ["host", "article", "token", "parent", "is_text", "n"]
            yield pd.DataFrame({k: pd.array(c, dtype=t) for k, c, t in zip(names, columns, kinds, strict=True)})

    return pages.select("host", "html").mapInPandas(
        run, "host string, article long, token long, parent long, is_text boolean, n int"
    )


def templates(pages: DataFrame, min_pages: int = 5, min_share: float = 0.5) -> DataFrame:
    """Per host the tokens of its template: host, tokens (array of token, class, fixed).

    Pages of a host with equal articles (mirrors, reposts) are copies of one page and stand in
    an occurrence vector once. A class is valid on at least `min_pages` pages that hold the
    share `min_share` of the host's different articles, or of `min_pages` if those are fewer. Text is `fixed` if it is in
    the class of the container around it: what only some pages have there is no template.

    An occurrence vector is folded to a hash that adds up over pages in any order, so a host
    with very many pages is aggregated before it is shuffled and never sits in one task.
    """
    key = ["host", "token", "parent", "is_text"]
    once = occurrences(pages).groupBy(*key, "article").agg(F.max("n").alias("n"), F.count("*").alias("copies"))
    vector = F.bit_xor(F.xxhash64("article", "n"))
    seen = once.groupBy(*key).agg(vector.alias("vector"), F.count("*").alias("n_articles"), F.sum("copies").alias("n_pages"))
    seen = store(seen, "html-tokens")
    sizes = seen.where("token is null").select("host", F.greatest("n_articles", F.lit(min_pages)).alias("least"))
    same = ["host", "vector", "n_articles"]
    seen = seen.where("token is not null")
    classes = seen.groupBy(*same).agg(F.count("*").alias("tokens"), F.min("n_pages").alias("n_pages"))
    valid = classes.where((F.col("tokens") >= 2) & (F.col("n_pages") >= min_pages)).join(sizes, "host")
    valid = valid.where(F.col("n_articles") >= min_share * F.col("least")).select(*same)
    members = seen.join(valid, same, "left_semi").withColumn("class", F.xxhash64("vector", "n_articles"))
    # Nesting: the container around a token is template as well, and around fixed text of its class.
    around = members.where("not is_text").select("host", F.col("token").alias("parent"), F.col("class").alias("around"))
    tops = members.where("parent is null and not is_text").withColumn("around", F.lit(None).cast("long"))
    nested = members.join(around, ["host", "parent"]).where("not is_text or class = around").unionByName(tops)
    # At most (tokens of an article's pages / min_share) a host.
    token = F.struct("token", "class", F.col("is_text").alias("fixed"))
    return nested.groupBy("host").agg(F.collect_set(token).alias("tokens"))


def _weighed(pages: DataFrame) -> DataFrame:
    """Per page of a host with a template: a row per slot with text (host, slot, class of the token before it,
    container, kind, rank, digest of its text, article, weight), and a row per class that it holds whole (class, and
    as digest the order of the class's tokens)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["host", "slot", "class", "container", "kind", "rank", "digest", "article", "weight"]
        types = ["object", "Int64", "int64", "Int64", "object", "int32", "int64", "int64", "int64"]
        for batch in batches:
            out: list[tuple] = []
            for host, html, tokens in zip(batch["host"], batch["html"], batch["tokens"], strict=True):
                template = {t["token"]: t["class"] for t in tokens}
                out.extend((host, *row) for row in _page_rows(Page(html or ""), template))
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pd.DataFrame({k: pd.array(c, dtype=t) for k, c, t in zip(names, columns, types, strict=True)})

    return pages.select("host", "html", "tokens").mapInPandas(
        run, "host string, slot long, class long, container long, kind string, rank int, digest long, article long, weight long"
    )


def _page_rows(page: Page, template: dict[int, int]) -> Iterator[tuple]:
    slots, seen = slots_of(page, template)
    article = article_key(page)
    sizes = Counter(template.values())
    orders: dict[int, list[int]] = {}
    for token in dict.fromkeys(seen):
        orders.setdefault(template[token], []).append(token)
    for group, order in orders.items():
        if len(order) == sizes[group]:
            yield None, group, None, None, 0, _digest(order), article, 0
    open_tags = {path for path in page.around if tag_token("+", path) in template}
    texts: dict[int, list[tuple]] = {}
    for slot, block in zip(slots, page.blocks, strict=True):
        if slot is not None:
            texts.setdefault(slot, []).append(block)
    known: dict[int, int] = {}
    for slot, blocks in texts.items():
        told = [b for b in blocks if not b[3]]
        kind = next((k for k in ("article", "main") if any(b[4] == k for b in told)), None)
        rank = 0 if kind else 1 if told else 2
        counted = told or blocks
        weight = max(0, sum(len(b[1]) for b in counted) - 2 * sum(b[2] for b in counted))
        container = _within(page, blocks[0][0], open_tags, known)
        digest = _digest([block_token(*b[:2]) for b in blocks])
        yield slot, template[slot], container - (1 << 63) if container else None, kind, rank, digest, article, weight


def _digest(tokens: list[int]) -> int:
    return xxhash.xxh64_intdigest(b"".join(t.to_bytes(8, "little", signed=True) for t in tokens)) - (1 << 63)


def article_places(pages: DataFrame, known: DataFrame) -> DataFrame:
    """Per host where its article is: host, tokens, fixed, kind, container (array of one or none), slots.

    Classes whose tokens come in other orders on more than a tenth of the pages bound no slot. A slot weighs as much as
    its different texts have characters outside links, each text once, so what all pages repeat weighs nothing to
    speak of. Of the slots that reach `RIVAL_SHARE` of the heaviest, those in an article or main element come first,
    then those that no name calls an aside, then the heavier. The article is the whole element, or else the
    container around the slot; in the page's body it is the slots of the body whose text differs on most pages.
    """
    rows = store(_weighed(pages.join(known, "host")), "html-slots")
    orders = rows.where("slot is null").groupBy("host", "class", "digest").agg(F.count("*").alias("n"))
    ordered = orders.groupBy("host", "class").agg((F.max("n") >= ORDER_SHARE * F.sum("n")).alias("good")).where("good").drop("good")
    texts = rows.where("slot is not null").groupBy("host", "slot", "class", "digest", "article").agg(
        F.max("weight").alias("weight"), F.min("rank").alias("rank"), F.min("container").alias("container"), F.min("kind").alias("kind"))
    texts = texts.groupBy("host", "slot", "class", "digest").agg(
        F.max("weight").alias("weight"), F.min("rank").alias("rank"), F.min("container").alias("container"), F.min("kind").alias("kind"),
        F.count("*").alias("articles"))
    slots = texts.groupBy("host", "slot", "class").agg(
        F.sum("weight").alias("weight"), F.min("rank").alias("rank"), F.min("container").alias("container"), F.min("kind").alias("kind"),
        F.count("*").alias("texts"), F.sum("articles").alias("articles"))
    # From here on there is a row per slot of a template, which one page's tokens bound.
    slots = store(slots.join(ordered, ["host", "class"], "left_semi").where("weight > 0"), "html-slot-sizes")
    heaviest = slots.groupBy("host").agg(F.max("weight").alias("most"))
    chosen = slots.join(heaviest, "host").where(F.col("weight") >= RIVAL_SHARE * F.col("most")).groupBy("host").agg(
        F.max_by(F.struct("slot", "container", "kind"), F.struct(-F.col("rank"), "weight", "slot")).alias("best"))
    beside = slots.join(chosen, "host").where(
        (F.col("slot") == F.col("best.slot")) | (F.col("container").eqNullSafe(F.col("best.container")) & (F.col("texts") * 2 > F.col("articles")))
    )
    beside = beside.groupBy("host").agg(F.collect_set("slot").alias("slots"), F.first("best").alias("best"))
    good = ordered.groupBy("host").agg(F.collect_set("class").alias("good"))
    fixed = F.filter("tokens", lambda t: t["fixed"] & F.array_contains("good", t["class"]))
    return known.join(good, "host").join(beside, "host", "left").select(
        "host", F.transform("tokens", lambda t: t["token"]).alias("tokens"), F.transform(fixed, lambda t: t["token"]).alias("fixed"),
        F.col("best.kind").alias("kind"), F.array_compact(F.array("best.container")).alias("container"), F.coalesce("slots", F.array().cast("array<long>")).alias("slots"))


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract_main_text(pages: DataFrame, min_pages: int = 5, min_share: float = 0.5) -> DataFrame:
    """Per row of `pages` (page_id, url, html): page_id, url, text, n_chars (code points).

    Null and empty html gives an empty text. Pages without a usable url share the host "", and
    a host with fewer than `min_pages` pages has no template; tags alone decide there, as on pages that hold
    none of their host's slots. Repeated
    rows come out as often as they come in; null ids are carried along; other columns ignored. An empty table
    gives no rows. A page takes memory in proportion to its length, however deep it is nested.
    """
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    known = store(templates(rows, min_pages, min_share), "html-templates")
    places = store(article_places(rows, known), "html-places")
    place = F.when(F.col("tokens").isNotNull(), F.struct("tokens", "fixed", "kind", "container", "slots"))

    @F.pandas_udf("string")
    def text(html: pd.Series, place: pd.DataFrame) -> pd.Series:
        given = place.to_dict("records")
        return pd.Series([slot_text(h, _place(p)) for h, p in zip(html, given, strict=True)], dtype=object)

    # One short row per host: Spark broadcasts it if small, else AQE splits large hosts.
    done = rows.join(places, "host", "left").select("page_id", "url", text("html", place).alias("text"))
    return done.withColumn("n_chars", F.char_length("text").cast("long"))


def _place(row: dict) -> dict | None:
    """A host's place as it comes from Spark, with paths unsigned again; None for hosts without a template."""
    if row["tokens"] is None:
        return None
    paths = [int(c) + (1 << 63) for c in row["container"]]
    return row | {"container": paths[0] if paths and paths[0] not in BODY else None}
