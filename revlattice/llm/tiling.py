"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet on seeds: runs of `min_tile` words with equal Karp-Rabin
hash (of all words of an item that has fewer). Spark joins the seeds of both sides; a text and an item that
share enough of them are tiled in a task: the longest match is marked first, then the
longest of what is left unmarked, and so on. The share of an item's words under marks is its
coverage, whatever the order of the passages.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.session import store

#: Bits of the filter of seeds (8 MB), and words whose hashes a worker keeps.
FILTER_BITS, KEPT_WORDS = 1 << 26, 1 << 19
#: So many keys of texts (16 bytes each) at most are sent to all executors, in place of a shuffle of texts.
SENT_KEYS = 500_000

#: Characters of benchmark text that are sent to the executors at a time.
BLOCK_CHARS = 32 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
# ASCII texts, lower-cased, with spaces for all but letters and digits.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
# Characters that are not seen and part no words: soft hyphen, joiners, variation selectors.
_UNSEEN = {0xAD, 0x34F, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}


class _Letters(dict):
    """What becomes of a character: letters, digits and marks stay, all others are spaces."""

    def __missing__(self, code: int) -> int | None:
        kept = chr(code).isalnum() or unicodedata.category(chr(code))[0] == "M"
        self[code] = None if code in _UNSEEN else code if kept else 32
        return self[code]


_LETTERS = _Letters()


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, with the marks on them, case-folded and in NFC."""
    text = text or ""
    if text.isascii():
        return text.encode().translate(_LOWER).decode().split()
    folded = unicodedata.normalize("NFD", text).casefold().translate(_LETTERS)
    # Marks without a letter before them are no words.
    return [w for w in unicodedata.normalize("NFC", folded).split() if w[0].isalnum()]


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of n ids, modulo 2^64."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(ids) - n + 1, np.uint64)
    base = np.uint64(_BASE)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * base + ids[k : k + len(out)].astype(np.uint64)
    return out


def tiled(words: list[str], item: list[str], min_tile: int) -> tuple[float, int, int] | None:
    """(coverage, tiles, longest tile) of an item's words over a text's; None without a tile."""
    if not item:
        return None
    numbers = {w: i for i, w in enumerate(dict.fromkeys(item), 1)}
    ids = np.array(list(map(numbers.get, words, repeat(0))), np.int64)
    tiles = tile(ids, np.array([numbers[w] for w in item], np.int64), min(min_tile, len(item)))
    if not tiles:
        return None
    lengths = [n for _, _, n in tiles]
    return sum(lengths) / len(item), len(tiles), max(lengths)


class Items:
    """A few benchmark items, held against texts one by one, without Spark."""

    def __init__(self, rows: list[tuple], min_tile: int):
        self.min_tile = min_tile
        self.rows = [(name, words_of(text)) for name, text in rows]

    def covered(self, text: str | None) -> list[tuple]:
        """(item, coverage, tiles, longest tile) of the items that have a tile in the text."""
        words = words_of(text)
        known = set(words)
        found = [(name, tiled(words, item, self.min_tile)) for name, item in self.rows if not known.isdisjoint(item)]
        return [(name, *t) for name, t in found if t]


def runs_of(text: np.ndarray, item: np.ndarray, least: int) -> np.ndarray:
    """Rows (length, place in item, place in text) of all runs of equal ids, of `least` at least, that
    go on at neither end. Ids below 1 are equal to none.

    Two rows of match lengths go along the item, so a text that repeats one word costs its runs, of
    which there are no more than places in both, and not its pairs of places.
    """
    found, before = [np.empty((0, 3), np.int64)], np.zeros(len(text), np.int64)
    for q in range(len(item) + 1):
        now = np.zeros(len(text), np.int64)
        if q < len(item) and item[q] > 0:
            hit = np.flatnonzero(text == item[q])
            now[hit] = 1 + np.where(hit > 0, before[hit - 1], 0)
        ended = before >= least
        ended[:-1] &= now[1:] == 0
        at = np.flatnonzero(ended)
        if len(at):
            n = before[at]
            found.append(np.column_stack((n, q - n, at - n + 1)))
        before = now
    return np.concatenate(found)


def tile(text: np.ndarray, item: np.ndarray, min_tile: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of `item` over `text`: (place in text, place in item, length).

    Ties go to the earlier place in the item, then in the text.
    """
    runs = runs_of(text, item, min_tile)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], -runs[:, 0]))]
    in_text, in_item, out = np.zeros(len(text), bool), np.zeros(len(item), bool), []
    pieces: list[tuple[int, int, int]] = []  # what is left of runs that were cut
    at, open_words = 0, len(item)
    while (at < len(runs) or pieces) and open_words >= min_tile:
        whole = (-int(runs[at, 0]), int(runs[at, 1]), int(runs[at, 2])) if at < len(runs) else None
        if pieces and (whole is None or pieces[0] < whole):
            n, q, p = heapq.heappop(pieces)
        else:
            (n, q, p), at = whole, at + 1
        n = -n
        free = ~(in_text[p : p + n] | in_item[q : q + n])
        if free.all():
            in_text[p : p + n] = in_item[q : q + n] = True
            out.append((p, q, n))
            open_words -= n
            continue
        for s, e in _stretches(free):
            if e - s >= min_tile:
                heapq.heappush(pieces, (-(e - s), q + s, p + s))
    return out


def _stretches(free: np.ndarray):
    edges = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).astype(np.int8)))
    return zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)


class _Hashes(dict):
    """Hashes of words, kept for the words seen last."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return self[word]


_HASHES = _Hashes()


def seeds_of(words: list[str], n: int) -> np.ndarray:
    """Signed hashes of all runs of n words. Runs of other lengths have other hashes."""
    ids = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    found = rolling(ids, n) + np.uint64(n)
    return (found ^ (found >> np.uint64(31))).view(np.int64)


def item_seeds(items: DataFrame, min_tile: int) -> DataFrame:
    """(item_key, seed, places, n_words, length) of items (item_key, text): each seed with the number of
    its places in the item, and the length of the item's seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch["item_key"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = words_of(text)
                if words:
                    length = min(min_tile, len(words))
                    seed, places = np.unique(seeds_of(words, length), return_counts=True)
                    columns = [[key] * len(seed), seed, places, np.full(len(seed), len(words)), np.full(len(seed), length)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["item_key", "seed", "places", "n_words", "length"])

    return items.select("item_key", "text").mapInArrow(run, "item_key binary, seed long, places long, n_words long, length long")


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, one set for every seed. Built from bitmaps of buckets, so what comes to the
    driver and goes to the executors has the same size however many seeds there are; with more seeds
    more runs of texts pass that are no seeds, and the join drops those."""
    bit = F.pmod("seed", F.lit(FILTER_BITS)) + 1
    sets = seeds.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in sets.toLocalIterator():
        at = (row["bucket"] - 1) * len(row["bits"])
        out[at : at + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    return out


def text_seeds(texts: DataFrame, lengths: list[int], kept: Broadcast) -> DataFrame:
    """(text_key, text, seeds) of the texts (text_key, text) that have any distinct seeds that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = kept.value
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch["text"]):
                words = words_of(text.as_py())
                seeds = np.concatenate([seeds_of(words, n) for n in lengths if len(words) >= n] or [np.empty(0, np.int64)])
                at = seeds & (FILTER_BITS - 1)
                seeds = np.unique(seeds[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1])
                if len(seeds):
                    rows.append(row)
                    found.append(seeds)
            held = batch.take(pa.array(rows, pa.int64()))
            ends = np.cumsum([0, *map(len, found)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *found])))
            yield pa.RecordBatch.from_arrays([held["text_key"], held["text"], lists], ["text_key", "text", "seeds"])

    return texts.select("text_key", "text").mapInArrow(run, "text_key binary, text string, seeds array<long>")


def sent_if_few(keys: DataFrame) -> DataFrame:
    """Stored `keys`, marked to be broadcast if they are counted to be at most SENT_KEYS."""
    return F.broadcast(keys) if keys.count() <= SENT_KEYS else keys


def content_key(text: str) -> Column:
    """16 bytes that tell texts apart; null as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _keyed(df: DataFrame, name: str) -> DataFrame:
    """(`name`, text): texts and their keys; null as empty."""
    return df.select(content_key("text").alias(name), F.coalesce("text", F.lit("")).alias("text"))


def matches(docs: DataFrame, benchmark: DataFrame, min_tile: int, threshold: float) -> DataFrame:
    """(text_key, item_key, coverage, n_tiles, longest_tile) of distinct texts and items with
    coverage >= threshold; keys are MD5 digests of the texts.

    Texts that have no seed of any item are left behind in the first pass. A text is a candidate for an item
    if the seeds they share could cover the threshold. Only candidates are fetched, once for all copies of
    a text, and tiled.
    """
    items = store(_keyed(benchmark, "item_key").dropDuplicates(["item_key"]), "tiling-items")
    seeds = store(item_seeds(items, min_tile), "tiling-seeds")
    lengths = [r["length"] for r in seeds.select("length").distinct().collect()]  # 1 to min_tile
    kept = docs.sparkSession.sparkContext.broadcast(seed_filter(seeds))
    held = store(text_seeds(_keyed(docs, "text_key"), lengths, kept), "tiling-texts")
    # Copies of a text are counted as one before they are shuffled.
    met = held.select("text_key", F.explode("seeds").alias("seed")).groupBy("text_key", "seed").agg(F.count("*").alias("copies"))
    # Both sides are dealt by seed plainly, so that AQE can split a passage that many texts hold.
    shared = met.select("text_key", "seed").join(seeds, "seed").groupBy("text_key", "item_key", "n_words", "length").agg(F.sum("places").alias("places"))
    likely = shared.where(F.col("places") * F.col("length") >= F.lit(threshold) * F.col("n_words"))
    likely = store(likely.select("text_key", "item_key"), "tiling-candidates")
    wanted = sent_if_few(store(likely.select("text_key").distinct(), "tiling-wanted"))
    texts = held.select("text_key", "text").join(wanted, "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    pairs = likely.join(texts, "text_key").join(items.withColumnRenamed("text", "item"), "item_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text_key, item_key, text, item in zip(*[batch[c] for c in ("text_key", "item_key", "text", "item")], strict=True):
                t = tiled(words_of(text.as_py()), words_of(item.as_py()), min_tile)
                if t and t[0] >= threshold:
                    out.append((text_key.as_py(), item_key.as_py(), *t))
            columns = zip(*out, strict=True) if out else [[]] * 5
            kinds = [pa.binary(), pa.binary(), pa.float64(), pa.int32(), pa.int32()]
            names = ["text_key", "item_key", "coverage", "n_tiles", "longest_tile"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    found = pairs.select("text_key", "item_key", "text", "item").mapInArrow(
        run, "text_key binary, item_key binary, coverage double, n_tiles int, longest_tile int"
    )
    return store(found, "tiling-matches")


def matches_column(text, benchmark: DataFrame, min_tile: int, threshold: float, block_chars: int = BLOCK_CHARS):
    """Column: array of (item_id, coverage, n_tiles, longest_tile) with coverage >= threshold.

    For a benchmark of a few items only: it goes to the driver and the executors whole, in blocks of about
    `block_chars`, and every text is held against every item. `contaminated` joins instead.
    """
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_chars))
    kind = f"array<struct<item_id:{items.schema['item_id'].dataType.simpleString()},coverage:double,n_tiles:int,longest_tile:int>>"

    def held_against(block: int):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()
        index = spark.sparkContext.broadcast(Items([tuple(r) for r in rows], min_tile))

        @F.pandas_udf(kind)
        def of(texts: pd.Series) -> pd.Series:
            found = [[m for m in index.value.covered(t) if m[1] >= threshold] for t in texts]
            return pd.Series([[dict(zip(("item_id", "coverage", "n_tiles", "longest_tile"), m, strict=True)) for m in x] for x in found], dtype=object)

        return of(text)

    columns = [held_against(b) for b in range(n_blocks)]
    return columns[0] if n_blocks == 1 else F.concat(*columns)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_tile: int = 5, threshold: float = 0.5) -> DataFrame:
    """Pairs of a row of `docs` (doc_id, text) and a `benchmark` item (item_id, text) of which
    tiles of at least `min_tile` words (or of all its words, if it has fewer) cover the share
    `threshold`: doc_id, item_id, coverage, n_tiles, longest_tile.

    Null and empty texts and items match nothing. Repeated
    documents and items give a row each; null ids are carried along. Other columns are ignored. An empty
    table on either side gives no rows. A pair takes memory in proportion to its text, and
    time in proportion to words of the text times words of the item.
    """
    found = matches(docs, benchmark, min_tile, threshold)
    rows = docs.select("doc_id", content_key("text").alias("text_key"))
    named = benchmark.select("item_id", content_key("text").alias("item_key"))
    return rows.join(found, "text_key").join(named, "item_key").select("doc_id", "item_id", "coverage", "n_tiles", "longest_tile")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_tile: int = 5, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that match no benchmark item, with all their columns."""
    found = sent_if_few(store(matches(docs, benchmark, min_tile, threshold).select("text_key").distinct(), "tiling-found"))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    return rows.join(found, content_key("row.text") == found["text_key"], "left_anti").select("row.*")
