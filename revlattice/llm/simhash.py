"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint is cut into so few segments that of two fingerprints within the distance one
segment differs by at most one bit. Each segment is indexed under its variants with one bit
left out; equal variants meet, and their fingerprints are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.llm import links
from revlattice.session import store

BITS = 64


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The 64-bit SimHash of a text as a signed integer; 0 without words (or for null)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - shingle, 0)
    hashed, digest = [], xxhash.xxh64_intdigest
    for a, b in zip(starts[: last + 1].tolist(), ends[min(shingle, len(words)) - 1 :].tolist(), strict=True):
        hashed.append(digest(joined[a:b], seed))
    counts, n = np.zeros(BITS, np.int64), len(hashed)
    values = np.array(hashed, np.uint64)
    for at in range(0, n, 1 << 16):
        part = values[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(text, shingle: int = 4, seed: int = 42):
    """Column of fingerprints (long) of a text column."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle, seed) for t in texts], dtype="int64")

    return of(text)


def segments(max_distance: int) -> list[tuple[int, int]]:
    """(first bit, length) of the fewest segments of which one differs by at most one bit."""
    n = max_distance // 2 + 1
    edges = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def variant_masks(max_distance: int) -> list[int]:
    """For every bit of every segment the bits of the segment without that one, as signed longs."""
    out = []
    for first, length in segments(max_distance):
        whole = ((1 << length) - 1) << first
        out += [whole & ~(1 << bit) for bit in range(first, first + length)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in out]


def with_variants(prints: DataFrame, max_distance: int) -> DataFrame:
    """(fp, variant): each fingerprint under its signatures.

    Two fingerprints within the distance share one: in the segment that differs by one bit at
    most, the signature that leaves this bit out. `variant` hashes the left-out bit and the
    others' values; a clash of hashes only costs a comparison.
    """
    masks = F.array(*[F.lit(m).cast("long") for m in variant_masks(max_distance)])
    return prints.select("fp", F.posexplode(masks).alias("left_out", "mask")).select(
        "fp", F.xxhash64("left_out", F.col("fp").bitwiseAND(F.col("mask"))).alias("variant")
    )


def linked(prints: DataFrame, max_distance: int, block: int = links.BLOCK) -> DataFrame:
    """Edges (u, v) between the distinct fingerprints `fp`: a forest with the links' components."""

    def near(rows: pa.RecordBatch, group: np.ndarray) -> pa.RecordBatch:
        fp = rows["fp"].to_numpy()
        own, cross = rows["bucket_b"].to_numpy(), rows["bucket_i"].to_numpy() != rows["bucket_j"].to_numpy()
        us, vs = [], []
        for u, v in links.pairs_within(group, own, cross):
            close = np.bitwise_count((fp[u] ^ fp[v]).view(np.uint64)) <= max_distance
            us.append(u[close])
            vs.append(v[close])
        if not us:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["u", "v"])
        root = links.roots(len(fp), np.concatenate(us), np.concatenate(vs))
        hit = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[hit]), pa.array(fp[root[hit]])], ["u", "v"])

    dealt = links.in_blocks(with_variants(prints, max_distance), "variant", "fp", block)
    return links.by_group(dealt, "variant", near, "u long, v long")


def near_groups(prints: DataFrame, max_distance: int = 4, block: int = links.BLOCK) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint of `prints` (doc_id, fp).

    `component_id` is the smallest doc_id among the documents whose fingerprints are reachable
    by links of at most `max_distance` bits; null if all of them have no doc_id.
    """
    classes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-classes")
    found = components_of(classes, max_distance, block)
    rooted = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")).select(links.anew("root").alias("k"), "component_id")
    return rooted.join(least, F.col("root") == F.col("k")).select("fp", "component_id")


def components_of(classes: DataFrame, max_distance: int, block: int) -> DataFrame:
    return links.components(linked(classes.select("fp"), max_distance, block))


def simhash_components(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """Of every row of `docs` (doc_id, text; other columns are ignored): doc_id, fingerprint
    (16 lowercase hex digits) and component_id.

    Texts that are null, empty or without words have fingerprint zero and link like any other.
    Rows with a null doc_id take part; they only lend no component_id. Repeated rows come out
    as often as they come in. An empty table gives no rows.
    """
    prints = store(docs.select("doc_id", fingerprints("text", shingle).alias("fp")), "simhash-prints")
    groups = near_groups(prints, max_distance)
    return prints.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """`docs` with one row of each group of near-duplicates: that with the smallest doc_id.

    Of rows that share it one stays; rows without doc_id stay only where no other is in their
    group. All columns of `docs` come back, whatever their names.
    """
    packed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        fingerprints(docs["text"], shingle).alias("fp"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    packed = store(packed, "simhash-docs")
    keyed = packed.select(F.col("row.doc_id").alias("doc_id"), "fp", "row_no")
    classes = store(
        keyed.groupBy("fp").agg(F.min(_first("doc_id", "row_no")).alias("first")), "simhash-classes"
    )
    found = components_of(classes, max_distance, links.BLOCK)
    winners = (
        classes.join(found, classes["fp"] == found["node"], "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row_no").alias("row_no"))
    )
    return packed.join(winners, "row_no", "left_semi").select("row.*")


def _first(doc_id: str, row_no: str):
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(row_no).alias("row_no"))


def brute_components(texts: Iterator[tuple[int, str | None]], shingle: int = 4, max_distance: int = 4) -> dict:
    """The same by comparing all pairs; for tests on small data."""
    rows = [(i, fingerprint(t, shingle)) for i, t in texts]
    parent = list(range(len(rows)))

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if ((rows[a][1] ^ rows[b][1]) & ((1 << BITS) - 1)).bit_count() <= max_distance:
                parent[max(top(a), top(b))] = min(top(a), top(b))
    out: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        out.setdefault(top(i), []).append(doc_id)
    return {doc_id: min(group) for group in out.values() for doc_id in group}
