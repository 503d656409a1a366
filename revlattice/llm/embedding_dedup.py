"""Near-duplicate embeddings: Euclidean p-stable hashing, then exact cosines.

Normalised vectors fall into buckets by quantised random projections, in several tables; vectors
that share a bucket are compared exactly. A pair counts in the first table that joins it. Equal vectors of
a label are one class: they link with each other without being compared, and one of them is
compared with the other classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.functions.skew import attach_unique
from revlattice.llm import links
from revlattice.session import store

#: Close pairs in one go of the exact check.
CHECKED = 1 << 16


def projections(dimensions: int, tables: int, per_table: int, width: float, seed: int):
    """(directions, shifts) of all tables: h(v) = floor((a v + b) / width), a normal, b uniform."""
    rng = np.random.default_rng(seed)
    return rng.normal(size=(dimensions, tables * per_table)), rng.uniform(0, width, tables * per_table)


def bucket_keys(unit: np.ndarray, tables: int, per_table: int, width: float, seed: int) -> np.ndarray:
    """A 32-bit key per vector (row) and table; a clash of cells only costs comparisons."""
    a, b = projections(unit.shape[1], tables, per_table, width, seed)
    cells = np.floor((unit @ a + b) / width).astype(np.int64).reshape(len(unit), tables, per_table)
    mix = np.random.default_rng(seed + 1).integers(1, 2**63 - 1, per_table, dtype=np.int64) | 1
    with np.errstate(over="ignore"):
        key = (cells * mix).sum(axis=2)
        key ^= key >> 29
        return ((key * np.int64(0x1CE4E5B9BF58476D)) >> 32).astype(np.int32)


def signatures(vectors: DataFrame, tables: int, per_table: int, width: float, seed: int) -> DataFrame:
    """`vectors` (vec_id, embedding, label) with `keys`, an array of one key per table.

    Null for vectors that link with nothing: null, empty, zero, or with a null or non-finite
    component, or without a label.
    """

    @F.pandas_udf("array<int>")
    def keys(embedding: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(embedding), dtype=object)
        by_size: dict[int, list[int]] = {}
        for i, v in enumerate(embedding):
            if v is not None and len(v):
                by_size.setdefault(len(v), []).append(i)
        for rows in by_size.values():
            x = np.array([np.asarray(embedding.iloc[i], np.float64) for i in rows])
            with np.errstate(all="ignore"):
                norm = np.linalg.norm(x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300), axis=1)
            good = np.isfinite(x).all(axis=1) & (np.abs(x).max(axis=1) > 0) & np.isfinite(norm)
            if good.any():
                found = bucket_keys(unit_rows(x[good]), tables, per_table, width, seed)
                for i, k in zip(np.array(rows)[good], found, strict=True):
                    out.iloc[i] = k
        return out

    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull())
    return vectors.withColumn("keys", F.when(usable, keys(F.when(usable, F.col("embedding")))))


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by their largest component first, against overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def close_links(rows: DataFrame, min_cosine: float, block: int) -> DataFrame:
    """Of signed classes (row_no, label, embedding, keys, members): (node, links, root), a row per group of
    blocks and class that links there; `links` counts the members of the classes it links with, and `root` is
    a class it is connected with."""

    def near(part: pa.RecordBatch, group: np.ndarray) -> pa.RecordBatch:
        node, own = part["row_no"].to_numpy(), part["bucket_b"].to_numpy()
        cross = part["bucket_i"].to_numpy() != part["bucket_j"].to_numpy()
        table, n = part["table"].to_numpy(), part.num_rows
        keys = _matrix(part["keys"])
        sizes = np.diff(part["embedding"].offsets.to_numpy())
        label = part["label"].dictionary_encode().indices.to_numpy()
        width = int(sizes.max()) if n else 0
        # Vectors of other lengths never share a cosine; their places beyond the end stay zero.
        x = np.zeros((n, width))
        values = part["embedding"].flatten().to_numpy().astype(np.float64)
        x[np.arange(width)[None, :] < sizes[:, None]] = values
        unit = unit_rows(x)
        members = part["members"].to_numpy()
        count = np.zeros(n, np.int64)
        us, vs = [], []
        for u_all, v_all in links.pairs_within(group, own, cross):
            for at in range(0, len(u_all), CHECKED):
                u, v = u_all[at : at + CHECKED], v_all[at : at + CHECKED]
                hit = np.einsum("ij,ij->i", unit[u], unit[v]) >= min_cosine
                u, v = u[hit], v[hit]
                # Joined by an earlier table: counted there.
                before = ((keys[u] == keys[v]) & (np.arange(keys.shape[1]) < table[u][:, None])).any(axis=1)
                # Buckets are hashes: other labels or lengths may clash with a bucket.
                new = ~before & (sizes[u] == sizes[v]) & (label[u] == label[v])
                u, v = u[new], v[new]
                us.append(u)
                vs.append(v)
                np.add.at(count, u, members[v])
                np.add.at(count, v, members[u])
        if us:
            root = links.roots(n, np.concatenate(us), np.concatenate(vs))
            hit = np.flatnonzero(count)
            columns = [node[hit], count[hit], node[root[hit]]]
        else:
            columns = [np.empty(0, np.int64)] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "root"])

    # Buckets are counted and cut on short rows; vectors follow only where there is company.
    signed = rows.where("keys is not null")
    bucket = F.xxhash64("table", "cell", "label", "size")
    members = signed.select("row_no", "label", F.size("embedding").alias("size"), F.posexplode("keys").alias("table", "cell"))
    short = members.select("row_no", "table", bucket.alias("bucket"))
    dealt = links.in_blocks(short, "bucket", "row_no", block, drop_single=True)
    dealt = dealt.join(signed.select("row_no", "label", "embedding", "keys", "members"), "row_no")
    return links.by_group(dealt, "bucket", near, "node long, links long, root long")


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def near_embeddings(
    vectors: DataFrame, min_cosine: float = 0.98, tables: int = 32, per_table: int = 8, width: float = 1.2,
    seed: int = 11, block: int = links.BLOCK,
) -> DataFrame:
    """Per row of `vectors` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Rows with equal labels and a cosine of at least `min_cosine` in double precision link, if
    any table joins them (see README for the recall). Vectors that are null, empty, zero or hold
    null or non-finite components, and rows without a label, link with nothing. Equal rows link
    with each other. component_id is the smallest vec_id reachable; kept tells whether it is the
    row's own. Rows with a null vec_id take part but lend no component_id. An empty table gives no rows.

    Cosines are products of vectors scaled to length 1, so a pair within a last bit of the threshold may fall on
    either side.
    """
    same = F.concat_ws(":", *[F.hex(F.xxhash64(F.lit(part), "label", "embedding")) for part in (1, 2)])
    rows = vectors.select(F.monotonically_increasing_id().alias("row_no"), "vec_id", "embedding", "label")
    rows = store(signatures(rows, tables, per_table, width, seed).withColumn("same", F.when(F.col("keys").isNotNull(), same)), "embedding-keys")
    classes = rows.where("same is not null").groupBy("same").agg(
        F.min("row_no").alias("class_no"), F.count("*").alias("members"), F.min("vec_id").alias("least_id")
    )
    classes = store(classes, "embedding-classes")
    one_each = rows.join(classes.select(F.col("class_no").alias("row_no"), "members"), "row_no")
    found = store(close_links(one_each, min_cosine, block), "embedding-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    edges = found.select(F.col("node").alias("u"), F.col("root").alias("v"))
    rooted = (
        classes.join(counts, F.col("class_no") == counts["node"], "left").drop("node")
        .join(links.components(edges), F.col("class_no") == F.col("node"), "left")
        .select("same", "least_id", (F.col("members") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"), F.coalesce("root", "class_no").alias("root"))
    )
    rooted = store(rooted, "embedding-rooted")
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id")).select(links.anew("root").alias("k"), "component_id")
    known = rooted.join(least, F.col("root") == F.col("k")).select("same", "n_links", "component_id")
    component = F.when(F.col("same").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return attach_unique(rows.select("vec_id", "same"), "same", known, "same").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


#: All pairs and their components, written for DuckDB.
NEAR_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS x, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
    FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
link AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.x, b.x) / (a.norm * b.norm) >= 0.98),
reach AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
degree AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least l ON e.vec_id = l.u LEFT JOIN degree d ON e.vec_id = d.u
"""


def brute_links(rows: list[tuple], min_cosine: float) -> Iterator[tuple[int, int]]:
    """All linked pairs of places in `rows` (vec_id, embedding, label), by comparing all; for tests."""
    unit = []
    for _, v, label in rows:
        ok = label is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)
        unit.append(unit_rows(np.array([v], float))[0] if ok else None)
    for i, a in enumerate(unit):
        for j in range(i):
            b = unit[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= min_cosine:
                yield j, i
