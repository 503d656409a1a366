"""Mix sources to target weights by Poisson replication.

A source's documents are repeated so that the source's share of the mix is its weight. The
number of copies of a document is drawn from a Poisson distribution with the source's rate by
inverting the distribution at a uniform number hashed from seed and document, so it does not
depend on partitions or retries. Documents are told apart by their id; those that have none, or
share theirs, by their content, and equal rows by numbers. Copies are then shuffled globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.session import store

#: Larger rates are drawn as a sum of draws of at most this rate, which add up to a Poisson
#: number of the whole rate.
PART_RATE = 16.0
#: Terms of the distribution at PART_RATE after which its sum is 1 in double precision.
TERMS = 80
#: So many sources at most have their rates (under 1 KB each) sent to all executors.
SENT_SOURCES = 10_000
#: Equal rows that are numbered together, and numbered rows to a task.
BLOCK, TASK_ROWS = 1 << 10, 1 << 16


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts, joined by colons (null: empty)."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def cumulative(rate: Column) -> Column:
    """The Poisson distribution of `rate` (up to PART_RATE): array of P(X <= k), k = 0, 1, ..."""
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(state["cdf"], F.array(F.element_at(state["cdf"], -1) + p)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, add, lambda s: s["cdf"])


def rates(docs: DataFrame, weights: DataFrame | None = None, budget: float | None = None) -> DataFrame:
    """Per source of `docs`: source, rate, n_parts and the distribution of one part.

    `weights` (source, weight): relative target shares; sources it lacks (or gives null or less
    than 0) have weight 0. Without it all sources weigh the same. `budget` is the expected number of documents
    of the mix, by default as many as `docs` has. Null is a source of its own.
    """
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        weighted = sizes.withColumn("weight", F.lit(1.0))
    else:
        asked = weights.groupBy(F.col("source").alias("asked")).agg(F.sum("weight").cast("double").alias("weight"))
        weighted = sizes.join(asked, sizes["source"].eqNullSafe(asked["asked"]), "left").drop("asked")
        weighted = weighted.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    # A single row of sums: bounded whatever the number of sources.
    total = weighted.agg(F.sum("weight"), F.sum("n")).first()
    share = F.col("weight") / F.lit(float(total[0] or 1.0) or 1.0)
    rate = share * F.lit(float(budget if budget is not None else total[1] or 0)) / F.col("n")
    parts = F.greatest(F.lit(1), F.ceil(rate / PART_RATE).cast("int"))
    return weighted.select(
        F.col("source").alias("rate_of"), rate.alias("rate"), parts.alias("n_parts"), cumulative(rate / parts).alias("cdf")
    )


def named(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, columns called _0, _1, ..., with `of` (the source) and `name`, what draws
    hang on: the doc_id, or the content and a number among equal rows where rows of a source share
    it (null included)."""
    held = [f"_{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[docs[f"`{c}`"].alias(h) for c, h in zip(docs.columns, held, strict=True)],
                       docs["source"].alias("of"), docs["doc_id"].alias("id"))
    shared = rows.groupBy(F.col("id").alias("shared_id"), F.col("of").alias("shared_by")).agg(F.count("*").alias("n"))
    shared = store(shared.where("n > 1"), "mix-shared")
    n_shared = shared.agg(F.sum("n")).first()[0]
    by_id = [*held, "of", F.col("id").cast("string").alias("name")]
    if not n_shared:
        return rows.select(*by_id)
    same = F.col("id").eqNullSafe(F.col("shared_id")) & F.col("of").eqNullSafe(F.col("shared_by"))
    lone = rows.join(shared, same, "left_anti").select(*by_id)
    content = F.md5(F.to_json(F.struct(*held), {"ignoreNullFields": "false"}).cast("binary"))
    # Equal rows are counted before they are shuffled, and made again in blocks.
    counted = rows.join(shared, same, "left_semi").groupBy(content.alias("content")).agg(
        *[F.first(c).alias(c) for c in [*held, "of"]], F.count("*").alias("n")
    )
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BLOCK)))
    blocks = counted.select("*", block.alias("block")).repartition(-(-n_shared // TASK_ROWS), "content", "block")
    number = F.explode(F.sequence(F.col("block") * BLOCK + 1, F.least("n", (F.col("block") + 1) * BLOCK)))
    twins = blocks.select("*", number.alias("number"))
    return lone.unionByName(twins.select(*held, "of", F.concat_ws(":", "content", "number").alias("name")))


def mix_sources(
    docs: DataFrame, weights: DataFrame | None = None, budget: float | None = None, seed: int = 7
) -> DataFrame:
    """Copies of the rows of `docs` (doc_id, source, ...) in a global random order.

    All columns of `docs` come back, and a struct `mix`: `copy` (from 1) and `place`, the
    uniform number by which rows are dealt to partitions and sorted in them. Draws hang on
    `named`, so rows of a source without ids, and equal rows, draw numbers of their own; rows of
    different sources with one doc_id draw the same. See `rates` for weights; an empty table
    gives an empty mix. A column of `docs` called `mix` gives way to the new one.
    """
    # One short row per source, counted: texts are only shuffled by source where the rates are too
    # many to be sent along, and there AQE splits a hot source.
    rated = store(rates(docs, weights, budget), "mix-rates")
    if rated.count() <= SENT_SOURCES:
        rated = F.broadcast(rated)
    drawn = named(docs).join(rated, F.col("of").eqNullSafe(F.col("rate_of")))

    def one(part: Column) -> Column:
        u = uniform(F.lit(seed), F.col("name"), part)
        return F.aggregate("cdf", F.lit(0), lambda n, c: n + F.when(c <= u, 1).otherwise(0))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("n_parts")), F.lit(0), lambda n, part: n + one(part))
    held = {f"_{i}": c for i, c in enumerate(docs.columns)}
    repeated = drawn.select(*held, "name", copies.alias("copies")).where("copies > 0")
    each = repeated.select(*held, "name", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    placed = each.withColumn("place", uniform(F.lit(seed), F.col("name"), F.lit("copy"), F.col("copy")))
    names = [F.col(h).alias(c) for h, c in held.items() if c != "mix"]
    return (
        placed.repartition("place")
        .sortWithinPartitions("place")
        .select(*names, F.struct("copy", "place").alias("mix"))
    )


#: The equal-weight mix over `documents`, written for DuckDB.
MIX_SQL = """
WITH sized AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rated AS (SELECT source, (1.0::DOUBLE / (SELECT sum(1.0::DOUBLE) FROM sized)) * (SELECT sum(n) FROM sized)::DOUBLE / n AS rate FROM sized),
parted AS (SELECT source, rate, greatest(1, ceil(rate / 16.0::DOUBLE)::INT) AS n_parts FROM rated),
terms AS (SELECT source, n_parts, unnest(range(0, 81)) AS k, rate / n_parts AS r FROM parted),
logs AS (SELECT source, n_parts, k, exp(-r + k * ln(r) - lgamma(k + 1)) AS p FROM terms),
cdf AS (SELECT source, n_parts, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM logs),
draws AS (
    SELECT doc_id, d.source, unnest(range(1, n_parts + 1)) AS part
    FROM documents d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source),
hashed AS (SELECT *, ('0x' || substr(md5(concat_ws(':', '7', coalesce(doc_id::VARCHAR, ''), part::VARCHAR)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM draws),
counted AS (
    SELECT h.doc_id, h.part, count(*) FILTER (c <= u) AS n
    FROM hashed h JOIN cdf ON h.source IS NOT DISTINCT FROM cdf.source GROUP BY h.doc_id, h.part),
copies AS (SELECT doc_id, sum(n)::INT AS copies FROM counted GROUP BY doc_id)
SELECT d.doc_id, d.text, d.source, copy::INT AS copy,
       ('0x' || substr(md5(concat_ws(':', '7', coalesce(doc_id::VARCHAR, ''), 'copy', copy::VARCHAR)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS place
FROM (SELECT d.*, unnest(range(1, copies + 1)) AS copy FROM documents d JOIN copies c USING (doc_id)) d
"""
