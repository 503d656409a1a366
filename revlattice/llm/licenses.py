"""License scans: phrases, and an exact set-similarity join with license notices.

A text block holds a notice if it has the share `threshold` of the notice's distinct words.
Words are ordered by how many documents have them, rarest first. A block that holds a notice
shares a word with the notice's prefix in that order; length and positional filters drop most
other blocks before the sets are compared. Built-in expressions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlattice.session import store

# Phrases with their labels, and notices as their licenses word them.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a lower-cased text."""
    return F.filter(F.split(text, NOT_WORD), lambda w: w != "")


def notice_words(text: str) -> list[str]:
    kept = "".join(c if c.isascii() and c.isalnum() or ord(c) >= 128 else " " for c in text)
    return list(dict.fromkeys(kept.translate(str.maketrans(UPPER, LOWER)).split()))


def needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(round(threshold * size, 9)))


def places(words_: Column, phrase: str) -> Column:
    """Array of the places where the phrase's words stand one after the other."""
    parts = phrase.split()
    last = F.size(words_) - len(parts)
    at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))

    def here(i: Column) -> Column:
        ok = F.get(words_, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            ok = ok & (F.get(words_, i + k) == part)
        return ok

    return F.filter(at, here)


def scan(docs: DataFrame, vocabulary: list[str], least: int) -> DataFrame:
    """One pass over the texts: row_no, doc_id, n_words, the places of each phrase, the words of
    the vocabulary (`known`), and the blocks with at least `least` of them.

    Blocks are lines, and paragraphs of several lines (between empty lines).
    """
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    held = docs.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", text.alias("t"))
    vocab = F.array(*[F.lit(w) for w in vocabulary])
    held = held.withColumn("w", words(F.col("t")))
    none = F.array().cast("array<int>")
    spots = [
        F.when(F.col("t").contains(phrase.split()[-1]), places(F.col("w"), phrase)).otherwise(none).alias(f"at_{i}")
        for i, phrase in enumerate(PHRASES)
    ]
    known = F.array_intersect(vocab, F.col("w"))
    held = held.select("row_no", "doc_id", F.size("w").cast("long").alias("n_words"), *spots, known.alias("known"), "t")
    paragraphs = F.filter(F.split("t", r"\n[\x20\t\r]*\n"), lambda b: b.contains("\n"))
    blocks = F.concat(F.split("t", "\n"), paragraphs)
    sets = F.filter(F.transform(blocks, lambda b: F.array_intersect(vocab, words(b))), lambda s: F.size(s) >= least)
    many = F.when(F.size("known") >= least, sets).otherwise(F.array().cast("array<array<string>>"))
    return held.withColumn("blocks", F.array_distinct(many)).drop("t")


def prefix_index(spark: SparkSession, order: list[str], notices: list[tuple[str, str]], threshold: float) -> DataFrame:
    """Per word in a notice's prefix: word, notice, label, place, size, need, words."""
    rank, rows = {w: i for i, w in enumerate(order)}, []
    for number, (label, text) in enumerate(notices):
        ordered = sorted(notice_words(text), key=rank.__getitem__)
        need = needed(len(ordered), threshold)
        rows += [
            (ordered[i], number, label, i, len(ordered), need, ordered) for i in range(len(ordered) - need + 1)
        ]
    return spark.createDataFrame(
        rows, "word string, notice int, label string, place int, size int, need int, notice_words array<string>"
    )


def held_notices(scanned: DataFrame, notices: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(row_no, label, containment) of every block and notice at or above the threshold."""
    vocabulary = sorted({w for _, text in notices for w in notice_words(text)})
    # One number per word of the notices, over all documents.
    counts = scanned.select(F.explode("known").alias("word")).groupBy("word").count().collect()
    seen = {r["word"]: r["count"] for r in counts}
    order = sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))
    index = prefix_index(scanned.sparkSession, order, notices, threshold)
    ranked = F.array(*[F.lit(w) for w in order])
    starts = F.array(*[F.lit(r["word"]) for r in index.select("word").distinct().collect()])
    blocks = scanned.select("row_no", F.explode("blocks").alias("block")).where(F.arrays_overlap("block", starts))
    placed = blocks.select("row_no", F.array_intersect(ranked, F.col("block")).alias("block"))
    each = placed.select("row_no", "block", F.posexplode("block").alias("at", "word"))
    left = F.least(F.col("size") - F.col("place"), F.size("block") - F.col("at"))
    joined = each.join(index, "word").where((F.size("block") >= F.col("need")) & (left >= F.col("need")))
    shared = F.size(F.array_intersect("notice_words", "block"))
    return joined.where(shared >= F.col("need")).select("row_no", "label", (shared / F.col("size")).alias("containment"))


def find_licenses(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES, threshold: float = 0.9) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    Phrases are found as consecutive words; `labels` adds those of notices that a line or
    paragraph holds. score is 1 where a phrase stands, else the highest containment found, else
    0. Null and empty texts have no words and score 0. Repeated rows come out as often as they
    come in; null ids are carried along; other columns are ignored.
    """
    vocabulary = sorted({w for _, text in notices for w in notice_words(text)})
    least = min(needed(len(notice_words(text)), threshold) for _, text in notices)
    scanned = store(scan(docs, vocabulary, least), "license-scan")
    found = held_notices(scanned, notices, threshold)
    by_row = found.groupBy("row_no").agg(F.collect_set("label").alias("held"), F.max("containment").alias("containment"))
    spots = [f"at_{i}" for i in range(len(PHRASES))]
    every = F.concat(*spots)
    base = F.array_compact(F.array(*[F.when(F.size(s) > 0, label) for s, label in zip(spots, PHRASES.values(), strict=True)]))
    both = F.array_union(F.col("base"), F.coalesce("held", F.array().cast("array<string>")))
    joined = scanned.withColumn("base", base).join(by_row, "row_no", "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(both)), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )


def _license_sql() -> str:
    quoted = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    notices = ", ".join(
        f"('{label}', {quoted(notice_words(text))}, {needed(len(notice_words(text)), 0.9)})" for label, text in NOTICES
    )
    spots = []
    for phrase in PHRASES:
        parts = phrase.split()
        test = " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(parts))
        spots.append(f"list_filter(range(0, greatest(len(w) - {len(parts) - 1}, 0)), lambda i: {test})")
    labels = list(PHRASES.values())
    base = "list_concat(" + ", ".join(f"CASE WHEN len(p{i}) > 0 THEN ['{x}'] ELSE [] END" for i, x in enumerate(labels)) + ")"
    split = "list_filter(regexp_split_to_array({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    return f"""
WITH notice(label, ws, need) AS (VALUES {notices}),
t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
d AS (SELECT doc_id, t, {split.format('t')} AS w FROM t),
p AS (SELECT doc_id, t, len(w) AS n_words, {", ".join(f"{s} AS p{i}" for i, s in enumerate(spots))} FROM d),
blocks AS (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS b FROM t
    UNION ALL SELECT doc_id, unnest(regexp_split_to_array(t, '\\n[\\x20\\t\\r]*\\n')) FROM t),
sets AS (SELECT doc_id, {split.format('b')} AS ws FROM blocks),
held AS (
    SELECT doc_id, label, len(list_intersect(notice.ws, sets.ws)) / len(notice.ws) AS c
    FROM sets, notice WHERE len(list_intersect(notice.ws, sets.ws)) >= need),
by_doc AS (SELECT doc_id, list(DISTINCT label) AS labels, max(c) AS c FROM held GROUP BY doc_id)
SELECT p.doc_id, n_words, len(p0) + len(p1) + len(p2) AS n_base,
       list_min(list_concat(p0, p1, p2)) AS first_word, list_max(list_concat(p0, p1, p2)) AS last_word,
       array_to_string(list_sort(list_distinct({base})), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat({base}, coalesce(by_doc.labels, [])))), ',') AS labels,
       CASE WHEN len(p0) + len(p1) + len(p2) > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0.0::DOUBLE) END AS score
FROM p LEFT JOIN by_doc ON p.doc_id = by_doc.doc_id
"""


LICENSE_SQL = _license_sql()
