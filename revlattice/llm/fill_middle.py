"""Fill-in-middle transformation on bytes, with a sparse index of multibyte characters.

Cuts are drawn in units (words and single other characters) and reported in code points, but
texts are cut as UTF-8 bytes. Only characters of more than one byte are indexed, by position and
number of bytes beyond the first; between them, code points and bytes run in step, so a cut is
converted by one binary search and a sum. An ASCII text has an empty index and needs neither.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


class Exceptions:
    """The multibyte characters of a text: where they are, in bytes and in code points, and how
    many bytes beyond one each has taken by its end."""

    def __init__(self, data: np.ndarray):
        self.at_byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.at_byte]
        excess = 1 + (lead >= 0xE0) + (lead >= 0xF0)
        self.total = np.cumsum(excess, dtype=np.int64)
        self.at_char = self.at_byte - (self.total - excess)
        self.n_chars = len(data) - (int(self.total[-1]) if len(self.total) else 0)

    def char_of(self, byte):
        """Code points before the byte (one at the start of a character)."""
        return byte - self._before(self.at_byte, byte)

    def byte_of(self, char):
        """Bytes before the code point."""
        return char + self._before(self.at_char, char)

    def _before(self, at: np.ndarray, cut):
        if not len(at):
            return 0
        n = np.searchsorted(at, cut)
        return np.where(n > 0, self.total[np.maximum(n, 1) - 1], 0)


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Byte positions where units start: runs of A-Z and a-z, and every other character."""
    letter = _LETTER[data]
    inside = np.zeros(len(data), bool)
    inside[1:] = letter[1:] & letter[:-1]
    return np.flatnonzero(~inside & ((data & 0xC0) != 0x80))


def cut(data: np.ndarray, first: int, second: int) -> tuple[int, int, int, int, int]:
    """(n units, byte cuts, code point cuts) of a text cut after first % (n+1) and second % (n+1) units."""
    starts = unit_starts(data)
    n = len(starts)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    ends = np.append(starts, len(data))
    b1, b2 = int(ends[low]), int(ends[high])
    c1, c2 = (int(c) for c in np.broadcast_to(Exceptions(data).char_of(np.array([b1, b2])), 2))
    return n, b1, b2, c1, c2


def transform(text: bytes, draws: tuple[int, ...], plain_from: int, spm_below: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text; `draws` are four numbers."""
    h1, h2, h3, h4 = draws
    data = np.frombuffer(text, np.uint8)
    n, b1, b2, c1, c2 = cut(data, h1, h2)
    if not text or h3 % 100 >= plain_from or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:b1], text[b1:b2], text[b2:]
    if h4 % 100 < spm_below:
        return n, "spm", c1, c2 - c1, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", c1, c2 - c1, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restore(output: bytes, form: str) -> bytes:
    """The text that an output of this form was made of. No mark is in the text, so the first
    one found is the one that was put there."""
    if form == "plain":
        return output
    first, rest = output[len(PREFIX) :].split(SUFFIX if form == "psm" else PREFIX, 1)
    second, middle = rest.split(MIDDLE, 1)
    return first + middle + second if form == "psm" else second + middle + first


_SCHEMA = "doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(
    docs: DataFrame, seed: int = 1, plain_share: int = 10, spm_share: int = 20
) -> DataFrame:
    """Of every row of `docs` (doc_id, text; other columns are ignored): doc_id, n (units), form
    (plain, psm or spm), prefix_chars and middle_chars (code points; null if plain) and output.

    Draws come from the SHA-256 of "seed:doc_id", so they do not hang on partitions or retries;
    rows that share a doc_id share their draws. Of 100 texts about `plain_share` stay plain, and of the
    others `spm_share` of 100 put the suffix first. Null texts are empty, and empty texts and those that hold
    one of the marks are plain; a null doc_id draws as an empty one. Repeated rows come out as often
    as they come in, an empty table gives no rows. A text is worked on whole, in memory of
    about ten times its bytes.
    """
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), draws.alias("draws"))
    plain_from = 100 - plain_share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, drawn = batch["text"], batch["draws"].flatten().to_numpy().reshape(-1, 4).tolist()
            made = [transform(t.as_py(), d, plain_from, spm_share) for t, d in zip(texts, drawn, strict=True)]
            n, form, prefix, middle, output = zip(*made, strict=True) if made else ([],) * 5
            columns = [batch["doc_id"], pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                       pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(run, _SCHEMA.format(kind=docs.schema["doc_id"].dataType.simpleString()))


def restored(output, form):
    """Column: the texts rebuilt from columns `output` and `form` of `fill_in_middle`."""

    @F.pandas_udf("string")
    def of(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([restore(o, f).decode() for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return of(output.cast("binary"), form)


def digests(filled: DataFrame) -> DataFrame:
    """`fill_in_middle` with digests in place of its texts."""
    return filled.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


#: The same results in SQL, unit by unit.
FILL_SQL = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents),
numbers AS (
    SELECT doc_id, t, units, CAST(len(units) AS BIGINT) AS n,
           [CAST('0x' || substr(h, 8 * CAST(i AS INTEGER) + 1, 8) AS BIGINT) FOR i IN range(4)] AS r
    FROM drawn),
cuts AS (
    SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 90 THEN 'plain'
                WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers),
parts AS (
    SELECT doc_id, t, n, form, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m,
           array_to_string(units[b + 1:n], '') AS s
    FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""
