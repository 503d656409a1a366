"""Token ids in ORC files: run-length encoded ids, row indexes and Bloom filters on doc_id.

Documents are sorted by doc_id over all files and inside each, so the row indexes prune by
ranges of doc_id and the Bloom filters by single ones; stripes are read in parallel.
"""

from __future__ import annotations

import itertools
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END_ID = 2
FILE_SCHEMA = "doc_id long, ids array<int>, first_id long, part int"
#: Texts of so many bytes are split into words at a time.
SLICE_BYTES = 8 << 20
#: Words whose ids a Python worker keeps.
KEPT_WORDS = 800_000


class WordIds:
    """Ids of texts, through the tokenizers library once per word.

    For tokenizers that drop white space and split at it, so a text's ids are those of its
    white-space-separated words. Words are lowered (ASCII) as the tokenizer would do itself,
    and ASCII marks that end a word are cut off where the tokenizer splits there as well, which
    leaves fewer words to encode. A text with "<|" goes to the library whole, as it may hold a
    special token's string.
    """

    #: Marks of one kind for the tokenizer's split; the apostrophe has rules of its own.
    MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        # Ids as the bytes of 32-bit integers: small, and quick to join.
        self.known: dict[bytes, bytes] = {b"": b""}

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of these distinct words."""
        if len(self.known) > KEPT_WORDS:
            self.known = {b"": b""}
        get, out, missing, new = self.known.get, [], [], {}
        for word in words:
            ids = get(word)
            if ids is None:
                head = word
                if word[-1] in self.MARKS:
                    head = word.rstrip(self.MARKS)
                    if not head[-1:].isalnum():
                        head = word
                tail = word[len(head) :]
                first, last = get(head), get(tail)
                if first is None or last is None:
                    missing.append((len(out), head, tail))
                    new[head] = new[tail] = None
                else:
                    ids = first + last
            out.append(ids)
        if new:
            unknown = [w for w in new if w not in self.known]
            done = self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in unknown], add_special_tokens=False)
            self.known.update(zip(unknown, (array("i", e.ids).tobytes() for e in done), strict=True))
            for at, head, tail in missing:
                out[at] = self.known[head] + self.known[tail]
        return out

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, how many each has), the end id after each text."""
        odd = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        lowered = pc.ascii_lower(pc.if_else(pa.array(odd), "", texts))
        split = pc.ascii_split_whitespace(lowered)
        per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        ids = self.words(coded.dictionary.cast(pa.binary()).to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.int32)
        begin = np.cumsum(size) - size
        # The end id is one more word, after the words of each text.
        flat, size, begin = np.append(flat, np.int32(end_id)), np.append(size, 1), np.append(begin, len(flat))
        order = np.insert(codes.astype(np.int64), np.cumsum(per_text), len(size) - 1)
        each = size[order]
        out_at = np.cumsum(each) - each
        out = flat[np.repeat(begin[order] - out_at, each) + np.arange(int(each.sum()))]
        total = np.concatenate(([0], np.cumsum(each)))
        last = np.cumsum(per_text + 1)
        counts = np.diff(np.concatenate(([0], total[last])))
        if not odd.any():
            return out, counts
        pieces, at = [], 0
        for i, n in enumerate(counts.tolist()):
            piece = out[at : at + n]
            at += n
            if odd[i]:
                piece = np.array([*self.whole(texts[i].as_py()), end_id], np.int32)
                counts[i] = len(piece)
            pieces.append(piece)
        return np.concatenate(pieces), counts


_encoders: dict[str, WordIds] = {}


def _encoder(file: str) -> WordIds:
    """One per Python worker, kept for its next tasks."""
    if file not in _encoders:
        _encoders[file] = WordIds(file)
    return _encoders[file]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        yield at, to
        at = to


def token_rows(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID) -> DataFrame:
    """`docs` (doc_id, text) sorted by doc_id, encoded: FILE_SCHEMA.

    `first_id` counts the ids before the document in its part. Null and empty texts give the
    end id alone; a null doc_id sorts first. Rows that share a doc_id follow in the order of
    their text's hash. Other columns are ignored.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    # A doc_id that very many rows share is split by the rest of the key.
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row_no", F.monotonically_increasing_id())
    key = ["doc_id", "tie", "row_no"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, before = _encoder(tokenizer_file), TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b in _slices(batch["text"]):
                doc_id, texts = batch["doc_id"].slice(a, b - a), batch["text"].slice(a, b - a)
                ids, counts = encoder.encode(texts, end_id)
                ends = np.cumsum(counts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids))
                first = pa.array(before + ends - counts)
                yield pa.RecordBatch.from_arrays(
                    [doc_id, lists, first, pa.array(np.full(b - a, part, np.int32))],
                    ["doc_id", "ids", "first_id", "part"],
                )
                before += int(ends[-1])

    ordered = rows.repartitionByRange(*key).sortWithinPartitions(*key).select("doc_id", "text")
    return ordered.mapInArrow(encode, FILE_SCHEMA)


def write_token_orc(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID, row_index_stride: int = 1000
) -> None:
    """Write the ids of `docs` (see `token_rows`) as ORC files below `path`.

    Ids are run-length encoded by ORC; every `row_index_stride` rows have an index entry and a
    Bloom filter of their doc_ids.
    """
    (
        token_rows(docs, tokenizer_file, end_id)
        .write.option("orc.create.index", "true")
        .option("orc.row.index.stride", str(row_index_stride))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("compression", "zstd")
        .orc(path)
    )


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows: doc_id, ids, first_id, part. Filters on doc_id prune stripes."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def token_digest(files: DataFrame) -> DataFrame:
    """Per document of `files`: doc_id, start (ids of all documents before it), n_tokens (with
    the end id), ids_crc32 (of the ids as little-endian unsigned 32-bit integers). No documents give no rows."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            values = np.ascontiguousarray(ids.values.to_numpy(), "<u4").view(np.uint8)
            ends = ids.offsets.to_numpy().astype(np.int64) * 4
            crc = [zlib.crc32(values[a:b]) for a, b in itertools.pairwise(ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(np.diff(ends) // 4), pa.array(crc, pa.int64()), batch["first_id"], batch["part"]],
                ["doc_id", "n_tokens", "ids_crc32", "first_id", "part"],
            )

    rows = files.mapInArrow(digest, "doc_id long, n_tokens long, ids_crc32 long, first_id long, part int")
    # One row per file: the running sum over them is short.
    totals = files.groupBy("part").agg(F.sum(F.size("ids")).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(base, "part").select(
        "doc_id", (F.col("base") + F.col("first_id")).alias("start"), "n_tokens", "ids_crc32"
    )
