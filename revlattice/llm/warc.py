"""WARC archives, index first.

An index with file, offset, length, URL and digest of every record is computed before the
archives are written; reading goes through it: byte ranges of the selected records are sorted,
neighbours are read at once. Payloads that occur again are revisit records.

Archives are gzip files: a record is a member for its head, one for its payload and one for
what ends it. Payloads are packed where they are scanned, so that they are shuffled packed and
their lengths are known to the index beforehand.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

from revlattice.session import store

RECORD_END = "\r\n\r\n"
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
#: Ranges less than GAP apart are read together, up to READ bytes at a time.
GAP, READ = 64 << 10, 2 << 20
#: Bytes that a task reads.
TASK = 32 << 20
#: What tells pages apart; rows that share all of it are copies, numbered from 1.
KEY = ["shard", "digest", "payload_bytes", "page_id", "url"]
INDEX_COLUMNS = [*KEY, "copy", "record_type", "refers_to", "offset", "length"]


def packed(data: bytes) -> bytes:
    """`data` as a gzip member without a time, the same on every machine; nothing for nothing."""
    if not data:
        return b""
    member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return member.compress(data) + member.flush()


#: What ends every record in the files; the writer puts it between rows.
MEMBER_END = packed(RECORD_END.encode())


@F.pandas_udf(BinaryType())
def pack(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: packed(t.encode()))


@F.pandas_udf(LongType())
def packed_length(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: len(packed(t.encode()))).astype("int64")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1, 20 bits (five hex digits, four base32 digits) at a time."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def keyed(pages: DataFrame) -> DataFrame:
    """`pages` (page_id, url, html) with payload, payload_bytes and digest."""
    return (
        pages.select(
            "page_id",
            F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ").alias("url"),
            F.coalesce("html", F.lit("")).alias("payload"),
        )
        .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
        .withColumn("digest", base32_sha1(F.encode("payload", "UTF-8")))
    )


def plan_records(pages: DataFrame, min_revisit_bytes: int = 0, shard_bytes: int = 64 << 20) -> DataFrame:
    """What each record will be, without payloads: KEY, copies, packed_bytes, and of_page, of_url
    (the response among rows with equal payloads; null if the payload is too small to be revisited).

    Of rows with equal payloads of at least `min_revisit_bytes` the one with the largest page_id
    (of equal ones, the largest url) is the response, its first copy at that; the others revisit
    it. A null page_id loses to any other. Shards hold about `shard_bytes`, unpacked.
    """
    same = ["digest", "payload_bytes"]
    rows = keyed(pages).withColumn("packed_bytes", packed_length("payload")).drop("payload")
    each = rows.groupBy(*same, "page_id", "url").agg(F.count("*").alias("copies"), F.max("packed_bytes").alias("packed_bytes"))
    brief = store(each, "warc-brief")
    size = brief.agg(F.sum((F.col("payload_bytes") + 400) * F.col("copies"))).first()[0] or 0
    latest = F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "url")).alias("latest")
    # One short row per payload; AQE can split the rows of a payload that very many pages share.
    first = brief.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy(*same).agg(latest)
    n_shards = max(1, -(-size // shard_bytes))
    planned = brief.join(first, same, "left").withColumn("shard", _shard(F.lit(n_shards)))
    return planned.select(
        *KEY, "copies", "packed_bytes", F.col("latest.page_id").alias("of_page"), F.col("latest.url").alias("of_url"),
        F.lit(n_shards).alias("n_shards"),
    )


def _shard(n: Column) -> Column:
    return F.pmod(F.xxhash64("digest", "page_id", "url"), n).cast("int")


def with_heads(rows: DataFrame) -> DataFrame:
    """Rows of KEY, copy, of_page and of_url with record_type, refers_to and `head`, the record
    up to its payload."""
    own = F.col("of_page").eqNullSafe(F.col("page_id")) & (F.col("of_url") == F.col("url")) & (F.col("copy") == 1)
    typed = rows.withColumn("record_type", F.when(F.col("of_url").isNull() | own, "response").otherwise("revisit"))
    revisit = F.col("record_type") == "revisit"
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    target = F.coalesce(F.col("of_page").cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), "record_type",
        F.lit("\r\nWARC-Target-URI: "), "url",
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: "), _record_id(page, F.col("url"), F.col("copy")),
        F.lit("\r\nWARC-Page-ID: "), page,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), "digest",
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            F.lit("\r\nWARC-Refers-To: "), _record_id(target, F.col("of_url"), F.lit(1)),
        )).otherwise(""),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string"), F.lit("\r\n\r\n"),
    )
    return typed.withColumn("refers_to", F.when(revisit, F.col("of_page"))).withColumn("head", head)


def _record_id(page: Column, url: Column, copy: Column) -> Column:
    name = F.sha1(F.concat_ws("\n", F.col("digest"), page, url, copy.cast("string")).cast("binary"))
    return F.concat(F.lit("<urn:sha1:"), name, F.lit(">"))


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = 0, shard_bytes: int = 64 << 20) -> DataFrame:
    """Write archives of the rows of `pages` (page_id, url, html) below `path`/archive and their
    index to `path`/index; returns the index. See `plan_records` for responses and revisits.

    The index comes first: it needs lengths alone. A shard is one file, `shard=N/part-...`,
    whose records stand in the order of KEY and copy; `offset` and `length` are places in it.
    Payloads are shuffled once, packed, together with what was planned for them. Null html is an empty
    payload, a null url an empty one. Other columns are ignored.
    """
    spark = pages.sparkSession
    planned = store(plan_records(pages, min_revisit_bytes, shard_bytes), "warc-plan")
    order = [F.col(c) for c in KEY[1:]]
    copies = planned.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    heads = with_heads(copies)
    body = F.when(F.col("record_type") == "revisit", F.lit(0)).otherwise(F.col("packed_bytes"))
    sized = heads.withColumn("length", packed_length("head") + body + len(MEMBER_END))
    # A shard, and the rows of its window, are about `shard_bytes`, but for copies: rows of one key share a shard.
    before = Window.partitionBy("shard").orderBy(*order, "copy").rowsBetween(Window.unboundedPreceding, -1)
    sized.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(*INDEX_COLUMNS).write.parquet(f"{path}/index")

    n_shards = planned.agg(F.max("n_shards")).first()[0] or 1
    rows = keyed(pages).withColumn("shard", _shard(F.lit(n_shards))).withColumn("payload", pack("payload"))
    both = rows.unionByName(planned.drop("copies", "packed_bytes", "n_shards"), allowMissingColumns=True).repartitionById(n_shards, "shard")
    # What was planned for a key comes before its pages (nulls first) and is handed down to them.
    same = Window.partitionBy(*KEY).orderBy(F.col("payload").isNotNull())
    told = both.withColumns(
        {
            "copy": F.row_number().over(same) - 1,
            "of_page": F.first("of_page").over(same),
            "of_url": F.first("of_url").over(same),
        }
    ).where("payload is not null")
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    (
        with_heads(told.withColumn("copy", F.col("copy").cast("long")))
        .sortWithinPartitions("shard", *order, "copy")
        # The text writer puts out a string's bytes as they are.
        .select(F.concat(pack("head"), body).cast("string").alias("record"), "shard")
        .write.partitionBy("shard").option("encoding", "ISO-8859-1").option("lineSep", MEMBER_END.decode("latin-1"))
        .text(f"{path}/archive")
    )
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(shard, file) of the archives below `path`, listed by Spark."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/archive")
    shard = F.regexp_extract("path", r"shard=(\d+)", 1).cast("int")
    return files.select(shard.alias("shard"), F.col("path").alias("file"))


def read_records(index: DataFrame, path: str) -> DataFrame:
    """The records of the rows of `index` (any selection): headers (map), payload.

    Ranges are dealt to tasks by file and READ-sized stretch, sorted, and read together where
    they are close. Revisit records have an empty payload.
    """
    spark = index.sparkSession
    chosen = index.join(archive_files(spark, path), "shard").select("file", "offset", "length")
    chosen = chosen.withColumn("stretch", F.floor(F.col("offset") / READ))
    # By bytes to read, not by the size of the short rows that name them.
    total = chosen.agg(F.sum("length")).first()[0] or 0
    dealt = chosen.repartition(max(1, -(-total // TASK)), "file", "stretch").sortWithinPartitions("file", "offset")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, a, b in _coalesced(batch):
                some = batch.iloc[a:b]
                start = int(some["offset"].iloc[0])
                data = _read_range(file, start, int(some["offset"].iloc[-1] + some["length"].iloc[-1]) - start)
                parsed = [
                    parse_record(gzip.decompress(data[o - start : o - start + n]))
                    for o, n in zip(some["offset"], some["length"], strict=True)
                ]
                yield pd.DataFrame({"headers": [h for h, _ in parsed], "payload": [p for _, p in parsed]})

    return dealt.mapInPandas(read, "headers map<string,string>, payload binary")


def _coalesced(batch: pd.DataFrame) -> Iterator[tuple[str, int, int]]:
    """(file, first row, row after the last) of ranges to read at once."""
    at, rows = 0, list(zip(batch["file"], batch["offset"], batch["length"], strict=True))
    for i in range(1, len(rows) + 1):
        if i < len(rows):
            file, offset, length = rows[i]
            near = file == rows[at][0] and offset - sum(rows[i - 1][1:]) <= GAP
            if near and offset + length - rows[at][1] <= READ:
                continue
        yield rows[at][0], at, i
        at = i


def _read_range(file: str, offset: int, length: int) -> bytes:
    """Bytes of a file in any store that Arrow's file systems reach."""
    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(file if "://" in file else "file://" + file.removeprefix("file:"))
    with where.open_input_file(name) as source:
        return source.read_at(length, offset)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record's unpacked bytes; raises if they are not a whole record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(headers["Content-Length"])
    if version != "WARC/1.1" or rest[size:] != RECORD_END.encode():
        raise ValueError("the index does not point at a whole record")
    return headers, rest[:size]


def read_back(index: DataFrame, path: str) -> DataFrame:
    """Per record of `index`, from the archives: page_id, payload_bytes, payload_digest,
    record_type, refers_to. Revisits take size and digest from the response they point at.
    No pages give no archives and no rows."""
    got = read_records(index, path)

    @F.pandas_udf("string")
    def digest(payloads: pd.Series) -> pd.Series:
        return payloads.map(lambda p: b32encode(hashlib.sha1(p).digest()).decode())

    brief = store(
        got.select(
            F.col("headers")["WARC-Record-ID"].alias("record_id"),
            F.col("headers")["WARC-Type"].alias("record_type"),
            F.when(F.col("headers")["WARC-Page-ID"] != "", F.col("headers")["WARC-Page-ID"]).cast("long").alias("page_id"),
            F.col("headers")["WARC-Refers-To"].alias("refers_id"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            digest("payload").alias("payload_digest"),
        ),
        "warc-read",
    )
    response = brief.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    target = brief.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest"
    )
    revisits = brief.where("record_type = 'revisit'").select("page_id", "record_type", "refers_id")
    again = revisits.join(target, "refers_id").select(*response.columns)
    return response.unionByName(again)


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS s FROM p),
b AS (SELECT page_id, payload_bytes, translate(
    list_aggregate(list_transform(range(0, 8), lambda i: to_base(('0x' || substr(s, 5 * i::INT + 1, 5))::BIGINT, 32, 4)), 'string_agg', ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest FROM d),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS latest FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = latest THEN NULL ELSE latest END AS refers_to
FROM m
"""
