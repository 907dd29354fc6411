"""Web archives: revisit resolution, writing, and reading back.

Only headers meet in a shuffle: a payload is known there by its SHA-1, its SHA-256 and its length. Archives are
written and read with Spark's own sources, so they may lie in any store that Spark reaches.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.storage import settled
from scoreloom.llm.common import lookup, whole_text

# The alphabet of base 32, and the names that the archive format gives.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE = "\r\n"

# Bytes of records in one archive file, before compression; a reader holds one file at a time.
FILE_BYTES = 32 << 20
# Bytes of records that a reader hands on at once.
BATCH_BYTES = 4 << 20

RECORDS = (
    "page_id long, url string, record_type string, payload_digest string, refers_to long, "
    "http_length long, payload binary, intact boolean"
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of the payload's UTF-8 bytes in base 32: 160 bits, 40 at a time, five to a letter."""
    digits = F.sha1(payload)
    groups = [F.conv(F.substring(digits, 1 + 10 * g, 10), 16, 10).cast("long") for g in range(4)]
    letters = [
        F.substring(F.lit(BASE32), F.shiftright(groups[j // 8], 35 - 5 * (j % 8)).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1))
        for j in range(32)
    ]
    return F.concat(*letters)


def captured(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, sha256`` of ``pages(page_id, url, html)``."""
    payload = whole_text("html")
    return pages.select("page_id", "url", payload.alias("payload")).select(
        "*",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        F.sha2("payload", 256).alias("sha256"),
    )


def resolved(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The records with ``record_type`` and ``refers_to``.

    Of records with equal payloads of at least ``least_bytes`` bytes, that with the largest ``page_id`` is the
    response and the others revisit it. Headers are shuffled by digest after a partial maximum in each task, so
    a payload that a third of all pages share is one row per task. Only payloads that occur more than once come back
    to the records. Records without a ``page_id`` revisit one that has one; if none has, all are responses. Records
    that repeat both id and payload are responses alike.
    """
    key = ["payload_digest", "sha256", "payload_bytes"]
    originals = (
        records.where(F.col("payload_bytes") >= least_bytes)
        .groupBy(*key)
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("original").isNotNull())
        .drop("n")
    )
    again = F.col("original").isNotNull() & ~F.col("original").eqNullSafe(F.col("page_id"))
    return (
        lookup(records, settled(originals, "originals"), key)
        .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(again, F.col("original")))
        .drop("original")
    )


def record_text(date: str) -> Column:
    """One archive record as text, up to its last line end. A revisit keeps the HTTP header and leaves out the payload."""

    def name(page_id: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))

    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(LINE + LINE),
    )
    again = F.col("record_type") == "revisit"
    length = F.octet_length(http) + F.when(again, 0).otherwise(F.col("payload_bytes"))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(again, F.lit(f"WARC-Profile: {SAME_PAYLOAD}")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), name(F.col("refers_to")))),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    return F.concat(F.concat_ws(LINE, *lines), F.lit(LINE + LINE), block, F.lit(LINE))


def write_archives(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """Write resolved records as archives of about ``FILE_BYTES`` each. The files' line end closes each record."""
    mean = records.agg(F.avg("payload_bytes")).first()[0] or 0
    writer = records.select(record_text(date).alias("value")).write.option("lineSep", LINE)
    writer.option("maxRecordsPerFile", max(1, int(FILE_BYTES / (mean + 500)))).option("compression", compression).text(path)


def members(data: bytes) -> Iterator[bytes]:
    """The content of a file: as it is, or of each of its compressed members, of which archives have one per record or per file."""
    while data[:2] == b"\x1f\x8b":
        opened = zlib.decompressobj(31)
        yield opened.decompress(data) + opened.flush()
        data = opened.unused_data.lstrip(b"\0")
    if data:
        yield data


def headers(data: bytes) -> dict[str, str]:
    """Header lines by name in lower case; the first line, and lines without a colon, are passed over."""
    lines = [line.partition(":") for line in data.decode("utf-8", "replace").split(LINE)[1:]]
    return {name.strip().lower(): value.strip() for name, colon, value in lines if colon}


def named_page(uri: str | None) -> int | None:
    """The page that an id of this module's archives names; archives from elsewhere name none."""
    match = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(match[1]) if match else None


def parsed(data: bytes) -> Iterator[tuple]:
    """The responses and revisits of an archive, found by their lengths, so that a payload may hold anything. Other records are passed over.

    A block that is no HTTP message is a payload as a whole. Without a digest in SHA-1 nothing is said on whether it is intact.
    """
    at = 0
    while True:
        while data.startswith((b"\r", b"\n"), at):
            at += 1
        if at >= len(data):
            return
        start = data.index(b"\r\n\r\n", at) + 4
        head = headers(data[at:start])
        at = start + int(head["content-length"])
        kind, block = head.get("warc-type"), data[start:at]
        if kind not in ("response", "revisit"):
            continue
        http, payload = {}, block
        if head.get("content-type", "").startswith("application/http"):
            first, _, payload = block.partition(b"\r\n\r\n")
            http = headers(first)
        length = http.get("content-length", "")
        digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        body = payload if kind == "response" else None
        intact = None
        if body is not None and digest and ":" not in digest:
            intact = base64.b32encode(hashlib.sha1(body).digest()).decode() == digest
        ids = [named_page(head.get(name)) for name in ("warc-record-id", "warc-refers-to")]
        yield ids[0], head.get("warc-target-uri"), kind, digest, ids[1], int(length) if length.isdecimal() else len(payload), body, intact


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The responses and revisits of all archives under a path, as ``RECORDS``; ``intact`` says whether a response has its digest.

    Archives may be compressed as a whole or record by record. A record whose id is not one of this module's has no ``page_id``.
    """
    columns = [c.split()[0] for c in RECORDS.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                rows, held = [], 0
                for row in itertools.chain.from_iterable(map(parsed, members(data))):
                    held += len(row[6] or b"") + 500
                    rows.append(row if payloads else (*row[:6], None, row[7]))
                    if held >= BATCH_BYTES:
                        yield frame(rows)
                        rows, held = [], 0
                if rows:
                    yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame(rows, columns=columns)
        return made.astype({"page_id": "Int64", "refers_to": "Int64", "intact": "boolean"})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, RECORDS)


def with_originals(records: DataFrame) -> DataFrame:
    """Read records with ``payload_bytes``, which a revisit takes from the response it refers to.

    A revisit whose response is missing keeps the length that its HTTP header states.
    """
    wanted = records.where(F.col("refers_to").isNotNull()).select(F.col("refers_to").alias("page_id")).distinct()
    responses = records.where(F.col("record_type") == "response").join(wanted, "page_id", "left_semi")
    originals = responses.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(
        F.max("http_length").alias("original_bytes")
    )
    joined = lookup(records, settled(originals, "originals"), ["refers_to", "payload_digest"])
    return joined.withColumn("payload_bytes", F.coalesce("original_bytes", "http_length")).drop("original_bytes")


def round_trip(pages: DataFrame, path: str, least_bytes: int = 0) -> DataFrame:
    """Write the pages as deduplicated archives under ``path`` and give the headers that are read back.

    A missing page counts as empty and a missing address leaves its header line out. Rows that repeat a page are records each. A
    payload is written whole, however long; a reader holds one file. An empty table gives no rows.
    """
    write_archives(resolved(captured(pages), least_bytes), path)
    heads = settled(read_archives(pages.sparkSession, path, payloads=False).drop("payload"), "heads")
    return with_originals(heads)
