from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from compare import connect, differences

from scoreloom.llm.queries import ORACLE, QUERIES
from scoreloom.llm.warc import captured, read_archives, resolved, round_trip, write_archives

SCHEMA = "page_id long, url string, html string, payload string, original int"


def pages(spark):
    trap = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n"
    rows = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, "same"), (4, "http://d/\r\nx", None), (5, "http://e/", "")]
    rows += [(6, "http://f/", trap), (7, "http://g/", "ü😀" * 30_000), (8, "http://h/", trap), (8, "http://h/", trap), (None, "http://i/", "same")]
    return spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA).repartition(3)


def test_query(spark, data):
    assert differences(QUERIES["op5_warc_revisits"](spark, data), connect(data), ORACLE["op5_warc_revisits"]) == []


def test_round_trip(spark, tmp_path):
    table = pages(spark)
    for least, same in ((0, {1: 3, 2: 3, 3: None, None: 3, 4: 5, 5: None}), (1, {1: 3, 2: 3, 3: None, None: 3, 4: None, 5: None}), (5, {1: None})):
        got = {r["page_id"]: r for r in round_trip(table, f"{tmp_path}/{least}", least).collect()}
        for page_id, refers_to in same.items():
            assert got[page_id]["refers_to"] == refers_to
            assert got[page_id]["record_type"] == ("revisit" if refers_to else "response")
        for r in table.collect():
            data = (r["html"] or "").encode()
            assert got[r["page_id"]]["payload_bytes"] == len(data)
            assert got[r["page_id"]]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_archives_keep_payloads_and_headers(spark, tmp_path):
    table = pages(spark)
    write_archives(resolved(captured(table)), f"{tmp_path}/a")
    read = read_archives(spark, f"{tmp_path}/a").collect()
    assert len(read) == table.count()
    texts = {r["page_id"]: r["html"] or "" for r in table.collect()}
    for r in read:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        if r["payload"] is not None:
            assert r["payload"].decode() == texts[r["page_id"]] and r["intact"]
    assert {r["page_id"]: r["url"] for r in read}[4] == "http://d/%0D%0Ax"
    assert {r["page_id"]: r["url"] for r in read}[3] is None


def record(kind, page_id, block, more=""):
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {page_id}\r\n{more}Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("how", ["plain", "whole", "each"])
def test_archives_from_elsewhere(spark, tmp_path, how):
    """Records compressed one by one, other record types, payloads that are no text, headers that are missing or in other cases."""
    binary = bytes(range(256)) * 4 + b"\r\n\r\nWARC/1.1"
    http = b"HTTP/1.1 200 OK\r\ncontent-length: 3\r\n\r\n"
    is_http = "content-type: application/http;msgtype=response\r\n"
    sha1 = base64.b32encode(hashlib.sha1(b"abc").digest()).decode()
    records = [
        record("warcinfo", "<urn:uuid:1>", b"software: x\r\n", "Content-Type: application/warc-fields\r\n"),
        record("response", "<urn:page:7>", http + b"abc", f"{is_http}WARC-Payload-Digest: sha1:{sha1}\r\n"),
        record("request", "<urn:uuid:2>", b"GET / HTTP/1.1\r\n\r\n", is_http),
        record("response", "<urn:uuid:3>", b"HTTP/1.1 200 OK\r\n\r\n" + binary, is_http),
        record("response", "<urn:page:9>", binary, "WARC-Payload-Digest: sha256:00\r\n"),
        record("revisit", "<urn:page:8>", http, f"{is_http}WARC-Refers-To: <urn:page:7>\r\nWARC-Payload-Digest: sha1:{sha1}\r\n"),
    ]
    data = {"plain": b"".join(records), "whole": gzip.compress(b"".join(records)), "each": b"".join(map(gzip.compress, records))}[how]
    (tmp_path / "x.warc.gz").write_bytes(data)
    got = [tuple(r) for r in read_archives(spark, str(tmp_path)).select("page_id", "record_type", "refers_to", "http_length", "payload", "intact").collect()]
    assert got == [
        (7, "response", None, 3, bytearray(b"abc"), True),
        (None, "response", None, len(binary), bytearray(binary), None),
        (9, "response", None, len(binary), bytearray(binary), None),
        (8, "revisit", 7, 3, None, None),
    ]


def test_empty(spark, tmp_path):
    assert round_trip(pages(spark).limit(0), f"{tmp_path}/none").count() == 0
