"""Operator 10: round trip, planted copies, foreign archives."""

import gzip
import hashlib
import base64
import io

from saltkv.llm.warc import (
    assemble_captures, capture_payloads, op10_warc_captures, parse_records, read_warc, record_row, write_warc,
)
from saltkv.session import scratch_path

SCHEMA = "page_id long, url string, html string"


def digest(s):
    return base64.b32encode(hashlib.sha1((s or "").encode()).digest()).decode()


def test_round_trip_with_edge_rows(spark):
    rows = [
        (1, "http://a.example/x?q=1", "<p>same</p>"), (5, "http://b.example/", "<p>same</p>"), (3, None, "<p>same</p>"),
        (7, "http://c.example/", None), (8, "http://d.example/", ""), (9, "no scheme", "é漢😀\r\n\r\nWARC/1.1\r\n"),
        (10, "http://e.example/a b\r\nX: y", "z" * 300_000), (11, "http://[bad", "one"), (-2, "", "one"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rid", "'x' as sha1", "2 as salt")
    got = {r.page_id: r for r in op10_warc_captures(spark, df).collect()}
    top = {}
    for k, _, h in rows:
        top[h or ""] = max(top.get(h or "", k), k)
    assert len(got) == len(rows)
    for k, _, h in rows:
        first = top[h or ""]
        assert (got[k].payload_bytes, got[k].payload_digest) == (len((h or "").encode()), digest(h)), k
        assert (got[k].record_type, got[k].refers_to) == (("response", None) if first == k else ("revisit", first)), k
    assert got[10].target_uri == "http://e.example/a b X: y"


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "u", "a"), (1, "u", "a"), (1, "v", "a"), (None, "w", "a"), (2, "u", "b"), (2, "u", "c")]
    got = [(r.page_id, r.record_type, r.refers_to) for r in op10_warc_captures(spark, spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "response", None), (1, "revisit", 1), (1, "revisit", 1), (None, "revisit", 1), (2, "response", None), (2, "response", None)], key=str
    )


def test_repeated_rows_equal_the_oracle(spark, tmp, monkeypatch):
    from oracle import compare, duck
    from saltkv.llm import warc
    from saltkv.llm.queries import ORACLE, QUERIES

    monkeypatch.setattr(warc, "RUN", 7)  # runs of a row repeated often
    rows = [(4, "u", "a")] * 40 + [(4, "v", "a")] * 3 + [(3, "u", "a")] * 30 + [(None, "n", "a"), (None, "n", None), (9, None, None)]
    rows += [(7, "w", "b")] * 8 + [(i, f"h{i}", f"{i}") for i in range(20, 30)] + [(None, "o", "c")] * 2
    d = tmp("repeats")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{d}/pages.parquet")
    con = duck(d)
    con.execute(f"create or replace view pages as select * from '{d}/pages.parquet/*.parquet'")
    got, want = compare(QUERIES["op10_warc_captures"](spark, d), con, ORACLE["op10_warc_captures"])
    assert got == want
    assert QUERIES["op10_warc_captures"](spark, d).count() == len(rows)


def test_payloads_come_back_and_files_roll(spark):
    rows = [(i, f"http://h/{i}", f"body {i % 5} é") for i in range(40)]
    out = scratch_path(spark, "warc")
    files = write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(1), out, roll_bytes=2000)
    assert files.count() > 3 and sum(r.records for r in files.collect()) == 120
    records = read_warc(files, out)
    got = capture_payloads(assemble_captures(records), records).collect()
    assert {(r.request.target_uri, bytes(r.payload).decode()) for r in got} == {(u, h) for _, u, h in rows}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert op10_warc_captures(spark, df).count() == 0


def test_a_foreign_archive(spark, tmp):
    def rec(kind, rid, extra, block):
        h = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{rid}>\r\n{extra}Content-Length: {len(block)}\r\n\r\n"
        return h.encode() + block + b"\r\n\r\n"

    http = "Content-Type: application/http; msgtype=response\r\n"
    raw = b"".join([
        rec("warcinfo", "urn:i", "", b"software: x"),
        rec("request", "urn:q", "WARC-Concurrent-To: <urn:r>\r\nContent-Type: application/http\r\n", b"GET / HTTP/1.1\r\n\r\n"),
        rec("response", "urn:r", "WARC-Target-URI: http://x/\r\n" + http, b"HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"),
        rec("metadata", "urn:m1", "WARC-Concurrent-To: <urn:q>\r\n", b"a: 1"),
        rec("metadata", "urn:m2", "WARC-Concurrent-To: <urn:r>\r\n", b"a: 2"),
        rec("metadata", "urn:m3", "WARC-Concurrent-To: <urn:gone>\r\n", b""),
        rec("resource", "urn:f", "", b"raw"),
    ])
    assert len(list(parse_records(io.BytesIO(raw)))) == 7
    import os

    d = tmp("foreign")
    os.makedirs(d)
    for name, data in (("a.warc", raw), ("b.warc.gz", gzip.compress(raw.replace(b"urn:", b"urn:b")))):
        with open(f"{d}/{name}", "wb") as f:
            f.write(data)
    got = assemble_captures(read_warc(spark.createDataFrame([("a.warc",), ("b.warc.gz",)], "path string"), d)).collect()
    whole = {r.capture_id: r for r in got if r.record_type}
    assert set(whole) == {"urn:r", "urn:br"}
    r = whole["urn:r"]
    assert (r.main.payload_bytes, r.request.record_id, r.metadata.record_id, r.n_metadata) == (8, "urn:q", "urn:m2", 2)
    assert [x.capture_id for x in got if not x.record_type] and record_row({"warc-type": "resource"}, b"x", True)["payload"] is None


def test_the_pages_table_equals_its_oracle(spark):
    from conftest import SF_SMALL
    from oracle import compare, duck
    from saltkv.llm.queries import ORACLE, QUERIES

    got, want = compare(QUERIES["op10_warc_captures"](spark, SF_SMALL), duck(SF_SMALL), ORACLE["op10_warc_captures"])
    assert got == want
