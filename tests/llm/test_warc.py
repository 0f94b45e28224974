from __future__ import annotations

import base64
import hashlib

from corpuslab.llm import warc
from corpuslab.llm.warc import archived_pages, deduplicate_archives, read_archives, read_records, write_pages, write_record
from corpuslab.session import scratch_path

SCHEMA = "page_id long, url string, html string, kind string, urn int"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], SCHEMA)


ROWS = [
    (1, "http://a/1", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://a/ü\r\nEvil: x", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (4, "", None), (5, "http://a/5", ""), (6, "http://a/6", "é漢\x00\r\n"), (7, "http://a/7", "x" * 3_000_000), (8, "u", "x" * 3_000_000),
    (9, "u", "dup"), (9, "u", "dup"), (None, "u", "null id"), (None, "u", "<p>one</p>"), (-5, "u", "negative"),
]


def brute(rows, min_bytes=0):
    out, first = [], {}
    for page, _, html in rows:
        if page is not None:
            key = html or ""
            first[key] = min(page, first.get(key, page))
    used = set()
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = data in used and len(data) >= min_bytes
        used.add(data)
        out.append((page, len(data), digest, "revisit" if again else "response", first.get(html or "") if again else None))
    return sorted(out, key=str)


def facts(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    assert facts(archived_pages(frame(spark, ROWS))) == brute(ROWS)


def test_small_payloads_stay_responses(spark):
    assert facts(archived_pages(frame(spark, ROWS), min_bytes=5)) == brute(ROWS, 5)


def test_payloads_survive_the_round_trip(spark, monkeypatch):
    source, target = scratch_path(spark, "warc-test"), scratch_path(spark, "warc-test")
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(k, f"http://a/{k}", f"<p>{k % 60}</p>" * 20) for k in range(200)]
    write_pages(frame(spark, rows), source)
    deduplicate_archives(spark, source, target)
    back = {r.page_id: r for r in read_archives(spark, target, payloads=True).collect()}
    for k, url, html in rows:
        assert back[k].url == url and bytes(back[k].payload) == (html.encode() if k < 60 else b"")
    assert spark.read.format("binaryFile").load(target).count() > 10


def test_decisions_meet_the_archives_without_broadcast(spark):
    rows = [(k, f"http://a/{k}", f"<p>{k % 7}</p>") for k in range(60)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert facts(archived_pages(frame(spark, rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_decisions_name_the_smallest_page(spark):
    source = scratch_path(spark, "warc-test")
    write_pages(frame(spark, [(3, "u", "a"), (2, "u", "a"), (1, "u", "b"), (4, "u", "")]), source)
    headers = read_archives(spark, source)
    at = {(r.file, r.number): r.page_id for r in headers.collect()}
    found = {at[r.file, r.number]: warc.page_of(r.original) for r in warc.resolve_revisits(headers).collect()}
    assert found == {3: 2}


def test_records_are_well_formed():
    record = write_record("response", "<urn:page:1:0>", "http://a", b"body\r\n\r\n")
    second = write_record("revisit", "<urn:page:2:0>", "http://a", b"", "<urn:page:1:0>", 8, "D")
    (one, payload), (two, nothing) = read_records(record + second)
    assert payload == b"body\r\n\r\n" and nothing == b""
    assert one["warc-type"] == "response" and two["warc-refers-to"] == "<urn:page:1:0>" and two["warc-profile"] == warc.PROFILE
    assert one["http-length"] == two["http-length"] == "8"
    assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")


def test_empty_table(spark):
    assert archived_pages(frame(spark, [])).collect() == []
