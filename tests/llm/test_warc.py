import base64
import gzip
import hashlib
import io

import pytest

from chainloom.llm import scratch
from chainloom.llm.warc import parse, record, records_of_stream, round_trip, write_archives


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_round_trip_equals_brute_force(spark):
    rows = [(k, f"http://h/{k}", ["<p>a</p>", "<p>ü\r\n\r\nWARC/1.1</p>", None, "", "x" * 3_000_000][k % 5], "clash") for k in range(40)]
    rows += [(7, "http://h/7", rows[7][2], "clash"), (None, None, "only here", "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, archive string").repartition(3)
    got = round_trip(pages, payloads=True).collect()
    assert len(got) == len(rows)
    last = {}
    for page, _, html, _ in rows:
        key = (html or "").encode()
        last[key] = max(last.get(key, -1), -1 if page is None else page)
    responses = [r for r in got if r["record_type"] == "response"]
    assert len(responses) == len(last)
    for r in responses:
        assert r["payload_digest"] == sha(bytes(r["payload"])) and r["payload_bytes"] == len(r["payload"])
        assert last[bytes(r["payload"])] == (-1 if r["page_id"] is None else r["page_id"]) and r["refers_to"] is None
    by_digest = {sha(k): (len(k), v) for k, v in last.items()}
    for r in got:
        if r["record_type"] == "revisit":
            assert (r["payload_bytes"], r["refers_to"]) == by_digest[r["payload_digest"]] and len(r["payload"]) == 0


def test_smaller_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in round_trip(pages, least=4).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_empty_table(spark):
    assert round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_stream_of_several_members_and_a_broken_one():
    raw = [record([("A", str(k))], b"z" * k) for k in (0, 5, 70000)]
    data = gzip.compress(raw[0] + raw[1]) + gzip.compress(raw[2])
    assert [parse(r)[1] for r in records_of_stream(io.BytesIO(data), piece=100)] == [b"", b"z" * 5, b"z" * 70000]
    with pytest.raises(ValueError):
        list(records_of_stream(io.BytesIO(gzip.compress(raw[1][:-3]))))


def test_urls_that_look_like_header_lines(spark):
    urls = ["http://h/?q=Content-Length: 7", "http://h/a\r\nContent-Length: 3\r\n\r\nx", "http://h/ tab\tand line", "content-length: 1", ": ", ""]
    pages = spark.createDataFrame([(k, u, f"page {k}") for k, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in round_trip(pages, payloads=True).collect()}
    assert [bytes(got[k]["payload"]) for k in range(len(urls))] == [f"page {k}".encode() for k in range(len(urls))]
    assert got[0]["url"] == "http://h/?q=Content-Length:%207" and got[1]["url"] == "http://h/a%0D%0AContent-Length:%203%0D%0A%0D%0Ax"
    assert got[2]["url"] == "http://h/%20tab%09and%E2%80%A8line" and got[3]["url"] == "content-length:%201"


def test_empty_payloads_fill_archives(spark):
    pages = spark.range(100_000).selectExpr("id as page_id", "cast(null as string) as url", "cast(null as string) as html").coalesce(1)  # about 30 MB of record headers
    found = write_archives(pages, scratch.folder(spark, "test-warc")).groupBy("archive").count().collect()
    assert len(found) >= 2 and max(r["count"] for r in found) < 70_000
    got = round_trip(pages).groupBy("record_type", "refers_to").count().collect()
    assert sorted((r["record_type"], r["refers_to"], r["count"]) for r in got if r["refers_to"]) == [("revisit", 99_999, 99_999)]
    assert sum(r["count"] for r in got) == 100_000
