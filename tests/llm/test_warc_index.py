"""WARC: exact round trip, revisits, and reads of selected records."""

import hashlib

import pytest
from pyspark.sql import functions as F

from immolytics.llm import warc_index as W
from immolytics.llm.queries import QUERIES
from immolytics.session import scratch_path
from tests.conftest import SF


def plain(pages):
    rows, last = [], {}
    for page, html in pages:
        data = (html or "").encode()
        rows.append((page, len(data), hashlib.sha1(data).hexdigest()))
    def order(p):
        return (p is not None, p or 0)
    for page, size, digest in rows:
        if size >= 1000:
            last[digest] = max(last.get(digest, page), page, key=order)
    return sorted(((p, n, d) + (("response", None) if n < 1000 or last[d] == p else ("revisit", last[d]))
                   for p, n, d in rows), key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_query_equals_plain_computation(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert got(QUERIES["op2_warc_index"](spark, SF)) == plain(pages)


@pytest.fixture
def odd(spark):
    big = "é<p>" + "x" * 1200 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n\x00"
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (7, "http://a/3\r\nX: y", big), (7, "http://a/3", big),
            (3, None, None), (4, "http://a/4", ""), (5, "http://ü/ 5", "short"), (6, "http://a/6", "short"),
            (None, "http://a/8", big), (None, "http://a/9", "z" * 5000), (9, "http://a/10", "y" * 300_000)]
    return rows, spark.createDataFrame([(*r, 0, "c") for r in rows], "page_id long, url string, html string, offset int, digest string")


def test_unusual_rows_round_trip(spark, odd):
    rows, df = odd
    assert got(W.round_trip(df)) == plain([(p, h) for p, _, h in rows])
    assert W.round_trip(df.limit(0)).collect() == []


def test_payloads_and_index(spark, odd):
    rows, df = odd
    folder = scratch_path(spark, "warc-test")
    index = W.write_archives(df.repartition(3), folder)
    records = W.read_records(index, folder, gap=10, most=2000).collect()
    assert all(r.intact for r in records) and index.count() == len(rows)
    assert all(hashlib.sha1(r.payload).hexdigest() == r.payload_digest for r in records if r.record_type == "response")
    assert {r.payload for r in records if r.record_type == "revisit"} == {None}
    chosen = W.read_records(index.where(F.col("url") == "http://ü/ 5"), folder).collect()
    assert [(r.page_id, r.url, bytes(r.payload)) for r in chosen] == [(5, "http://ü/ 5", b"short")]


def test_ranges_are_coalesced(spark):
    index = spark.createDataFrame([("a", 0, 10, "", "", ""), ("a", 10, 10, "", "", ""), ("a", 50, 10, "", "", ""),
                                   ("a", 500, 700, "", "", ""), ("b", 20, 5, "", "", ""), ("a", 1200, 5, "", "", "")], W.INDEX)
    ranges = sorted((r.file, r.first, r.last, len(r.offsets)) for r in W.byte_ranges(index, gap=30, most=1000).collect())
    assert ranges == [("a", 0, 60, 3), ("a", 500, 1200, 1), ("a", 1200, 1205, 1), ("b", 20, 25, 1)]


def test_archives_are_standard_gzip_members(spark, odd, tmp_path):
    import gzip
    _, df = odd
    W.write_archives(df.coalesce(1), str(tmp_path))
    data = gzip.open(next(tmp_path.glob("*.warc.gz"))).read()
    seen = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: ")).split(b": ")[1])
        assert head.startswith(b"WARC/1.1\r\n") and rest[size:size + 4] == b"\r\n\r\n"
        data, seen = rest[size + 4:], seen + 1
    assert seen == 11


def test_revisits_name_their_response_in_standard_headers(spark, odd, tmp_path):
    import gzip
    _, df = odd
    W.write_archives(df.repartition(3), str(tmp_path))
    records = {}
    for path in tmp_path.glob("*.warc.gz"):
        data = gzip.open(path).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
            size = int(fields["Content-Length"])
            records[fields["WARC-Record-ID"]] = fields, rest[:size]
            data = rest[size + 4:]
    revisits = [f for f, _ in records.values() if f["WARC-Type"] == "revisit"]
    assert len(records) == 11 and len(revisits) == 3                  # pages 1, 2 and the one without an id
    for fields in revisits:
        target, block = records[fields["WARC-Refers-To"]]
        assert target["WARC-Type"] == "response" and target["WARC-Page-ID"] == fields["WARC-Refers-To-Page-ID"] == "7"
        assert target["WARC-Target-URI"] == fields["WARC-Refers-To-Target-URI"]
        assert target["WARC-Date"] == fields["WARC-Refers-To-Date"]
        assert target["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"]
    for fields, block in records.values():
        assert fields["Content-Type"] == "application/http; msgtype=response"
        http, _, payload = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        assert f"Content-Length: {fields['WARC-Payload-Length']}".encode() in http
        if fields["WARC-Type"] == "response":
            assert "sha1:" + hashlib.sha1(payload).hexdigest() == fields["WARC-Payload-Digest"]
        else:
            assert payload == b""


def test_equal_payloads_without_any_page_id_are_all_responses(spark):
    df = spark.createDataFrame([(None, f"http://a/{i}", "q" * 2000) for i in range(4)], "page_id long, url string, html string")
    assert got(W.round_trip(df)) == plain([(None, "q" * 2000)] * 4)
    assert {r.record_type for r in W.round_trip(df).collect()} == {"response"}
