"""Archives: round trips, pushed filters, skipped payloads, commits."""

import gzip
import hashlib

import pytest

from candlewick.llm import warc
from candlewick.llm.common import Scratch


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "archives")


LONG = "<p>é</p>" * 50
PAGES = [(5, "http://a/\r\nx y", LONG, 1), (2, "http://b/", LONG, 1), (9, None, LONG, 1), (None, "http://c/", LONG, 1), (1, "http://d/", None, 1), (3, "http://e/", "short", 1), (4, "http://f/", "short", 1), (2, "http://b/", LONG, 1), (6, "http://g/", "z" * 300_000 + "\r\n\r\nWARC/1.1\r\n", 1)]


def test_round_trip_of_odd_pages(spark, folder):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, payload int").repartition(3)
    warc.write(warc.page_records(pages, Scratch(spark, "w")), folder)
    got = warc.read(spark, folder).collect()
    assert len(got) == len(PAGES)
    by = {r.record_id: r for r in got}
    assert {r.record_id for r in got if r.record_type == "revisit"} == {"<urn:page:5>", "<urn:page:9>"}
    assert by["<urn:page:5>"].refers_to == "<urn:page:2>" and by["<urn:page:5>"].payload is None
    assert by["<urn:page:5>"].payload_length == len(LONG.encode()) and by["<urn:page:5>"].target_uri == "http://a/%0D%0Ax%20y"
    assert by["<urn:page:9>"].target_uri is None and by["<urn:page:1>"].payload == b""
    assert by["<urn:page:6>"].payload == PAGES[-1][2].encode()
    assert all(r.payload_digest == "sha256:" + hashlib.sha256(r.payload).hexdigest() for r in got if r.payload is not None)
    assert warc.read(spark, folder, payload=False).columns == [*warc.COLUMNS, "payload_length"]


def test_filters_are_pushed_and_payloads_skipped(spark, folder, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h{i}/", f"{i}" * 200_000) for i in range(6)], "page_id long, url string, html string").coalesce(1)
    warc.write(warc.page_records(pages, Scratch(spark, "w")), folder)
    one = warc.read(spark, folder).where("target_uri = 'http://h3/' AND record_type IN ('response', 'x')")
    assert [r.payload[:1] for r in one.collect()] == [b"3"]
    reader = warc.WarcReader(folder, True)
    path = reader.partitions()[0].value[0]
    inflated = []
    seen = warc._Gzip.more
    warc._Gzip.more = lambda self, limit: inflated.append(limit) or seen(self, limit)
    try:
        assert len(list(warc.read_records(path, [("in", "target_uri", {"http://h3/"})], False))) == 1
    finally:
        warc._Gzip.more = seen
    assert sum(inflated) < 40_000


def test_foreign_archives(spark, tmp_path):
    body = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    other = b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Target-URI: http://x/\r\nContent-Type: text/plain\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(body + other)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(other) + gzip.compress(body))
    got = warc.read(spark, str(tmp_path)).collect()
    assert sorted((r.record_type, r.payload) for r in got) == [("resource", b"abc")] * 2 + [("warcinfo", b"hello")] * 2
    assert warc.read(spark, str(tmp_path)).where("record_type = 'resource'").count() == 2


def test_only_committed_files_count(spark, folder, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a" * 200)], "page_id long, url string, html string")
    warc.write(warc.page_records(pages, Scratch(spark, "w")), folder)
    (tmp_path / "archives" / "part-left-behind.warc.gz").write_bytes(b"\x1f\x8b\x08 broken")
    assert warc.read(spark, folder).count() == 1
    warc.write(warc.page_records(pages.limit(0), Scratch(spark, "w")), folder)
    assert warc.read(spark, folder).count() == 1


def test_no_pages(spark, folder):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(warc.page_records(pages, Scratch(spark, "w")), folder)
    assert warc.read(spark, folder).count() == 0
