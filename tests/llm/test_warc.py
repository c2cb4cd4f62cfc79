"""Archives: round trip against a plain version, format, edge rows."""

import gzip
from base64 import b32encode
from collections import defaultdict
from hashlib import sha1

from tests.compare import assert_same, connect
from tests.conftest import SF_DIR
from tillmart.llm import queries, warc
from tillmart.llm.common import read_table
from tillmart.session import shared_dir

PAGE = "page_id long, url string, html string, payload string"


def plain(pages, least=0):
    groups = defaultdict(list)
    for page_id, html in pages:
        groups[(html or "").encode()].append(page_id)
    rows = []
    for payload, ids in groups.items():
        known = [i for i in ids if i is not None]
        top = max(known) if len(ids) > 1 and known and len(payload) >= least else None
        for i in ids:
            refers = None if top is None or i == top else top
            rows.append((i, len(payload), b32encode(sha1(payload).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(rows, key=str)


def back(spark, pages, **options):
    path = shared_dir(spark, "test_archives")
    warc.write_archives(pages, path, date="2020-01-02T03:04:05Z", **options)
    rows = warc.read_archives(spark, path).collect()
    assert all(r["intact"] for r in rows)
    return path, rows


def as_tuples(rows):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)


def test_query_against_plain_version(spark):
    pages = [(r["page_id"], r["html"]) for r in read_table(spark, SF_DIR, "pages").collect()]
    assert as_tuples(queries.op3_warc(spark, SF_DIR).collect()) == plain(pages)


def test_edge_rows(spark):
    tricky = "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n\r\n\r\n"
    rows = [
        (1, "http://a", tricky, "x"),
        (2, None, tricky, "x"),
        (3, "http://a\r\nX-Evil: 1", "é" * 10, None),
        (4, "", None, "x"),
        (5, "u", "", "x"),
        (5, "u", "", "x"),
        (None, "n", "é" * 10, "x"),
        (7, "long", "ab\n" * 400_000, "x"),
    ]
    pages = spark.createDataFrame(rows, PAGE)
    path, got = back(spark, pages)
    assert as_tuples(got) == plain([(r[0], r[2]) for r in rows])
    urls = {r["page_id"]: r["url"] for r in got}
    assert urls[2] is None and urls[3] == "http://a%0D%0AX-Evil: 1"
    assert as_tuples(back(spark, pages, least_bytes=30)[1]) == plain([(r[0], r[2]) for r in rows], 30)


def test_format(spark):
    pages = spark.createDataFrame([(1, "http://a", "hi", ""), (2, "http://b", "hi", "")], PAGE)
    path, _ = back(spark, pages.coalesce(1))
    (file,) = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    text = gzip.decompress(file["content"]).decode()
    first = text.split("WARC/1.1\r\n")[1]
    assert first.startswith("WARC-Type: revisit\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: 2020-01-02T03:04:05Z\r\n")
    for line in (f"WARC-Profile: {warc.PROFILE}", "WARC-Refers-To: <urn:page:2>", "WARC-Refers-To-Target-URI: http://b"):
        assert f"\r\n{line}\r\n" in first
    assert text.endswith("\r\n\r\nhi\r\n\r\n")


def test_empty_table(spark):
    assert back(spark, spark.createDataFrame([], PAGE))[1] == []


def test_archives_are_cut(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3_000)
    pages = spark.createDataFrame([(i, "u", f"page {i}", "") for i in range(20)], PAGE).coalesce(1)
    path, rows = back(spark, pages)
    assert len(rows) == 20
    assert spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).count() == 7


def test_query_against_sql(spark):
    assert assert_same(queries.op3_warc(spark, SF_DIR), connect(SF_DIR).sql(queries.OP3_SQL)) > 0
