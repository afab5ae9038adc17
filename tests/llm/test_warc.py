from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os

import pytest

from compare import same
from revmill.llm import queries, warc
from revmill.session import scratch


def sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_both_arc_versions_parse():
    body = b"HTTP/1.1 200 OK\r\nX-Row-Id: 7\r\n\r\nhello\n\nURL like line 0 0\n"
    raw = b""
    for v in (1, 2):
        raw += warc.arc_version_block(v, f"old{v}.arc", "19990102030405") + b"\n"
        raw += warc.arc_record(v, "http://a.b/c d", "1.2.3.4", "19990102030405", "text/html", body) + b"\n\n"
        raw += warc.arc_record(v, "dns:a.b", "1.2.3.4", "199901", "text/dns", b"") + b"\n"
    got = list(warc.parse_arc(io.BytesIO(raw)))
    assert [d["version"] for d in got] == [1, 1, 1, 2, 2, 2] and [d["about"] for d in got] == [True, False, False] * 2
    assert got[1]["body"] == got[4]["body"] == body and got[1]["URL"] == "http://a.b/c%20d"
    assert got[4]["Result-code"] == "200" and got[4]["Checksum"] == sha1(body)
    rows = [warc.converted(d) for d in got]
    assert [r["type"] for r in rows] == ["warcinfo", "response", "resource"] * 2
    assert rows[1]["date"] == "1999-01-02T03:04:05Z" and rows[2]["date"] == "1999-01-00T00:00:00Z"
    assert rows[1]["payload"] == b"hello\n\nURL like line 0 0\n" and rows[1]["row_id"] == "7"
    assert rows[1]["payload_digest"] == sha1(rows[1]["payload"]) and len({r["record_id"] for r in rows}) == 6


def test_broken_archives_raise():
    block = warc.arc_version_block(1, "a.arc", "19990102030405") + b"\n"
    with pytest.raises(ValueError, match="version block"):
        list(warc.parse_arc(io.BytesIO(b"http://a 1.1.1.1 1999 text/html 3\nabc\n")))
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.parse_arc(io.BytesIO(block + b"http://a 1.1.1.1 1999 text/html 30\nabc\n")))
    with pytest.raises(ValueError, match="fields"):
        list(warc.parse_arc(io.BytesIO(block + b"http://a 30\nabc\n")))
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.parse_warc(io.BytesIO(b"nonsense\r\n")))


PAGES = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (3, None, "<p>one</p>"),
    (4, "http://a/4 x\ny", None),
    (5, "http://a/5", ""),
    (10, "http://a/6", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
    (9, "http://a/7", "ünï 漢字 \x00"),
    (9, "http://a/7", "ünï 漢字 \x00"),
    (None, "http://a/8", "<p>one</p>"),
    (11, "http://a/9", "y" * 3_000_000),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id bigint, url string, html string, type int, record_id string").repartition(3)


def test_pages_through_the_archives(spark):
    got = warc.archive_pages(pages(spark)).collect()
    rows = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr)
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        want.append((i, len(data), sha1(data), *{1: ("revisit", 3), 2: ("revisit", 3), 4: ("revisit", 5), None: ("revisit", 3)}.get(i, ("response", None))))
    nine = [k for k, w in enumerate(want) if w[0] == 9]
    want[nine[1]] = (*want[nine[1]][:3], "revisit", 9)
    assert rows == sorted(want, key=repr)
    assert warc.archive_pages(pages(spark, [])).collect() == []


def test_small_payloads_can_stay_responses(spark):
    rows = warc.archive_pages(pages(spark), least_bytes=11).collect()
    assert sorted(r.page_id for r in rows if r.record_type == "revisit") == [9]


def test_files_are_whole_gzip_archives(spark):
    path = scratch(spark, "arc")
    warc.write_arc(pages(spark), path)
    names = [n for n in os.listdir(path) if n.endswith(".gz")]
    assert names
    found = []
    for n in names:
        with gzip.open(os.path.join(path, n)) as f:
            found += [d for d in warc.parse_arc(f) if not d["about"]]
    assert len(found) == len(PAGES)
    out = scratch(spark, "warc")
    plain = warc.convert_arc(spark, path, with_payload=False)
    warc.write_warc(warc.convert_arc(spark, path), warc.revisits(plain), out)
    read = warc.read_warc(spark, out, with_payload=True).collect()
    kept = sorted(bytes(r.payload) for r in read if r.type == "response")
    assert kept == sorted({(h or "").encode() for _, _, h in PAGES})


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_against_sql(spark, sf_dir, name):
    assert same(queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name], sf_dir) is None
