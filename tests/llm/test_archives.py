"""Legacy archives as crawlers wrote them: DNS answers, odd headers, malformed records, names of records."""

from __future__ import annotations

import gzip
import hashlib

import pytest

from lumenframe.llm import common, warc

INFO = b"1 0 SomeCrawler\nURL IP-address Archive-date Content-type Archive-length\n"
BODY = b"<p>" + b"legacy " * 40 + b"</p>"


def record(url, kind, content, date="20010203040506", ip="192.0.2.7"):
    return f"{url} {ip} {date} {kind} {len(content)}\n".encode() + content + b"\n"


def archive(*records):
    return f"filedesc://IA-0001.arc 0.0.0.0 20010203040000 text/plain {len(INFO)}\n".encode() + INFO + b"\n" + b"".join(records)


@pytest.fixture
def folder(tmp_path):
    def put(**files):
        (tmp_path / "arc").mkdir()
        for name, data in files.items():
            (tmp_path / "arc" / f"{name}.arc").write_bytes(data)
        return f"file://{tmp_path}/arc"

    return put


def read(spark, arc, **options):
    return warc.read_warc(spark, warc.convert(spark, arc, common.shared_dir(spark, "warc"), **options), info=True).collect()


@pytest.mark.parametrize("packed", [False, True])
def test_types_of_records(spark, folder, packed):
    dns = b"20010203040506\nexample.org.\t3600\tIN\tA\t192.0.2.7\n"
    records = [
        record("dns:example.org", "text/dns", dns),
        record("http://example.org/crlf", "text/html", b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\nContent-Length: 999\r\n\r\n" + BODY),
        record("http://example.org/lf", "text/html", b"HTTP/1.0 200 OK\nServer: x\n\n" + BODY),
        record("http://example.org/none", "text/html", b"HTTP/1.0 304 Not Modified\r\n"),
        record("http://example.org/bare file", "text/plain", b"no headers here"),
        record("http://example.org/empty", "no-type", b""),
    ]
    data = archive(*records)
    got = read(spark, folder(a=gzip.compress(data[:200]) + gzip.compress(data[200:]) if packed else data))
    by = {r["target_uri"]: r for r in got}
    assert [r["record_type"] for r in got].count("warcinfo") == 1 and len(got) == 7 and len({r["record_id"] for r in got}) == 7
    kinds = {u.rsplit("/", 1)[-1]: (by[u]["record_type"], by[u]["payload_bytes"], by[u]["content_type"].split(";")[0]) for u in by if u}
    assert kinds == {"dns:example.org": ("resource", len(dns), "text/dns"), "crlf": ("response", len(BODY), "application/http"), "lf": ("response", len(BODY), "application/http"), "none": ("response", 0, "application/http"), "bare%20file": ("resource", 15, "text/plain"), "empty": ("resource", 0, "application/octet-stream")}
    assert by["http://example.org/lf"]["payload_digest"] == hashlib.sha256(BODY).hexdigest() and by["dns:example.org"]["payload_digest"] == hashlib.sha256(dns).hexdigest()
    assert {r["warc_date"] for r in got} == {"2001-02-03T04:05:06Z", "2001-02-03T04:00:00Z"} and {r["page_id"] for r in got} == {None}


def test_malformed_records(spark, folder):
    good = record("http://a/", "text/html", b"HTTP/1.0 200 OK\n\nx")
    fields = f"http://b/ text/html {len(BODY)}\n".encode() + BODY + b"\n"
    cut = record("http://c/", "text/html", BODY)[:-50]
    arc = folder(fields=archive(good, fields, good), length=archive(good, b"http://d/ 0.0.0.0 20010203 text/html many\n" + BODY + b"\n", good), cut=archive(good, cut), zipped=gzip.compress(archive(good, good))[:-20])
    with pytest.raises(Exception, match="at byte"):
        read(spark, arc)
    got = [r for r in read(spark, arc, malformed="skip") if r["record_type"] != "warcinfo"]
    assert sorted(r["target_uri"] for r in got)[:4] == ["http://a/"] * 4 and {r["target_uri"] for r in got} == {"http://a/"} and len({r["record_id"] for r in got}) == len(got)
    faults = sorted((r["path"].rsplit("/", 1)[1], r["reason"].split(":")[0][:30]) for r in warc.arc_faults(spark, arc).collect())
    assert [f[0] for f in faults] == ["cut.arc", "fields.arc", "length.arc", "zipped.arc"] and faults[1][1].startswith("a header line without the fiel") and faults[2][1].startswith("a header line without a length")
    with pytest.raises(ValueError, match="raised or skipped"):
        warc.convert(spark, arc, "x", malformed="drop")


def test_record_names_and_revisits_of_repeated_pages(spark):
    """Repeated rows have records of their own names; a revisit names the record and the page that it refers to."""
    rows = [(3, "u", "x" * 200), (3, "u", "x" * 200), (5, "v", "x" * 200), (None, "w", "x" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = warc.convert(spark, warc.write_arc(pages, common.shared_dir(spark, "arc")), common.shared_dir(spark, "warc"))
    got = warc.read_warc(spark, path).collect()
    assert len({r["record_id"] for r in got}) == 4 and sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in got) == [(0, "revisit", 3), (3, "response", None), (3, "response", None), (5, "revisit", 3)]
    heads = [head for file in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect() for head, _ in warc.parse_warc(bytes(file["content"]))]
    named = {h["WARC-Record-ID"]: h for h in heads}
    assert all(named[h["WARC-Refers-To"]]["WARC-Type"] == "response" for h in heads if h["WARC-Type"] == "revisit") and sum(h["WARC-Type"] == "warcinfo" for h in heads) >= 1


def test_version_two_and_joined_archives():
    """Fields of version 2, a version block in the middle, blanks and odd bytes in a URL, short dates."""
    two = warc.version_block(2, "two.arc", "2002") + b"\n" + "http://é/a b 192.0.2.1 200201 text/html 200 - - 120 two.arc 3\nabc\n".encode()
    got = [(r["URL"], r["Archive-date"], bytes(r["content"])[:3]) for r in warc.parse_arc(archive(record("http://x/", "text/html", b"one")) + b"\n" + two)]
    assert got[1:] == [("http://x/", "20010203040506", b"one"), ("filedesc://two.arc", "2002", b"2 0"), ("http://%C3%A9/a%20b", "200201", b"abc")]
    assert warc.warc_date("200201") == "2002-01-01T00:00:00Z" and warc.warc_date("2002") == "2002-01-01T00:00:00Z"
