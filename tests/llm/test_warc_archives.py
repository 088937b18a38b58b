"""Archives with urls of any form, of others, without an index, without compression, and of several members."""

import base64
import hashlib
import zipfile

import pytest
from pagewright.llm import warc

PAGES = "page_id long, url string, html string"


def test_urls_of_any_form(spark):
    urls = ["https://h/{id}?q={\"a\": 1}", "https://h/a b {", "{", "", None, "https://h/é\n", "x#{y}", "!meta 0 {}"]
    rows = spark.createDataFrame([(i, u, f"body {i}") for i, u in enumerate(urls)], PAGES)
    got = {r.page_id: r.payload_bytes for r in warc.round_trip(rows).collect()}
    assert got == dict.fromkeys(range(len(urls)), 6)


def test_archives_of_several_members(spark, monkeypatch):
    monkeypatch.setattr(warc, "MEMBER", 2000)
    rows = spark.createDataFrame([(i, f"u{i}", f"{i} " * 400) for i in range(200)], PAGES).coalesce(1)
    path = warc.scratch.path(spark, "test-members")
    warc.write(rows, path, archive_bytes=8000)
    files = spark.read.format("binaryFile").load(path).collect()
    for k, file in enumerate(files):
        with zipfile.ZipFile(file.path.removeprefix("file:")) as archive:
            assert archive.testzip() is None
            n = sum(name.endswith(".warc.gz") for name in archive.namelist())
            assert n <= 4 and len(archive.namelist()) == 2 * n
    assert len(files) > 2
    got = warc.read(spark, path, payload=True).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got) == [(i, f"{i} " * 400) for i in range(200)]


def record(kind, extra, block):
    head = [b"WARC/1.0", b"WARC-Type: " + kind, b"Content-Length: %d" % len(block), *extra]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


FOREIGN = [
    record(b"warcinfo", [b"WARC-Record-ID: <urn:uuid:1>"], b"software: x\r\n"),
    record(b"request", [b"WARC-Record-ID: <urn:uuid:2>"], b"GET / HTTP/1.1\r\n\r\n"),
    record(b"response", [b"warc-record-id: <urn:uuid:3>", b"WARC-Target-URI: http://a/"], b"HTTP/1.1 200 OK\r\nX: y\r\n\r\npayload\r\n\r\n!"),
    record(b"resource", [b"WARC-Record-ID: <urn:uuid:4>", b"WARC-Target-URI: dns:a"], b"1.2.3.4"),
    record(b"revisit", [b"WARC-Record-ID: <urn:uuid:5>", b"WARC-Refers-To: <urn:uuid:3>"], b""),
]


@pytest.mark.parametrize("name", ["archive/x.warc", "archive/x.warc.gz", "archive/whole.warc.gz"])
def test_archives_of_others(spark, tmp_path, name):
    """Without an index: record by record, gzipped each, or all in one gzip member."""
    data = b"".join(FOREIGN)
    if name.endswith(".gz"):
        data = warc.gzip.compress(data) if "whole" in name else b"".join(map(warc.gzip.compress, FOREIGN))
    with zipfile.ZipFile(tmp_path / "a.wacz", "w") as archive:
        archive.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
        archive.writestr(name, data)
    (tmp_path / "empty").write_bytes(b"")
    got = [(r.page_id, r.url, r.record_type, None if r.payload is None else bytes(r.payload), r.payload_digest) for r in warc.read(spark, f"file://{tmp_path}", payload=True).collect()]
    sha = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert sorted(got, key=str) == sorted([
        (None, "http://a/", "response", b"payload\r\n\r\n!", sha(b"payload\r\n\r\n!")), (None, "dns:a", "resource", b"1.2.3.4", sha(b"1.2.3.4")), (None, "", "revisit", None, None),
    ], key=str)


def test_a_deflated_member_is_an_error(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.wacz", "w") as archive:
        archive.writestr("archive/x.warc", b"".join(FOREIGN), zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError, match="not stored"):
        list(warc.locate(warc.Ranges(str(tmp_path / "a.wacz"))))
