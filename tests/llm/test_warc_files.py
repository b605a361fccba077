"""WARC files: plain, compressed by record, damaged, and as a table of derived records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import time
import zlib

import pytest

from inkwell.llm import warc

PAGES = [(1, "http://a.example/", "<p>one WARC/1.0 line\r\nWARC/1.1\r\n</p>"), (2, None, None), (3, "http://c.example/", "<p>three</p>")]
RECORDS = [warc.response(*p) for p in PAGES]


def ids(records):
    return [r.get("WARC-Record-ID") for r in records]


def test_round_trips():
    plain = b"".join(r.to_bytes() for r in RECORDS)
    packed = b"".join(gzip.compress(r.to_bytes()) for r in RECORDS)
    for data in (plain, packed, gzip.compress(plain), packed + b"\r\nno gzip after this"):
        assert [r.block for r in warc.read_records(data)] == [r.block for r in RECORDS] and ids(warc.read_records(data)) == ids(RECORDS)
    assert list(warc.read_records(b"")) == []


def test_reading_goes_on_after_damage():
    broken = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: many\r\n\r\nxx\r\n\r\n"
    data = RECORDS[0].to_bytes() + broken + b"noise\r\n" + RECORDS[2].to_bytes()
    assert ids(warc.read_records(data)) == ids([RECORDS[0], RECORDS[2]])
    members = [gzip.compress(r.to_bytes()) for r in RECORDS]
    members[1] = members[1][:20] + b"\xff" * 10 + members[1][30:]
    assert ids(warc.read_records(b"".join(members)))[::2][0] == RECORDS[0].get("WARC-Record-ID") and RECORDS[2].get("WARC-Record-ID") in ids(warc.read_records(b"".join(members)))


def test_files_and_pages_agree(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r.to_bytes()) for r in RECORDS[:2]))
    (tmp_path / "b.warc").write_bytes(RECORDS[2].to_bytes())
    (tmp_path / "c.warc").write_bytes(b"")
    made = warc.file_derivatives(spark, str(tmp_path), with_record=True).drop("path").collect()
    pages = spark.createDataFrame([*PAGES, PAGES[2]], "page_id long, url string, html string")
    rows = warc.derivatives(pages, with_record=True).drop("page_id").collect()
    assert sorted(made) == sorted(set(rows)) and len(rows) == len(made) + 2
    assert warc.derivatives(pages.limit(0)).count() == 0


def fetched(head, body, *more):
    block = f"HTTP/1.1 200 OK\r\n{head}\r\n".encode() + body
    return warc.record("response", block, "http://x.example/", "2024-05-05T00:00:00Z", "application/http; msgtype=response", *more)


def converted(source):
    return {r.get("WARC-Type"): r.block.decode() for r in warc.derive(source)}.get("conversion")


def in_chunks(body, size=5):
    parts = [body[k : k + size] for k in range(0, len(body), size)]
    return b"".join(b"%x;x=y\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\nX-Trailer: 1\r\n\r\n"


PAGE = "<p>Le café est là</p>"


@pytest.mark.parametrize(
    ("head", "body"),
    [
        ("Transfer-Encoding: chunked\r\n", in_chunks(PAGE.encode())),
        ("Content-Encoding: gzip\r\n", gzip.compress(PAGE.encode())),
        ("Content-Encoding: deflate\r\n", zlib.compress(PAGE.encode())),
        ("Content-Encoding: deflate\r\n", zlib.compress(PAGE.encode())[2:-4]),
        ("Transfer-Encoding: Chunked\r\nContent-Encoding: x-gzip\r\n", in_chunks(gzip.compress(PAGE.encode()), 7)),
        ("Content-Type: text/html; charset=ISO-8859-1\r\n", PAGE.encode("latin-1")),
        ("Content-Type: text/html\r\n", b'<meta charset="iso-8859-15">' + PAGE.encode("latin-1")),
        ("Content-Type: text/html; charset=nonsense\r\n", PAGE.encode()),
        ("Content-Type: text/html\r\n", PAGE.encode("cp1252")),
        ("Content-Type: text/html; charset=utf-16\r\n", PAGE.encode("utf-16")),
    ],
)
def test_bodies_are_decoded(head, body):
    assert converted(fetched(head, body)) == "Le café est là"


def test_media_types():
    assert converted(fetched("Content-Type: image/png\r\n", b"\x89PNG")) is None and len(warc.derive(fetched("Content-Type: image/png\r\n", b"\x89PNG"))) == 1
    assert converted(fetched("Content-Type: text/plain\r\n", b"a < b\n c")) == "a < b\n c"
    assert converted(fetched("Content-Encoding: br\r\n", b"xyz")) is None and converted(fetched("Content-Encoding: gzip\r\n", b"no gzip")) is None
    assert converted(fetched("Transfer-Encoding: chunked\r\n", b"<p>not in chunks")) == "not in chunks"


def test_metadata_fields_equal_plain_ones():
    source = fetched("Content-Type: text/html\r\nX-A: b:c\r\n", b"<a href=x>y</a><a name=z>", ("WARC-IP-Address", "192.0.2.7"), ("WARC-Warcinfo-ID", "<urn:uuid:1>"), ("WARC-Truncated", "length"), ("WARC-Identified-Payload-Type", "text/html"))
    about = warc.derive(source)[0]
    fields = dict(line.split(": ", 1) for line in about.block.decode().split("\r\n") if line)
    body = source.block.split(b"\r\n\r\n", 1)[1]
    digest = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert fields == {
        "status": "200", "http-content-type": "text/html", "http-x-a": "b:c", "source-warc-ip-address": "192.0.2.7", "source-warc-warcinfo-id": "<urn:uuid:1>", "source-warc-truncated": "length",
        "source-warc-identified-payload-type": "text/html", "source-block-digest": digest(source.block), "source-payload-digest": digest(body), "payload-length": str(len(body)), "outlinks": "1",
    }
    assert (about.get("WARC-Refers-To"), about.get("WARC-Refers-To-Date"), about.get("WARC-Block-Digest")) == (source.get("WARC-Record-ID"), "2024-05-05T00:00:00Z", digest(about.block))


def test_long_files_take_linear_time():
    """Many small members, and one large one: twice the file takes about twice the time."""
    record = warc.response(1, "http://x.example/", "<p>" + "some words " * 300 + "</p>")
    for make in (lambda n: gzip.compress(record.to_bytes(), 1) * n, lambda n: gzip.compress(record.to_bytes() * n, 1), lambda n: record.to_bytes() * n):
        took = []
        for n in (1000, 8000):
            data = make(n)
            began = time.process_time()
            assert sum(1 for _ in warc.read_records(data)) == n
            took.append(time.process_time() - began)
        assert took[1] < 20 * took[0] + 0.5


def test_records_that_damage_or_the_end_cuts():
    whole = [r.to_bytes() for r in RECORDS]
    assert [r.block for r in warc.read_records(b"".join(whole)[:-50])][:2] == [r.block for r in RECORDS[:2]]
    packed = [gzip.compress(w) for w in whole]
    assert ids(warc.read_records(packed[0] + packed[1][:-12])) == ids(RECORDS[:2])  # the checksum is missing, not the record
    assert ids(warc.read_records(packed[0][:40] + packed[1] + packed[2]))[-1:] == ids(RECORDS[2:])
    inside = b"WARC/1.1\r\nWARC-Type: response\r\nWARC/1.1\r\n" + whole[2].split(b"\r\n", 1)[1]
    assert ids(warc.read_records(inside)) == ids(RECORDS[2:])
