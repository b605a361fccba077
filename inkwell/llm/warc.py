"""WARC derivatives: metadata and plain-text conversion records of responses.

``responses`` wraps pages as WARC/1.1 response records, ``read_records`` reads
records from bytes (plain, or compressed record by record), and ``derive``
makes two records of each response: a metadata record (``warc-fields``: the
source's HTTP and WARC headers, digests, length, links) and a conversion record
(its visible text, after chunks, content codings and the character set are
undone; other media than text have none). Both refer to the response by record id, target and date, and
carry digests of their own, so a derivative can be traced and checked without
the response at hand. Record ids are name-based, so reruns and recomputed
tasks write the same records.

``derivatives`` makes both records for a table of pages (which has no dates:
``DATE`` is its parameter's default), ``file_derivatives`` for the responses of
WARC files that Spark can reach, each of which must fit a task's memory. Rows
are handled one by one, straight after the scan, without a shuffle.

Defined results: a null page is a response with an empty body; a null url is
the target ``urn:page:<id>``; repeated rows give equal records with equal ids;
records of other types, and responses whose HTTP head doesn't end, are passed
over by ``derive``; a payload with an unknown content coding has no conversion
record; reading goes on at the next version line after a broken head, and at
what follows a damaged gzip member; an empty table gives no row;
extra columns are not carried on.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import common
from inkwell.llm.html_text import tags, visible_text

DATE = "2024-01-01T00:00:00Z"
#: Records of a file whose derivatives are handed on at a time.
RECORDS = 64
COLUMNS = "record_type string, record_id string, refers_to string, target_uri string, refers_to_date string, content_type string, source_digest string, payload_digest string, block_digest string, content_length long, content string, record binary"


class Record(NamedTuple):
    headers: list[tuple[str, str]]
    block: bytes

    def get(self, name: str) -> str | None:
        return next((v for k, v in self.headers if k.lower() == name.lower()), None)

    def to_bytes(self) -> bytes:
        head = "".join(f"{k}: {v}\r\n" for k, v in self.headers)
        return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + self.block + b"\r\n\r\n"


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, block: bytes, target: str, date: str, content_type: str, *more: tuple[str, str], name: str = "") -> Record:
    """A record whose id is made from its kind, target, date, name and block."""
    digest = sha1(block)
    own = uuid.uuid5(uuid.NAMESPACE_URL, "\n".join((kind, target, date, name, digest)))
    return Record([("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{own}>"), ("WARC-Target-URI", target), ("WARC-Date", date), *more, ("WARC-Block-Digest", digest), ("Content-Type", content_type), ("Content-Length", str(len(block)))], block)


def response(page_id: object, url: str | None, html: str | None, date: str = DATE) -> Record:
    body = (html or "").encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    target = " ".join((url or f"urn:page:{page_id}").split())
    return record("response", head + body, target, date, "application/http; msgtype=response", ("WARC-Payload-Digest", sha1(body)), name=str(page_id))


MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.\d+\r?\n?\Z")
#: Bytes that are decompressed at a time.
FEED = 1 << 20
#: Between two chunks: what damage has cut off doesn't go on with what follows.
BREAK = None


def chunks(data: bytes) -> Iterator[bytes | None]:
    """The bytes of a file in pieces, whose records may each be a gzip member; ``BREAK`` where a member is damaged."""
    view, at, size = memoryview(data), 0, len(data)
    packed = data.startswith(MAGIC)
    while at < size:
        if not packed or not data.startswith(MAGIC, at):
            # Plain bytes; in a compressed file members among them are looked for.
            end = data.find(MAGIC, at) if packed else -1
            end = size if end < 0 else end
            for k in range(at, end, FEED):
                yield bytes(view[k : min(end, k + FEED)])
            at = end
            continue
        member, fed = zlib.decompressobj(31), at
        try:
            while fed < size and not member.eof:
                piece = view[fed : fed + FEED]
                yield member.decompress(piece)
                fed += len(piece)
            yield member.flush()
            at = fed - len(member.unused_data)
        except zlib.error:
            yield BREAK
            at = data.find(MAGIC, at + 1)
            at = size if at < 0 else at


class Stretch:
    """Chunks read forwards by lines and sizes, up to the next break."""

    def __init__(self, source: Iterator[bytes | None]):
        self.source, self.held, self.at = source, b"", 0
        self.ended = False  # with the file, not with a break
        self.broken = False

    def grow(self) -> bool:
        """The next chunk, when all that was held is read."""
        while not (self.ended or self.broken):
            chunk = next(self.source, self)
            if chunk is self:
                self.ended = True
            elif chunk is BREAK:
                self.broken = True
            elif chunk:
                self.held, self.at = chunk, 0
                return True
        return False

    def line(self) -> bytes:
        """Up to the next line end, included; empty at the end."""
        parts = []
        while self.at < len(self.held) or self.grow():
            end = self.held.find(b"\n", self.at) + 1
            parts.append(self.held[self.at : end or len(self.held)])
            self.at = end or len(self.held)
            if end:
                break
        return b"".join(parts)

    def take(self, size: int) -> bytes:
        """The next ``size`` bytes, or fewer at the end."""
        parts, left = [], size
        while left and (self.at < len(self.held) or self.grow()):
            parts.append(self.held[self.at : self.at + left])
            self.at += len(parts[-1])
            left -= len(parts[-1])
        return b"".join(parts)


def read_records(data: bytes) -> Iterator[Record]:
    """Records in order, in time linear in the file, and with one record in memory at a time.

    After a broken record head reading goes on with the next version line. A
    record that damage cuts is passed over, one that the file's end cuts has
    what there is.
    """
    source = chunks(data)
    stretch = Stretch(source)
    line = stretch.line()
    while True:
        while line and not VERSION.match(line):
            line = stretch.line()
        if not line:
            if stretch.ended:
                return
            stretch = Stretch(source)
            line = stretch.line()
            continue
        headers: list[tuple[str, str]] = []
        while (line := stretch.line()).strip() and not VERSION.match(line):
            if line[:1] in b" \t" and headers:
                headers[-1] = (headers[-1][0], headers[-1][1] + " " + line.decode(errors="replace").strip())
            else:
                k, _, v = line.decode(errors="replace").partition(":")
                headers.append((k.strip(), v.strip()))
        size = next((v for k, v in headers if k.lower() == "content-length"), "")
        if line.strip() or not (size.isascii() and size.isdigit()):
            continue  # another record begins within the head, or its size isn't known
        block = stretch.take(int(size))
        if len(block) == int(size) or stretch.ended:
            yield Record(headers, block)
        line = stretch.line()


def dechunked(body: bytes) -> bytes:
    """The payload of a body that was transferred in chunks; one that isn't stays as it is from there on."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]{1,15}", size):
            return b"".join(parts) + body[at:]
        n = int(size, 16)
        if not n:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + n])
        at = end + 2 + n + 2
        if at >= len(body):
            return b"".join(parts)


def decompressed(body: bytes, codings: str) -> bytes | None:
    """The payload without its content codings, last one first; none for codings that are not known, or damaged from the start."""
    for coding in reversed([c.strip().lower() for c in codings.split(",") if c.strip()]):
        if coding in ("gzip", "x-gzip", "deflate"):
            out = b""
            for bits in (47, -15):  # with a head of either kind, or without any
                try:
                    d = zlib.decompressobj(bits)
                    out = d.decompress(body) + d.flush()
                    break
                except zlib.error:
                    continue
            else:
                return None
            body = out
        elif coding != "identity":
            return None
    return body


META = re.compile(rb"<meta[^>]{0,200}?charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.IGNORECASE)
MARKUP, TEXT = re.compile(r"(text/html|application/xhtml\+xml|(text|application)/xml|application/(rss|atom)\+xml)\Z"), re.compile(r"(text/.*|application/(json|ld\+json|javascript))\Z")


def text_of(payload: bytes, content_type: str) -> str:
    """The payload by its declared character set, else by its own, else as UTF-8, else as Windows-1252."""
    declared = re.search(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", content_type, re.IGNORECASE)
    meta = META.search(payload, 0, 4096)
    for name in (declared[1] if declared else None, meta[1].decode() if meta else None, "utf-8-sig"):
        try:
            if name:
                return payload.decode(codecs.lookup(name).name)
        except (LookupError, UnicodeError):
            continue
    return payload.decode("utf-8" if declared and "utf" in declared[1].lower() else "cp1252", errors="replace")


#: Headers of a source that its derivatives have in another form.
CARRIED = frozenset("warc-type warc-record-id warc-target-uri warc-date warc-block-digest warc-payload-digest content-type content-length".split())


def derive(source: Record) -> list[Record]:
    """The metadata and conversion records of a response; none of other records, and no conversion of what isn't text."""
    head, end, body = source.block.partition(b"\r\n\r\n")
    if source.get("WARC-Type") != "response" or not end:
        return []
    target, date, own = source.get("WARC-Target-URI") or "", source.get("WARC-Date") or "", source.get("WARC-Record-ID") or ""
    lines = head.decode(errors="replace").split("\r\n")
    http = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
    of = lambda name: ", ".join(v for k, v in http if k == name)
    payload = decompressed(dechunked(body) if "chunked" in of("transfer-encoding").lower() else body, of("content-encoding"))
    media = of("content-type").split(";")[0].strip().lower()
    markup, page, links = not media or bool(MARKUP.match(media)), None, 0
    if payload is not None and (markup or TEXT.match(media)):
        page = text_of(payload, of("content-type"))
        marks = list(tags(page)) if markup else []
        links = sum(name == "a" and not ends and "href" in attributes.lower() for _, _, name, ends, attributes in marks)
    fields = [("status", lines[0].split(" ", 2)[1] if " " in lines[0] else "")]
    fields += [(f"http-{k}", v) for k, v in http]
    fields += [(f"source-{k.lower()}", v) for k, v in source.headers if k.lower() not in CARRIED]
    fields += [("source-block-digest", source.get("WARC-Block-Digest") or sha1(source.block)), ("source-payload-digest", source.get("WARC-Payload-Digest") or sha1(body)), ("payload-length", str(len(body))), ("outlinks", str(links))]
    back = (("WARC-Refers-To", own), ("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", date))
    made = [record("metadata", "".join(f"{k}: {v}\r\n" for k, v in fields).encode(), target, date, "application/warc-fields", *back, name=own)]
    if page is not None:
        shown = visible_text(page, marks) if markup else page
        made.append(record("conversion", shown.encode(errors="replace"), target, date, "text/plain; charset=utf-8", *back, ("WARC-Source-Payload-Digest", source.get("WARC-Payload-Digest") or sha1(body)), name=own))
    return made


def derived_rows(sources: Iterator[tuple[int, Record]], columns: list[str]) -> tuple[list[int], list[pa.Array]]:
    """The places of the sources that derived records come from, and the records' columns."""
    at, rows = [], {c: [] for c in columns}
    for i, source in sources:
        for made in derive(source):
            at.append(i)
            payload = source.get("WARC-Payload-Digest")
            values = (made.get("WARC-Type"), made.get("WARC-Record-ID"), made.get("WARC-Refers-To"), made.get("WARC-Target-URI"), made.get("WARC-Refers-To-Date"), made.get("Content-Type"), source.get("WARC-Block-Digest"), payload, made.get("WARC-Block-Digest"), len(made.block), made.block.decode(), made.to_bytes() if "record" in columns else None)
            for c, v in zip(columns, values, strict=False):
                rows[c].append(v)
    kinds = {"content_length": pa.int64(), "record": pa.binary()}
    return at, [pa.array(rows[c], kinds.get(c, pa.string())) for c in columns]


def derived_columns(with_record: bool) -> tuple[list[str], str]:
    kept = [c for c in COLUMNS.split(", ") if with_record or not c.startswith("record ")]
    return [c.split()[0] for c in kept], ", ".join(kept)


def derivatives(pages: DataFrame, date: str = DATE, with_record: bool = False) -> DataFrame:
    """Rows for the derived records of each page's response; ``record`` has their bytes."""
    kind = pages.schema["page_id"].dataType.simpleString()
    columns, schema = derived_columns(with_record)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_slices(batches, "html"):
            keys, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            sources = ((i, r) for i, page in enumerate(zip(keys, urls, texts, strict=True)) for r in read_records(response(*page, date).to_bytes()))
            at, made = derived_rows(sources, columns)
            yield pa.RecordBatch.from_arrays([batch.column("page_id").take(pa.array(at, pa.int64())), *made], names=["page_id", *columns])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, {schema}")


def file_derivatives(spark: SparkSession, path: str, with_record: bool = False) -> DataFrame:
    """Rows for the derived records of the responses in WARC files, plain or compressed; ``path`` names the file."""
    columns, schema = derived_columns(with_record)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                records = enumerate(read_records(content.as_py()))
                while some := list(islice(records, RECORDS)):
                    _, made = derived_rows(iter(some), columns)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(made[0]), pa.string()), *made], names=["path", *columns])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, f"path string, {schema}")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(common.pages(spark, sf_dir))
