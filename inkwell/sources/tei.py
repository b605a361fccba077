"""Text of TEI documents by their tags as they open and close, so that mixed and nested content stays whole."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a full text is made of, in its order: paragraphs, then parts that repeat or stand beside them.
KINDS = ("paragraph", "cell", "formula", "figDesc", "figure", "table", "item", "note", "div")
#: Elements that are parts by themselves; a paragraph within one of the last four is no part of its own.
PARTS = {"cell", "formula", "figDesc", "item", "note"}
AROUND = {"cell", "figDesc", "item", "note", "p"}

# Entity-like tokens, attributes that have them, prefixes that they may not begin with, page scopes, and ids of bibliographies and pages.
TOKEN = re.compile(r"[A-Za-z][A-Za-z0-9_.-]*\d+[A-Za-z0-9_.-]*")
ATTRIBUTE = re.compile(r'\b(?:xml:id|id|n|target|ref)\s*=\s*"([^"]+)"', re.I)
NO_ENTITY = ("fig", "sup", "sub", "sec", "eq", "lt", "gt", "amp")
PAGES = re.compile(r'<biblScope\b[^>]*unit="(?:page|pages)"[^>]*>(.*?)</biblScope>', re.I | re.S)
BIB_ID, PAGE_ID = re.compile(r"b\d{2,4}"), re.compile(r"e\d{3,4}")


def normalised(text: str) -> str:
    """Character references resolved, angle and square brackets as spaces, runs of white space as one."""
    return " ".join(re.sub(r"[<>\[\]]+", " ", html.unescape(text)).split())


def closed(text: str) -> str:
    """Trimmed, and with a period at the end unless empty."""
    text = text.strip()
    return text if not text or text.endswith(".") else f"{text}."


class Reader:
    """Collects the parts of one document while its tags open and close."""

    def __init__(self) -> None:
        self.stack: list[str] = []
        self.open: list[tuple[str, int, list[str]]] = []  # kind, depth and text of the parts that aren't closed
        self.found: dict[str, list[str]] = {}

    def start(self, name: str, _attributes: dict) -> None:
        tag = name.rpartition(":")[2]
        if kind := self.kind_of(tag):
            self.open.append((kind, len(self.stack), []))
        self.stack.append(tag)

    def kind_of(self, tag: str) -> str | None:
        inside = set(self.stack)
        if tag in PARTS:
            return tag if tag not in inside else None
        if tag == "p":
            return "paragraph" if ("body" in inside or "abstract" in inside) and not inside & AROUND else None
        if tag == "head":
            return next((t for t in reversed(self.stack) if t in ("figure", "table", "div")), "div" if "body" in inside else None)
        if tag == "abstract":
            return "abstract"
        if tag == "title":
            return "own title" if "titleStmt" in inside else "title"
        return None

    def text(self, data: str) -> None:
        for _, _, part in self.open:
            part.append(data)

    def end(self, _name: str) -> None:
        self.stack.pop()
        # Paragraphs of an abstract stay apart where nothing else does it.
        if self.open and self.open[-1][0] == "paragraph" and self.open[-1][1] == len(self.stack):
            for kind, _, part in self.open[:-1]:
                if kind == "abstract":
                    part.append(" ")
        while self.open and self.open[-1][1] == len(self.stack):
            self.close()

    def close(self) -> None:
        kind, _, part = self.open.pop()
        self.found.setdefault(kind, []).append("".join(part))

    def skipped(self, name: str, _parameter: bool) -> None:
        self.text(html.unescape(f"&{name};"))


def parts(xml: str) -> dict[str, list[str]]:
    """The texts of a document's parts by kind, each in document order; a damaged document has those up to the damage."""
    reader, parser = Reader(), expat.ParserCreate()
    parser.UseForeignDTD(True)  # so that entities that are not declared are skipped, not errors
    parser.StartElementHandler, parser.EndElementHandler = reader.start, reader.end
    parser.CharacterDataHandler, parser.SkippedEntityHandler = reader.text, reader.skipped
    try:
        parser.Parse(xml, True)
    except expat.ExpatError:
        pass
    while reader.open:
        reader.close()
    return reader.found


def entity_like(token: str) -> bool:
    """Whether a token has letters and digits and isn't a label, a character reference or a number in letters."""
    low = token.lower()
    return len(token) > 1 and any(c.isalpha() for c in token) and any(c.isdigit() for c in token) and not low.startswith(NO_ENTITY) and not re.fullmatch("[ivx]+", low)


def attribute_tokens(xml: str) -> list[str]:
    """Sorted entity-like tokens of text and attributes, without ids of bibliographies that only attributes have, and without page numbers that only page scopes have."""
    shown = set(filter(entity_like, TOKEN.findall(re.sub(r"<[^>]+>", " ", xml))))
    held = {t for value in ATTRIBUTE.findall(xml) for t in TOKEN.findall(value) if entity_like(t)}
    spans = [m.span(1) for m in PAGES.finditer(xml)]  # in order, and apart
    starts = [a for a, _ in spans]

    def paged(at: int) -> bool:
        i = bisect_right(starts, at) - 1
        return i >= 0 and at < spans[i][1]

    def junk(token: str) -> bool:
        low = token.lower()
        if BIB_ID.fullmatch(low):
            return token in held and token not in shown
        return bool(PAGE_ID.fullmatch(low) and spans) and all(paged(m.start()) for m in re.finditer(re.escape(token), xml))

    return sorted(t for t in shown | held if not junk(t))


def read(xml: str, attributes: bool = False) -> tuple[str, str, str]:
    """Title, abstract and full text."""
    found = parts(xml)
    pieces = [closed(t) for kind in KINDS for t in found.get(kind, [])]
    if attributes and (tokens := attribute_tokens(xml)):
        pieces.append(". ".join(tokens) + ".")
    title = next(iter(found.get("own title", []) + found.get("title", [])), "")
    return normalised(title), normalised(" ".join(found.get("abstract", [])[:1])), normalised(" ".join(p for p in pieces if p))


def tei(papers: DataFrame, xml: str = "text", attributes: bool = False) -> DataFrame:
    """``papers`` with title, abstract and fulltext of TEI documents; null for null."""
    shape = pa.struct([(c, pa.string()) for c in ("title", "abstract", "fulltext")])

    @F.arrow_udf("title string, abstract string, fulltext string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [None if x is None else dict(zip(("title", "abstract", "fulltext"), read(x, attributes), strict=True)) for x in batch.to_pylist()]
            yield pa.array(rows, shape)

    made = papers.withColumn("__tei", run(F.col(xml)))
    return made.withColumns({c: F.col("__tei")[c] for c in ("title", "abstract", "fulltext")}).drop("__tei")
