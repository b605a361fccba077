"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides each
block alone: what stands in menus, headers, footers, sidebars, notices,
adverts, forms or reader comments (by element, or by class, id and role) and
what is mostly links is boilerplate; long blocks with many stop words are
text; other long blocks without are boilerplate, if the stop words are those of
their language: blocks in other scripts, and those of a page that hardly has any
stop words, are judged by their length alone. Lists of links and lines with a
copyright sign belong to an article that holds no boilerplate by element or
class. The second pass gives
ambiguous blocks the label of the nearest neighbours that their own text
decided (what an element or class decided says nothing about its neighbours);
the edge of an article or main element counts as text for its inside.

Names are read by the parts of each class, id or role: a part that says what
the element lacks or has beside it (``no-sidebar``, ``with-sidebar``) or that
it heads an article (``entry-header``) names no boilerplate. No class, and no
form or header element, makes boilerplate of what holds an article, a main
element or most of the page's text; only comments may be longer than the text
that they are about.

Scripts, styles, comments and form controls never become blocks. One pass over
the markup, in time and memory linear in the page: attributes have any length,
tags may stay open, and open tags are counted, not searched.

Defined results: a null or empty page, or one without text, gives an empty
text; unclosed and stray tags are tolerated, a tag cut off by the page's end
is markup; neighbours at the same distance that differ make a block of
``SHORT`` or more text, and a heading takes the label of what follows it;
repeated rows get equal results; an empty table gives no row; extra columns
are not carried on unless named in ``keep``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cached_property
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import common

LONG, SHORT = 200, 70
STOP_HIGH, STOP_LOW = 0.12, 0.05
LINK_DENSITY = 0.33

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = frozenset(
    """the of and to in is that for it with as was on are be by this from or an at he his not but have had they you which were
    der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei
    de la le les et des en un une du que est pour qui dans par sur au pas plus ce il ne se sont avec aux son cette ou
    el los las y del se por con no su lo como más pero sus al para una es ya entre cuando muy sin sobre""".split()
)
BLOCK_TAGS = frozenset(
    """address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer
    form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td
    tfoot th thead tr ul""".split()
)
#: Elements that are closed explicitly and may carry a meaning for what they hold.
CONTAINERS = frozenset("article aside blockquote details dialog div dl fieldset figure footer form header main menu nav ol section table td ul".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
UNSEEN = frozenset("head button select option datalist label noscript template svg canvas object video audio map".split())
BOILER_TAGS = frozenset("nav footer aside menu dialog".split())
BOILER_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar
    breadcrumb breadcrumbs header masthead topbar footer bottom sidebar aside rail related recommended recirc share sharing social follow
    comment comments commentlist respond replies disqus discussion cookie cookies consent gdpr notice notices alert popup modal overlay
    newsletter subscribe signup login pagination pager tags toolbar widget copyright legal disclaimer skip toc""".split()
)
COMMENTS = frozenset("comment comments commentlist respond replies disqus discussion".split())
#: Parts beside a word of boilerplate that make it say something else.
BESIDE = frozenset("no not without with has have non hide hidden is open closed enabled disabled left right layout".split())
HEADED = frozenset("entry post article story page content section title chapter".split())
NAMED = re.compile(r"(?:^|[\s\"'])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
TAG_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*+")
PLAIN = re.compile(r"[^>\"']*+")
NEXT_LINK = re.compile(r"</?a(?=[\s/>])", re.IGNORECASE)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Block(NamedTuple):
    text: str
    linked: int  # code points within links, without white space
    boiler: bool  # by what it stands in
    article: bool
    heading: bool


#: First, last, name (empty for comments, declarations and such), whether it ends an element, attributes.
Tag = tuple[int, int, str, bool, str]
#: A tag whose values are quoted right after their equals sign and hold no angle bracket: most are.
USUAL = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"'=]++|=\"[^\"<>]*+\"|='[^'<>]*+'|=(?![\"']))*+)>")


def tags(page: str) -> Iterator[Tag]:
    """The markup of a page in order; a raw element (a script, say) is one tag with what it holds."""
    at, gone = 0, set()  # quotes that no longer come, so that none is looked for twice
    while (first := page.find("<", at)) >= 0:
        if usual := USUAL.match(page, first):
            slash, tag, attributes = usual.groups()
            tag, at = tag.lower(), usual.end()
            if tag in RAW and not slash:
                close = RAW_ENDS[tag].search(page, at)
                at = close.end() if close else len(page)
            yield first, at, tag, bool(slash), attributes
            continue
        ends = page.startswith("/", first + 1)
        name = TAG_NAME.match(page, first + 1 + ends)
        if not name:
            if page.startswith("<!--", first):
                last = page.find("-->", first + 2)
                at = len(page) if last < 0 else last + 3
            elif page[first + 1 : first + 2] in ("!", "?", "/"):
                last = page.find(">", first)
                at = len(page) if last < 0 else last + 1
            else:
                at = first + 1
                continue
            yield first, at, "", False, ""
            continue
        last = name.end()
        while True:
            last = PLAIN.match(page, last).end()
            mark = page[last : last + 1]
            if mark in (">", ""):
                break
            value = mark not in gone and page[max(name.end(), last - 32) : last].rstrip().endswith("=")
            close = page.find(mark, last + 1) if value else -1
            if value and close < 0:
                gone.add(mark)
            last = max(last, close) + 1
        tag, attributes = name[0].lower(), page[name.end() : last]
        at = min(last + 1, len(page))
        if tag in RAW and not ends:
            close = RAW_ENDS[tag].search(page, at)
            at = close.end() if close else len(page)
        yield first, at, tag, ends, attributes


RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.IGNORECASE) for tag in RAW}


def named_boiler(attributes: str) -> str:
    """A word of class, id or role that names boilerplate, or nothing."""
    for m in NAMED.finditer(attributes) if "=" in attributes else ():
        for token in (m[1] or m[2] or m[3] or "").split():
            parts = {p.lower() for p in PARTS.findall(token)}
            found = parts & BOILER_WORDS
            if found and not (parts & BESIDE and len(parts) > 1) and not (found <= {"header", "tags"} and parts & HEADED):
                return min(found & COMMENTS or found)
    return ""


class Holder:
    """An element that may carry a meaning for what it holds."""

    __slots__ = ("above", "name", "kind", "article", "size", "holds", "boiler")

    def __init__(self, above: int, name: str, kind: str, article: bool):
        self.above, self.name, self.kind, self.article = above, name, kind, article
        self.size, self.holds, self.boiler = 0, "", False


def blocks(page: str, marks: Iterable[Tag] | None = None) -> list[Block]:
    holders = [Holder(-1, "", "", False)]
    found: list[tuple[str, int, int, bool]] = []  # text, linked, holder, heading
    stack, opened = [0], Counter()
    parts: list[str] = []
    linked = at = 0
    link = across = heading = False  # across: the link is closed by a tag of its own, so block tags within it don't end it
    unseen = Counter()
    hidden = 0

    def close() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append((text, linked, stack[-1], heading))
                holders[stack[-1]].size += len(text)
        parts, linked = [], 0

    def read(chunk: str) -> None:
        nonlocal linked
        if chunk and not hidden:
            chunk = unescape(chunk)
            parts.append(chunk)
            if link:
                linked += len("".join(chunk.split()))

    closed: dict[str, int] = {}  # where the next end tag of a hidden element is
    for before, after, tag, ends, attributes in tags(page) if marks is None else marks:
        if at < before:
            read(page[at:before])
        at = after
        if not tag or tag in RAW:
            continue
        if tag in UNSEEN:
            close()
            if ends:
                hidden -= unseen.pop(tag, 0)
            elif not attributes.endswith("/"):
                # One that is never closed hides nothing; a head ends with the body at last.
                if tag != "head" and closed.get(tag, -1) < at:
                    end = re.compile(f"</{tag}", re.IGNORECASE).search(page, at)
                    closed[tag] = end.start() if end else len(page) + 1
                if tag == "head" or closed[tag] <= len(page):
                    unseen[tag] += 1
                    hidden += 1
            continue
        if tag == "body" and unseen["head"]:
            hidden -= unseen.pop("head")
        if tag == "a":
            link = not ends and "href" in attributes.lower()
            across = link and bool(own := NEXT_LINK.search(page, at)) and own[0][1] == "/"
        elif tag == "br":
            parts.append("\n")
        elif tag in BLOCK_TAGS:
            close()
            link = link and across
            heading = tag in HEADINGS and not ends
            if tag not in CONTAINERS:
                continue
            if not ends:
                if attributes.endswith("/"):
                    continue
                above = holders[stack[-1]]
                kind = "tag" if tag in BOILER_TAGS else "weak" if tag == "form" or (tag == "header" and not above.article) else ""
                if not kind and (word := named_boiler(attributes)):
                    kind = "comments" if word in COMMENTS else "weak"
                stack.append(len(holders))
                holders.append(Holder(stack[-2], tag, kind, above.article or tag in ("article", "main")))
                opened[tag] += 1
            elif opened[tag]:
                while True:
                    name = holders[stack.pop()].name
                    opened[name] -= 1
                    if name == tag:
                        break
    read(page[at:])
    close()
    # Sizes and articles go up from the inside out, then what is boilerplate goes down.
    for h in reversed(holders[1:]):
        above = holders[h.above]
        above.size += h.size
        above.holds = max(above.holds, h.holds, h.name if h.name in ("main", "article") else "")
    for h in holders[1:]:
        above = holders[h.above]
        most = 2 * h.size > holders[0].size
        own = h.kind == "tag" or (h.kind == "comments" and h.holds != "main") or (h.kind == "weak" and not (h.holds or most))
        h.boiler = above.boiler or own
    return [Block(text, n, holders[k].boiler, holders[k].article, head) for text, n, k, head in found]


def stop_words(text: str) -> tuple[int, int]:
    """Stop words, and all words."""
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words), len(words)


def foreign(text: str) -> bool:
    """Whether most letters are of a script that the stop words don't have."""
    letters = [c for c in text if c.isalpha()]
    return 2 * sum(c > "\u024f" for c in letters) > len(letters)


def length(text: str) -> int:
    """Code points; ideographs and syllables, of which a word has fewer, count twice."""
    return len(text) if text.isascii() else len(text) + len(WIDE.findall(text))


WIDE = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")


class Page:
    """What the first pass knows of a whole page."""

    def __init__(self, found: list[Block]):
        self.found = found
        #: Whether articles hold boilerplate by element or class, so that links and notices within may be some, too.
        self.mixed = any(b.article and b.boiler for b in found)

    @cached_property
    def known(self) -> bool:
        """Whether the page's own text has the stop words of a known language."""
        counts = [stop_words(b.text) for b in self.found if not b.boiler and not linky(b)]
        return sum(n for n, _ in counts) >= STOP_LOW * sum(n for _, n in counts)

    def decide(self, b: Block) -> bool | None:
        """First pass: text (True), boilerplate (False) or ambiguous (None)."""
        size = length(b.text)
        if b.boiler:
            return False
        if (linky(b) or ("©" in b.text and size < LONG)) and not (b.article and not self.mixed):
            return False
        if size < SHORT or b.heading or linky(b):
            return None
        stop, words = stop_words(b.text)
        if stop < STOP_LOW * words and (foreign(b.text) or not self.known):
            return True if size >= LONG else None
        if stop >= STOP_HIGH * words and size >= LONG:
            return True
        if stop >= STOP_LOW * words or b.article:
            return None
        return False


def linky(b: Block) -> bool:
    return b.linked > LINK_DENSITY * (len(b.text) - b.text.count(" "))


def classify(page: list[Block]) -> list[bool]:
    """Both passes: whether each block is main text."""
    own = Page(page)
    first = [own.decide(b) for b in page]
    out = []
    before: list[bool | None] = []
    last: bool | None = None
    for k, (b, d) in enumerate(zip(page, first, strict=True)):
        if k and b.article != page[k - 1].article:
            last = True if b.article else None  # an article's edge is a decided neighbour of its inside
        elif not k and b.article:
            last = True
        before.append(last)
        last = d if d is not None and not b.boiler else last
    after: bool | None = None
    behind: list[bool | None] = [None] * len(page)
    for k in range(len(page) - 1, -1, -1):
        if page[k].article and (k + 1 == len(page) or not page[k + 1].article):
            after = True
        elif k + 1 < len(page) and page[k].article != page[k + 1].article:
            after = None
        behind[k] = after
        after = first[k] if first[k] is not None and not page[k].boiler else after
    for b, d, x, y in zip(page, first, before, behind, strict=True):
        if d is not None:
            out.append(d)
        elif x is not None and y is not None and x != y:
            # Between the two: long enough to read, or a heading of what follows.
            out.append(b.article or (y if b.heading else len(b.text) >= SHORT))
        else:
            near = x if x is not None else y
            out.append(bool(near) if near is not None else len(b.text) >= SHORT)
    return out


def main_text(page: str) -> str:
    cut = blocks(page)
    return "\n".join(b.text for b, keep in zip(cut, classify(cut), strict=True) if keep)


def visible_text(page: str, marks: Iterable[Tag] | None = None) -> str:
    return "\n".join(b.text for b in blocks(page, marks))


def extract(df: DataFrame, html: str = "html", *, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, the main ``text`` and its code points (``n_chars``)."""
    kind = df.select(*keep).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind) + ", text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_slices(batches, html):
            made = [main_text(t) for t in texts]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(made, pa.string()), pa.array(list(map(len, made)), pa.int64())], names=[*keep, "text", "n_chars"])

    return df.select(*dict.fromkeys((*keep, html))).mapInArrow(run, schema)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.pages(spark, sf_dir))
