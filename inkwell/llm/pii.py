"""Personal data: fixed patterns, and a semi-Markov conditional random field.

The patterns' spans (email, ip, card, phone) always stay. The model adds spans
that patterns miss: numbers without a country code, written-out addresses and
secrets. It scores whole candidate spans, not tokens: what a span consists of,
its checksum, its neighbours and the words before it are features of the
span. Decoding is a dynamic program over units (letter or digit runs and
single marks) in which an entity has at most ``LONGEST`` units; it chooses all
boundaries and types of a region jointly. Training maximises the likelihood of
labelled sentences, which a seeded generator writes, by forward-backward;
among them are tables of numbers, years, dates, ISBNs and order numbers, which
are none.

Every entity has a trigger in it (a digit, an at sign, a written-out "at"), so
only regions around triggers are decoded: ``REACH`` characters to both sides
and on to white space, each from the end of the one before, whole and of any
length. What a span must look like to be a candidate of a type is fixed: a
number without plus sign is a candidate for a phone only in a telephone's
grouping or after a word that announces one. Work and memory are linear in the
text, which needs no white space, and no span is too long.

Defined results: null and empty texts have no span; repeated rows get equal
results; of equal scores the shorter segment, then the first type wins; an
empty table gives no row; extra columns of ``detect`` are not carried on
unless named in ``keep``, those of ``redact`` stay as they are.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import common

Span = tuple[str, int, int]

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
TYPES = ("out", *KINDS)
LONGEST = 16
REACH = 60
FEATURES = 1 << 12

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY_DIGIT = re.compile(r"[0-9]")
UNIT = re.compile(r"[^\W\d_]+|[0-9A-Za-z]*[0-9][0-9A-Za-z]*|\S")
TRIGGER = re.compile(r"[0-9@]|\bat\b(?= ?[\])])", re.IGNORECASE)
GAP = re.compile(r"\s")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Leftmost, non-overlapping; looks left from each at sign, so in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in LOCAL:
            first -= 1
        m = HOST.match(text, at) if first < at else None
        if m:
            yield "email", first, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def addresses(text: str) -> Iterator[Span]:
    for m in CHAIN.finditer(text):
        parts = m[0].split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            own = parts[k : k + 4]
            end = at + sum(map(len, own)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in own):
                yield "ip", at, end
            at = end + 1


def base_spans(text: str) -> list[Span]:
    """The patterns' spans: by kind as listed, then start."""
    out = list(emails(text))
    if ANY_DIGIT.search(text):
        out += addresses(text)
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def crc(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "little") % FEATURES


@lru_cache(maxsize=1 << 16)
def feature(name: str) -> int:
    return crc(name)


#: Telephones' groupings: three, three and four digits; an area code from zero; pairs from zero.
GROUPED = re.compile(r"\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}|\(?0[0-9]{2,4}\)?[ /.-][0-9]{3,4}(?:[ .-]?[0-9]{2,5}){1,2}|0[0-9](?:[ .-][0-9]{2}){4}")
CARD_GROUPED = re.compile(r"[2-6][0-9]{12,18}|[2-6][0-9]{3}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|3[0-9]{3}([ -])[0-9]{6}\2[0-9]{4,5}")
WRITTEN = re.compile(r"[\w.-]+ ?[\[(] ?at ?[\])] ?[\w-]+(?: ?[\[(] ?dot ?[\])] ?\w+)+", re.IGNORECASE)
SECRET_WORD = re.compile(r"(?:token|secret|password|passwd|key)\W{0,6}$", re.IGNORECASE)
PHONE_WORD = re.compile(r"\b(?:tel|telephone|phone|call|fax|mobile)\W{0,4}$", re.IGNORECASE)


def span_features(text: str, first: int, last: int) -> list[int]:
    """Features of text[first:last] as a whole, and of what stands around it."""
    s = text[first:last]
    digits = sum(c in "0123456789" for c in s)
    letters = sum(c.isalpha() for c in s)
    size = lambda n: n if n < 4 else 4 + (n > 6) + (n > 8) + (n > 11) + (n > 15) + (n > 19) + (n > 31)
    before, after = text[first - 1 : first], text[last : last + 1]
    kind = lambda c: "" if not c else "9" if c in "0123456789" else "a" if c.isalpha() else "_" if c.isspace() else c if c in "\"'+@.-()[]=:/" else "?"
    shape = "d" * (digits > 0) + "a" * (letters > 0) + "s" * (" " in s) + "n" * ("\n" in s) + "@" * ("@" in s) + "." * ("." in s) + "-" * ("-" in s) + "?" * any(kind(c) == "?" for c in s)
    hexes = bool(digits and letters and re.fullmatch("[0-9a-fA-F]+", s))
    grouped, written = bool(GROUPED.fullmatch(s)), bool(WRITTEN.fullmatch(s))
    lead = text[max(0, first - 16) : first]
    told = "s" * bool(SECRET_WORD.search(lead)) + "p" * bool(PHONE_WORD.search(lead))
    names = [
        "bias", f"shape={shape}", f"digits={size(digits)}", f"letters={size(letters)}", f"length={size(len(s))}", f"ends={kind(s[0])}{kind(s[-1])}",
        f"around={kind(before)}{kind(after)}", f"before={kind(before)}", f"after={kind(after)}", f"glued={(kind(before) in '9a' and before != '') or (kind(after) in '9a' and after != '')}",
        f"told={told}", f"told={told} hex={hexes} {size(len(s))}", f"hex={hexes} {size(len(s))}", f"grouped={grouped}", f"written={written}",
        f"luhn={13 <= digits <= 19 and letters == 0 and luhn(re.sub('[^0-9]', '', s))} {shape}", f"shape={shape} digits={size(digits)}",
    ]
    return [feature(n) for n in names]


class Region(NamedTuple):
    units: list[tuple[int, int]]
    features: np.ndarray  # [unit, length - 1, feature]
    allowed: np.ndarray  # [unit, length - 1, type]


#: What a span must look like to be a candidate of a type; the model chooses among candidates.
ADDRESS = re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+")
FOUR_PARTS = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
NUMBER = re.compile(r"[+(]?[0-9][0-9 ().-]*[0-9]")
LONG_CODE = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[0-9A-Za-z]{16,}")
MARKS = frozenset("0123456789+().-/ ")
JOINTS = frozenset(" .-/")


def joined_on(text: str, first: int, last: int) -> bool:
    """Whether a digit stands next to text[first:last], or beyond one joint: then it is part of something longer."""
    before, after = text[max(0, first - 2) : first], text[last : last + 2]
    left = before[-1:].isdigit() or (len(before) == 2 and before[1] in JOINTS and before[0].isdigit())
    return left or after[:1].isdigit() or (len(after) == 2 and after[0] in JOINTS and after[1].isdigit())


def candidate_types(text: str, first: int, last: int) -> list[int]:
    s, out = text[first:last], []
    if "\n" in s:
        return out
    if ("@" in s and ADDRESS.fullmatch(s)) or (("[" in s or "(" in s) and WRITTEN.fullmatch(s)):
        out.append(1)
    if MARKS.issuperset(s):
        if FOUR_PARTS.fullmatch(s) and all(int(p) <= 255 for p in s.split(".")) and not joined_on(text, first, last):
            out.append(2)
        digits = re.sub("[^0-9]", "", s)
        if CARD_GROUPED.fullmatch(s) and luhn(digits) and not joined_on(text, first, last):
            out.append(3)
        if 9 <= len(digits) <= 15 and NUMBER.fullmatch(s):
            told = PHONE_WORD.search(text, max(0, first - 16), first)
            if told or s[0] == "+" or (GROUPED.fullmatch(s) and not joined_on(text, first, last)):
                out.append(4)
    elif len(s) >= 16 and LONG_CODE.fullmatch(s):
        out.append(5)
    return out


def region(text: str, units: list[tuple[int, int]]) -> Region:
    n = len(units)
    rows = np.zeros((n, LONGEST, 17), dtype=np.int64)
    allowed = np.zeros((n, LONGEST, len(TYPES)), dtype=bool)
    allowed[:, 0, 0] = True
    for i, k, types in candidates(text, units):
        rows[i, k] = span_features(text, units[i][0], units[i + k][1])
        allowed[i, k, types] = True
    return Region(units, rows, allowed)


def candidates(text: str, units: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """(first unit, length - 1, types) of the spans that may be entities."""
    for i, (first, _) in enumerate(units):
        for k in range(min(LONGEST, len(units) - i)):
            if types := candidate_types(text, first, units[i + k][1]):
                yield i, k, types


class Crf(NamedTuple):
    spans: np.ndarray  # [feature, type]; type 0 (outside) has length one and score zero
    steps: np.ndarray  # [type before, type]

    def scores(self, r: Region) -> np.ndarray:
        """[first unit, length - 1, type]; impossible segments have minus infinity."""
        out = np.full(r.allowed.shape, -np.inf)
        out[:, 0, 0] = 0.0
        i, k, t = np.nonzero(r.allowed[:, :, 1:])
        out[i, k, t + 1] = self.spans[r.features[i, k], t[:, None] + 1].sum(axis=1)
        return out

    def decode(self, text: str, units: list[tuple[int, int]]) -> list[Span]:
        """The best segmentation: work and memory in proportion to units and candidates."""
        ending: dict[int, list[tuple[int, int, float]]] = defaultdict(list)
        for i, k, types in candidates(text, units):
            own = self.spans[span_features(text, units[i][0], units[i + k][1])].sum(axis=0).tolist()
            for t in types:
                ending[i + k + 1].append((k + 1, t, own[t]))
        if not ending:
            return []
        steps, kinds = self.steps.tolist(), range(len(TYPES))
        best: list[list[float]] = [[0.0] + [-np.inf] * (len(TYPES) - 1)]
        back: list[dict[int, tuple[int, int]]] = [{}]
        for j in range(1, len(units) + 1):
            row, came = [-np.inf] * len(TYPES), {}
            for size, t, own in ((1, 0, 0.0), *sorted(ending.get(j, ()))):
                old = best[j - size]
                u = max(kinds, key=lambda u: old[u] + steps[u][t])  # noqa: B023
                if (score := old[u] + steps[u][t] + own) > row[t]:
                    row[t], came[t] = score, (size, u)
            best.append(row)
            back.append(came)
        found, j = [], len(units)
        t = max(kinds, key=best[j].__getitem__)
        while j > 0:
            size, before = back[j][t]
            if t:
                found.append((TYPES[t], units[j - size][0], units[j - 1][1]))
            j, t = j - size, before
        return found[::-1]

    def expected(self, r: Region) -> tuple[np.ndarray, np.ndarray, float]:
        """Expected segments [unit, length - 1, type] and transitions, and the log partition."""
        n, s = len(r.units), self.scores(r)
        kinds = len(TYPES)
        ahead, behind = np.full((n + 1, kinds), -np.inf), np.full((n + 1, kinds), -np.inf)
        ahead[0, 0] = 0.0
        behind[n] = 0.0
        with np.errstate(divide="ignore", invalid="ignore"):
            for j in range(1, n + 1):
                lengths = np.arange(1, min(LONGEST, j) + 1)
                entry = logsum(ahead[j - lengths][:, :, None] + self.steps[None], 1)
                ahead[j] = logsum(entry + s[j - lengths, lengths - 1], 0)
            for i in range(n - 1, -1, -1):
                lengths = np.arange(1, min(LONGEST, n - i) + 1)
                exits = logsum(s[i, lengths - 1] + behind[i + lengths], 0)
                behind[i] = logsum(self.steps + exits[None, :], 1)
            total = logsum(ahead[n], 0)
            segments, moves = np.zeros_like(s), np.zeros_like(self.steps)
            for i in range(n):
                lengths = np.arange(1, min(LONGEST, n - i) + 1)
                entry = ahead[i][:, None] + self.steps
                inner = s[i, lengths - 1] + behind[i + lengths]
                segments[i, lengths - 1] = np.exp(logsum(entry, 0)[None, :] + inner - total)
                moves += np.exp(entry + logsum(inner, 0)[None, :] - total)
        return segments, moves, float(total)


def logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def units_of(text: str, first: int = 0, last: int | None = None) -> list[tuple[int, int]]:
    return [m.span() for m in UNIT.finditer(text, first, len(text) if last is None else last)]


def labelled_sentences(n: int, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """Sentences with and without personal data, and their spans."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "tor", "he", "is", "mo", "ra", "end", "ly", "ko", "per"]) for _ in range(rng.randint(1, 3)))
    number = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))

    def card() -> str:
        body = number(15)
        return next(body + d for d in "0123456789" if luhn(body + d))

    def entity() -> tuple[str, str, str, str]:
        """Words before, the span, words after, its type."""
        kind = rng.choice(("email", "ip", "card", "phone", "phone", "secret", "secret", "written"))
        if kind == "email":
            return "", f"{word()}.{number(2)}@{word()}{number(1)}.example.com", "", "email"
        if kind == "written":
            return "", f"{word()} [at] {word()} [dot] com", "", "email"
        if kind == "ip":
            return "", ".".join(str(rng.randint(1, 255)) for _ in range(4)), "", "ip"
        if kind == "card":
            c = card()
            return "", rng.choice([c, " ".join(c[k : k + 4] for k in range(0, 16, 4)), "-".join(c[k : k + 4] for k in range(0, 16, 4))]), "", "card"
        if kind == "phone":
            a, b, c = number(3), number(3), number(4)
            lead = rng.choice(["", "", "call ", "tel: ", "phone ", "Mobile "])
            local = [f"0{number(2)} {number(7)}", f"0{a}-{number(6)}", number(10)] if lead else [f"0{number(1)} {number(2)} {number(2)} {number(2)} {number(2)}"]
            return lead, rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", *local]), "", "phone"
        name = rng.choice(["token", "secret", "api_key", "password", "TOKEN"])
        value = hexes(rng.choice([32, 40, 40, 64]))
        value = value.upper() if name == "TOKEN" else value
        return f"{name} = \"", value, '"', "secret"

    def plain() -> str:
        return rng.choice([
            f"version {number(1)}.{number(1)}", number(4), number(2), f"{number(1)}.{number(2)}", f"page {number(3)}", number(16), f"{number(4)}-{number(2)}-{number(2)}", f"{word()}{number(1)}",
            " ".join(number(rng.randint(1, 3)) for _ in range(rng.randint(5, 12))), " ".join(str(rng.randint(1900, 2030)) for _ in range(rng.randint(2, 6))), f"ISBN 978-{number(1)}-{number(2)}-{number(6)}-{number(1)}", f"order {number(9)}", f"{number(4)}-{number(2)}-{number(2)} {number(2)}",
            f"no. {number(10)}", "\t".join(f"{number(2)}.{number(3)}" for _ in range(5)), f"10.{number(4)}/{word()}.{number(4)}.{number(6)}", f"{number(3)} {number(3)} {number(3)}", f"{number(1)},{number(3)},{number(3)}", f"{word()}{number(3)}{word()}{number(2)}",
            f"{number(2)}:{number(2)}", f"{number(3)},{number(3)}", f"{number(2)}%", f"@{word()}", "token", "the secret is", f"({number(4)})", f"BY-NC 4.{number(1)}", hexes(6), f"{number(1)}.", f"{number(5)}", f"p53 {word()}-{number(2)}",
        ])

    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randint(1, 3)):
            text += " ".join(word() for _ in range(rng.randint(1, 4))) + " "
            if rng.random() < 0.6:
                lead, value, tail, kind = entity()
                text += lead
                spans.append((kind, len(text), len(text) + len(value)))
                text += value + tail + rng.choice(["", "", ".", ",", "!!", "###"]) + " "
            else:
                text += plain() + " "
        out.append((text + word(), spans))
    return out


def gold(r: Region, spans: list[Span]) -> list[tuple[int, int, int]]:
    """(first unit, length, type) segments; spans that no units make up are left outside."""
    starts, ends = {a: i for i, (a, _) in enumerate(r.units)}, {b: i for i, (_, b) in enumerate(r.units)}
    marked = {starts[a]: (ends[b] - starts[a] + 1, TYPES.index(kind)) for kind, a, b in spans if a in starts and b in ends and ends[b] - starts[a] < LONGEST}
    marked = {i: (size, t) for i, (size, t) in marked.items() if r.allowed[i, size - 1, t]}
    out, i = [], 0
    while i < len(r.units):
        size, t = marked.get(i, (1, 0))
        out.append((i, size, t))
        i += size
    return out


@lru_cache(maxsize=2)
def trained(n: int = 300, epochs: int = 6, rate: float = 0.5, seed: int = 7) -> Crf:
    """The model, trained on this many generated sentences by AdaGrad."""
    data = []
    for text, spans in labelled_sentences(n, seed):
        r = region(text, units_of(text))
        data.append((r, gold(r, spans)))
    crf = Crf(np.zeros((FEATURES, len(TYPES))), np.zeros((len(TYPES), len(TYPES))))
    seen_spans, seen_steps = np.full_like(crf.spans, 1e-6), np.full_like(crf.steps, 1e-6)
    order = random.Random(seed)
    for _ in range(epochs):
        order.shuffle(data)
        for r, truth in data:
            segments, moves, _ = crf.expected(r)
            before = 0
            for i, size, t in truth:
                segments[i, size - 1, t] -= 1
                moves[before, t] -= 1
                before = t
            segments[:, :, 0] = 0
            grad = np.zeros_like(crf.spans)
            at = np.abs(segments).sum(axis=2) > 1e-6
            rows, values = r.features[at], segments[at]
            np.add.at(grad, rows.ravel(), np.repeat(values, rows.shape[1], axis=0))
            touched = np.unique(rows)
            g = grad[touched] + 1e-4 * crf.spans[touched]
            seen_spans[touched] += g * g
            crf.spans[touched] -= rate * g / np.sqrt(seen_spans[touched])
            moves += 1e-4 * crf.steps
            seen_steps += moves * moves
            crf.steps[:] -= rate * moves / np.sqrt(seen_steps)
    return crf


def regions(text: str) -> Iterator[list[tuple[int, int]]]:
    """Units around triggers, as separate runs."""
    end = 0
    group: list[int] | None = None
    for m in TRIGGER.finditer(text):
        if group and m.start() - REACH <= group[1]:
            group[1] = max(group[1], m.end() + REACH)
            continue
        if group:
            end = run_end(text, group[1])
            if m.start() < end:
                group[1] = max(end, m.end() + REACH)
                continue
            yield units_of(text, group[0], end)
        first = max(end, m.start() - REACH)
        # On to white space, but not into the region before.
        group = [max(end, *(text.rfind(c, end, first) + 1 for c in " \t\n\r")) if first > end and not text[first - 1].isspace() else first, m.end() + REACH]
    if group:
        yield units_of(text, group[0], run_end(text, group[1]))


def run_end(text: str, at: int) -> int:
    m = GAP.search(text, min(at, len(text)))
    return m.start() if m else len(text)


def find(text: str, crf: Crf) -> tuple[list[Span], list[Span]]:
    """The patterns' spans, and all spans with the model's."""
    base = base_spans(text)
    if not TRIGGER.search(text):
        return base, base
    # Disjoint intervals in order: a new one overlaps if it begins before the end of the one before, or ends after the next one's start.
    taken: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    everything = list(base)
    for units in regions(text):
        for kind, a, b in crf.decode(text, units):
            k = bisect_left(taken, (a, a))
            if (k == 0 or taken[k - 1][1] <= a) and (k == len(taken) or taken[k][0] >= b):
                insort(taken, (a, b))
                everything.append((kind, a, b))
    return base, sorted(everything, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(df: DataFrame, text: str = "text", *, keep: tuple[str, ...] = ("doc_id",), crf: Crf | None = None) -> DataFrame:
    """``keep``, n_email, n_ip, n_card, n_phone (by the patterns), base_sha256, spans, and n_spans (of all spans, the model's included)."""
    kind = df.select(*keep).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind) + ", n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
    shared = df.sparkSession.sparkContext.broadcast(crf or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_slices(batches, text):
            found = [find(t, shared.value) for t in texts]
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in BASE]
            hashes = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found])
            columns = [batch.column(k) for k in keep] + [*counts, hashes, pa.array([joined(s) for _, s in found], pa.string()), pa.array([len(s) for _, s in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_spans"])

    return df.select(*dict.fromkeys((*keep, text))).mapInArrow(run, schema)


def redact_text(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind; overlapping spans become one."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, text: str = "text", size: str | None = "n_chars", crf: Crf | None = None) -> DataFrame:
    """``docs`` with personal data replaced in ``text``, and ``size`` (its code points) brought up to date."""
    shared = docs.sparkSession.sparkContext.broadcast(crf or trained())
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_slices(batches, text):
            made = [redact_text(t, find(t, shared.value)[1]) for t in texts]
            valid = batch.column(text).is_valid().to_pylist()
            new = {text: pa.array([m if v else None for m, v in zip(made, valid, strict=True)], pa.string())}
            if size in names:
                new[size] = pa.array([len(m) if v else None for m, v in zip(made, valid, strict=True)], pa.int64()).cast(batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in names], names=names)

    return docs.mapInArrow(run, docs.schema)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(common.documents(spark, sf_dir))
