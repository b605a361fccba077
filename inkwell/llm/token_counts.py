"""Token counts by a tokenizer compiled into a finite-state transducer.

The transducer reads the bytes of a lower-cased text. It joins two machines:
that of the pre-token pattern (letters, single digits, other marks, the seven
contractions) and that of byte-pair encoding within a pre-token. For the
latter, a sequence of tokens is an encoding if and only if each two tokens
that follow each other are (``Pairs``), so the last token of every prefix is
unique, and a prefix's encoding is that of a shorter prefix and one token. A
state therefore holds, for every place from which a vocabulary token may still
reach on, the token's trie node, the last token there, and how many tokens
fewer or more that place has. A transition is annotated with the tokens that
its byte adds to the count (fewer than none where tokens merge); white space
closes a word, whose last byte has tokens of its own.

States and transitions are determinised when they are first met, and kept as
arrays (next state and emitted count for each state and byte class) of
``MOST_STATES`` states at most (175 MB); then all but the current states are
forgotten and met again. Since ``Pairs`` is exact, the counts are those of the
library. Words with characters beyond printable ASCII and Latin-1 letters, or
with a special string, are counted by the library itself.

Texts are cut into lanes just after white space, where the state is the
start, and all lanes of a batch run abreast, a byte a step. A run without
white space that is longer than ``PIECE`` is cut anywhere; a piece's state map
sends entry states to exit states and counts, for every entry state that any
piece before it can end in, and maps compose through a parallel prefix scan.
Memory is in proportion to a slice of ``SLICE_BYTES`` or one longer text,
with or without white space.

Defined results: null and empty texts have no token and no byte; repeated rows
are counted each; an empty table gives no row; extra columns are not carried
on unless named in ``keep``, of which any name may clash with nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import common, wordbpe

LIMIT = 2048
LANE, PIECE, WARM = 256, 4096, 64
MOST_STATES = 1 << 18
MOST_WORDS = 200_000
SPACES = b" \t\n\r\x0b\x0c"
IS_SPACE = np.isin(np.arange(256), np.frombuffer(SPACES, dtype=np.uint8))
ODD = re.compile(r"[^\x20-\x7eÀ-ÖØ-öø-ÿ\t\n\r\x0b\x0c]|<\|")
SPACE = re.compile(r"[ \t\n\r\x0b\x0c]")

#: Byte classes: white space, and each byte that lower-cased plain text can have.
BYTES = [b for b in range(0x21, 0x7F) if not 0x41 <= b <= 0x5A] + list(range(0x80, 0x100))
CLASSES = len(BYTES) + 1
CLASS = np.zeros(256, dtype=np.int32)
CLASS[BYTES] = np.arange(1, CLASSES)

LETTER, MARKS, ENDED, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(1, 8)
NONE = 0xFFFF
#: A state: how its pre-token goes on, the tokens that the word's end adds, and its places.
START = (0, 0)


class Pairs:
    """Which two tokens may follow each other in an encoding."""

    def __init__(self, bpe: wordbpe.WordBpe):
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for key, rank in zip(bpe.keys.tolist(), bpe.ranks.tolist(), strict=True):
            a, b, made = key >> 16, key & 0xFFFF, int(bpe.made[rank])
            if made in self.parts or made <= max(a, b):
                raise ValueError("token ids must follow the order of merges, one merge each")
            self.parts[made] = (a, b)
            self.made[key] = made
        self.known: dict[int, bool] = {}

    def allowed(self, a: int, b: int) -> bool:
        key = a << 16 | b
        if (found := self.known.get(key)) is None:
            found = self.known[key] = self.meet(a, b)
        return found

    def meet(self, a: int, b: int) -> bool:
        """Whether no merge across the two tokens' border would come before those that make them."""
        bound = 1 << 30
        while True:
            if self.made.get(a << 16 | b, bound) < bound:
                return False
            # Undo the later of the two tokens' last merges, towards the border.
            if a > b and a in self.parts:
                bound, a = a, self.parts[a][1]
            elif b in self.parts:
                bound, b = b + 1, self.parts[b][0]
            elif a in self.parts:
                bound, a = a, self.parts[a][1]
            else:
                return True


class Transducer:
    """The compiled part of the tokenizer: states, transitions and what they emit."""

    def __init__(self, bpe: wordbpe.WordBpe, most_states: int = MOST_STATES):
        self.library, self.most_states, self.pairs = bpe.library, most_states, Pairs(bpe)
        self.trie: dict[int, int] = {}
        self.inner, self.last, self.leads = [-1], [-1], [False]
        spelled = {int(t): bytes([b]) for b, t in enumerate(bpe.inner)}
        ends = {int(t): bytes([b]) for b, t in enumerate(bpe.last)}
        for token, (a, b) in sorted(self.pairs.parts.items()):
            (ends if b in ends else spelled)[token] = spelled[a] + (ends if b in ends else spelled)[b]
        for tokens, where in ((spelled, self.inner), (ends, self.last)):
            for token, text in tokens.items():
                where[self.node(text)] = token
        self.words: dict[str, int] = {}
        self.forget()

    def node(self, text: bytes) -> int:
        at = 0
        for b in text:
            if (child := self.trie.get(at << 8 | b)) is None:
                child = self.trie[at << 8 | b] = len(self.inner)
                self.leads[at] = True
                self.inner.append(-1)
                self.last.append(-1)
                self.leads.append(False)
            at = child
        return at

    def forget(self) -> None:
        self.keys: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.table = np.full(0, -1, dtype=np.int32)  # next state, and in the low 8 bits the emitted count and 128
        self.state(START)

    def state(self, key: tuple) -> int:
        if (found := self.ids.get(key)) is None:
            found = self.ids[key] = len(self.keys)
            self.keys.append(key)
            if (found + 1) * CLASSES > len(self.table):
                rows = min(max(4096, 2 * found), max(self.most_states, found + 1))
                self.table = np.concatenate([self.table, np.full(rows * CLASSES - len(self.table), -1, dtype=np.int32)])
        return found

    def extended(self, places: tuple, mode: int, b: int) -> tuple[tuple, int]:
        """The state after one more byte of a pre-token, and what it emits."""
        token = ended = None
        kept = []
        for x in places:
            child = self.trie.get((x >> 24) << 8 | b)
            if child is None:
                continue
            before, fewer = x >> 8 & 0xFFFF, (x & 0xFF) - 128
            own, end = self.inner[child], self.last[child]
            if token is None and own >= 0 and (before == NONE or self.pairs.allowed(before, own)):
                token, emitted = own, fewer + 1
            if ended is None and end >= 0 and (before == NONE or self.pairs.allowed(before, end)):
                ended = fewer + 1
            if self.leads[child]:
                kept.append((child << 24 | before << 8, fewer))
        return (mode, ended - emitted, *(x | fewer - emitted + 128 for x, fewer in kept), token << 8 | 128), emitted

    def begun(self, b: int) -> tuple[tuple, int]:
        """The state after the first byte of a pre-token."""
        digit, quote = 0x30 <= b <= 0x39, b == 0x27
        mode = ENDED if digit else QUOTE if quote else LETTER if b >= 0x80 or 0x61 <= b <= 0x7A else MARKS
        return self.extended((NONE << 8 | 128,), mode, b)

    def step(self, key: tuple, b: int | None) -> tuple[tuple, int]:
        """The next state and the emitted count for a byte, or for white space (None)."""
        mode = key[0]
        if b is None:
            return START, key[1]
        if key == START:
            return self.begun(b)
        letter, digit = b >= 0x80 or 0x61 <= b <= 0x7A, 0x30 <= b <= 0x39
        if (mode, b) in ((QUOTE_R, 0x65), (QUOTE_V, 0x65), (QUOTE_L, 0x6C)):
            # The contraction was there after all: count it instead of a mark and a letter.
            first = {QUOTE_R: 0x72, QUOTE_V: 0x76, QUOTE_L: 0x6C}[mode]
            quote, one = self.begun(0x27)
            second, two = self.extended(quote[2:], MARKS, first)
            whole, three = self.extended(second[2:], ENDED, b)
            return whole, one + two + three - (one + quote[1] + self.begun(first)[1])
        if mode == QUOTE and b in b"stmd":
            return self.extended(key[2:], ENDED, b)
        if mode == QUOTE and b in b"rvl":
            after, emitted = self.begun(b)
            return ({0x72: QUOTE_R, 0x76: QUOTE_V, 0x6C: QUOTE_L}[b], *after[1:]), key[1] + emitted
        if mode in (LETTER, QUOTE_R, QUOTE_V, QUOTE_L) and letter:
            return self.extended(key[2:], LETTER, b)
        if mode in (MARKS, QUOTE) and not letter and not digit:
            return self.extended(key[2:], MARKS, b)
        after, emitted = self.begun(b)
        return after, key[1] + emitted

    def compile(self, places: list[int]) -> None:
        """Make the transitions at these places of the arrays."""
        for place in places:
            key, c = self.keys[place // CLASSES], place % CLASSES
            after, emitted = self.step(key, BYTES[c - 1] if c else None)
            target = self.state(after)
            self.table[place] = target << 8 | emitted + 128

    def run(self, data: np.ndarray, first: np.ndarray, last: np.ndarray, entries: list[tuple] | None = None) -> tuple[list[tuple] | None, np.ndarray]:
        """Lanes data[first:last] abreast, from the start or from ``entries``: exit states (of ``entries`` only) and counts."""
        order = np.argsort(first - last, kind="stable")
        at, size = first[order], (last - first)[order]
        counts = np.zeros(len(at), dtype=np.int64)
        states = np.zeros(len(at), dtype=np.int32) if entries is None else np.array([self.state(entries[i]) for i in order.tolist()], dtype=np.int32)
        live = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), side="left")
        for j, m in enumerate(live.tolist()):
            places = states[:m] * np.int64(CLASSES) + CLASS[data[at[:m] + j]]
            after = self.table[places]
            if m and after.min() < 0:
                new = np.unique(places[after < 0])
                if len(self.keys) + len(new) > self.most_states:
                    # Forget all but the lanes' own states.
                    held, own = np.unique(states, return_inverse=True)
                    keys = [self.keys[i] for i in held.tolist()]
                    self.forget()
                    states = np.array([self.state(k) for k in keys], dtype=np.int32)[own]
                    places = states[:m] * np.int64(CLASSES) + CLASS[data[at[:m] + j]]
                    new = np.unique(places[self.table[places] < 0])
                self.compile(new.tolist())
                after = self.table[places]
            counts[:m] += (after & 0xFF) - 128
            states[:m] = after >> 8
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        exits = None if entries is None else [self.keys[i] for i in states[back].tolist()]
        return exits, counts[back]

    def state_maps(self, data: np.ndarray, cuts: np.ndarray) -> list[dict[tuple, tuple[tuple, int]]]:
        """For each piece between ``cuts``: entry state to (exit state, count), closed under what the piece before can end in."""
        first, last = cuts[:-1], cuts[1:]
        maps: list[dict] = [{} for _ in first]
        guesses, _ = self.run(data, np.maximum(first[1:] - WARM, first[0]), first[1:], [START] * (len(first) - 1))
        pending = [(0, START), *enumerate(guesses, 1)]
        while pending:
            at = np.array([k for k, _ in pending])
            exits, counts = self.run(data, first[at], last[at], [key for _, key in pending])
            for (k, key), end, n in zip(pending, exits, counts.tolist(), strict=True):
                maps[k][key] = (end, n)
            reached = {(k + 1, end) for (k, _), end in zip(pending, exits, strict=True) if k + 1 < len(maps)}
            pending = [(k, end) for k, end in sorted(reached) if end not in maps[k]]
        return maps

    def long_count(self, data: np.ndarray, first: int, last: int, piece: int) -> int:
        cuts = np.append(np.arange(first, last, max(piece, (last - first) // 1024)), last)
        return scan(self.state_maps(data, cuts))[-1][START][1]

    def odd_words(self, text: str) -> tuple[str, list[str]]:
        """``text`` with its words for the library blanked, and those words."""
        parts, words, done = [], [], 0
        for m in ODD.finditer(text):
            if m.start() < done:
                continue
            begin = max(done, *(text.rfind(c, done, m.start()) + 1 for c in " \t\n\r\x0b\x0c"))
            end = SPACE.search(text, m.end())
            end = end.start() if end else len(text)
            parts.append(text[done:begin])
            words.append(text[begin:end])
            done = end
        return " ".join([*parts, text[done:]]), words

    def library_counts(self, words: list[str]) -> None:
        new = list(set(words) - self.words.keys())
        if len(self.words) + len(new) > MOST_WORDS:
            self.words, new = {}, list(set(words))
        for k in range(0, len(new), 1000):
            for w, e in zip(new[k : k + 1000], self.library.encode_batch_fast(new[k : k + 1000], add_special_tokens=False), strict=True):
                self.words[w] = len(e.ids)

    def count(self, texts: list[str], lane: int = LANE, piece: int = PIECE) -> np.ndarray:
        """Tokens of each text."""
        extra: list[tuple[int, list[str]]] = []
        plain = []
        for i, t in enumerate(texts):
            if not t.isascii() or "<|" in t or not t.isprintable():
                t, words = self.odd_words(t)
                if words:
                    extra.append((i, words))
            plain.append(t.lower().encode())
        data = np.frombuffer(b"\n".join(plain) + b"\n", dtype=np.uint8)
        sizes = np.fromiter(map(len, plain), dtype=np.int64, count=len(plain))
        docs = np.cumsum(sizes + 1) - sizes - 1
        spaces = np.flatnonzero(IS_SPACE[data])
        cuts = np.unique(np.concatenate([docs, spaces[np.searchsorted(spaces, np.arange(0, len(data), lane))] + 1, [len(data)]]))
        first, last = cuts[:-1], cuts[1:]
        own = np.searchsorted(docs, first, side="right") - 1
        long = last - first > piece + lane
        out = np.zeros(len(texts), dtype=np.int64)
        _, counts = self.run(data, first[~long], last[~long])
        np.add.at(out, own[~long], counts)
        for k in np.flatnonzero(long).tolist():
            out[own[k]] += self.long_count(data, int(first[k]), int(last[k]), piece)
        self.library_counts([w for _, words in extra for w in words])
        for i, words in extra:
            out[i] += sum(map(self.words.__getitem__, words))
        return out


def composed(a: dict, b: dict) -> dict:
    return {entry: (b[end][0], n + b[end][1]) for entry, (end, n) in a.items()}


def scan(maps: list[dict]) -> list[dict]:
    """Inclusive prefix compositions of state maps, by doubling steps."""
    step = 1
    while step < len(maps):
        maps = maps[:step] + [composed(a, b) for a, b in zip(maps, maps[step:], strict=False)]
        step *= 2
    return maps


def count_tokens(df: DataFrame, text: str = "text", *, path: str | None = None, limit: int = LIMIT, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and, for each row, ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    path = path or wordbpe.default_path()
    kept = df.select(*keep).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", n_bytes long, n_tokens long, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(path)
        for batch, texts in common.text_slices(batches, text):
            counts = machine.count(texts)
            sizes = [len(t) if t.isascii() else len(t.encode()) for t in texts]
            columns = [batch.column(k) for k in keep] + [pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array(counts > limit)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_bytes", "n_tokens", "over_limit"])

    return df.select(*dict.fromkeys((*keep, text))).mapInArrow(run, schema)


_machines: dict[str, Transducer] = {}


def _machine(path: str) -> Transducer:
    """One per Python worker, kept between its tasks."""
    if path not in _machines:
        _machines[path] = Transducer(wordbpe.WordBpe(path))
    return _machines[path]


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(common.documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_tokens", "over_limit")
