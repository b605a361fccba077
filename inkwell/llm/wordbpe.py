"""Token ids of a byte-level BPE with word ends, for whole batches of distinct words.

The library's tokenizer spends most of its time on words that it has met
before. White space always ends a pre-token in this vocabulary, so a text's
ids are the ids of its white-space chunks in order; each distinct chunk is
encoded once, by merging all distinct words of a batch in lockstep in numpy.
Chunks beyond printable ASCII and Latin-1 letters, with a special string, or
with a very long word go to the library itself, so the ids are always its own.
"""

from __future__ import annotations

import gc
import json
import re
from functools import lru_cache

import numpy as np

NONE = np.int32(2**31 - 1)
#: Longer words are encoded by the library.
LONGEST = 48
#: Chunks kept by one Python worker (about 100 MB); at that number it starts afresh.
MOST_CHUNKS = 1_000_000

# Of this restricted alphabet the vocabulary's split pattern needs no Unicode classes.
PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
SPLIT = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


class WordBpe:
    def __init__(self, path: str, most_chunks: int = MOST_CHUNKS):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, self.end = model["vocab"], model["end_of_word_suffix"]
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], dtype=np.uint32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int32)
        self.last = np.array([vocab[s + self.end] for s in symbols], dtype=np.int32)
        self.library = Tokenizer.from_file(path)
        self.most_chunks = most_chunks
        self.chunks: dict[bytes, bytes] = {}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge ranks of symbol pairs; NONE where there is no merge or no symbol."""
        key = (a.astype(np.int64) << 16 | b).astype(np.uint32)
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == key), self.ranks[at], NONE).astype(np.int32)

    def merged(self, raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ids of words of about one length (bytes, a row each); -1 after the last."""
        n, width = raw.shape
        place = np.arange(width)
        symbols = np.where(place < sizes[:, None], self.inner[raw], -1).astype(np.int32)
        rows = np.arange(n)
        symbols[rows, sizes - 1] = self.last[raw[rows, sizes - 1]]
        done = np.full((n, width), -1, dtype=np.int32)
        ranks = np.full((n, width), NONE, dtype=np.int32)
        ranks[:, :-1] = self.rank(symbols[:, :-1], symbols[:, 1:])
        live = rows
        while len(live):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(live)), at]
            ended = best == NONE
            if ended.any():
                done[live[ended]] = symbols[ended]
                on = ~ended
                live, symbols, ranks, at, best = live[on], symbols[on], ranks[on], at[on], best[on]
                if not len(live):
                    break
            own = np.arange(len(live))
            shifted = np.minimum(place + (place > at[:, None]), width - 1)
            symbols = np.take_along_axis(symbols, shifted, axis=1)
            symbols[:, -1] = -1
            symbols[own, at] = self.made[best]
            ranks = np.take_along_axis(ranks, np.minimum(place + (place >= at[:, None]), width - 1), axis=1)
            ranks[:, -1] = NONE
            ranks[own, at] = self.rank(symbols[own, at], symbols[own, np.minimum(at + 1, width - 1)])
            before = np.maximum(at - 1, 0)
            ranks[own, before] = np.where(at > 0, self.rank(symbols[own, before], symbols[own, at]), ranks[own, before])
        return done

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens in one array, and where each begins in it (one more than words)."""
        data = "".join(words).encode()
        sizes = np.fromiter((len(w) if w.isascii() else len(w.encode()) for w in words), dtype=np.int64, count=len(words))
        starts = np.cumsum(sizes) - sizes
        raw = np.frombuffer(data + bytes(LONGEST + 1), dtype=np.uint8)
        width = np.where(sizes > 8, (sizes + 3) // 4 * 4, sizes)
        counts = np.zeros(len(words), dtype=np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for w in np.unique(width).tolist():
            own = np.flatnonzero(width == w)
            if w > LONGEST:
                for i in own.tolist():
                    ids = np.array(self.library.encode(words[i], add_special_tokens=False).ids, dtype=np.int32)
                    counts[i] = len(ids)
                    parts.append((np.array([i]), ids[None, :]))
                continue
            for k in range(0, len(own), 20_000):
                at = own[k : k + 20_000]
                ids = self.merged(raw[starts[at][:, None] + np.arange(w)], sizes[at])
                counts[at] = (ids >= 0).sum(axis=1)
                parts.append((at, ids))
        begins = np.concatenate([[0], np.cumsum(counts)])
        flat = np.empty(begins[-1], dtype="<u4")
        for at, ids in parts:
            filled = ids >= 0
            flat[(begins[at][:, None] + np.cumsum(filled, axis=1) - 1)[filled]] = ids[filled]
        return flat, begins

    def learn(self, chunks: set[bytes]) -> None:
        """Encode chunks that are not yet known."""
        found = b"\n".join(chunks).decode().split("\n") if chunks else []
        plain = [c for c in found if PLAIN.fullmatch(c) and "<|" not in c]
        other = [] if len(plain) == len(found) else [c for c in found if not PLAIN.fullmatch(c) or "<|" in c]
        if plain:
            text = "\n".join(plain)
            parts = SPLIT.findall(text.lower() + "\n")
            number = {w: i for i, w in enumerate(dict.fromkeys(parts))}
            at = np.fromiter(map(number.__getitem__, parts), dtype=np.int64, count=len(parts))
            line = number["\n"]
            flat, begins = self.words(list(number))
            sizes = np.where(at == line, 0, begins[at + 1] - begins[at])
            ends = np.cumsum(sizes)
            source = np.repeat(begins[at] - (ends - sizes), sizes) + np.arange(ends[-1])
            data = flat[source].tobytes()
            cuts = (ends[at == line] * 4).tolist()
            self.chunks.update(zip(text.encode().split(b"\n"), [data[a:b] for a, b in zip([0, *cuts], cuts, strict=False)], strict=True))
        for k in range(0, len(other), 1000):
            part = other[k : k + 1000]
            for s, e in zip(part, self.library.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.chunks[s.encode()] = np.array(e.ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as little-endian unsigned 32-bit numbers."""
        split = [t.encode().split() for t in texts]
        found = set().union(*split)
        if new := found - self.chunks.keys():
            if len(self.chunks) + len(new) > self.most_chunks:
                self.chunks.clear()
                new = found
            self.learn(new)
        get = self.chunks.__getitem__
        return [b"".join(map(get, s)) for s in split]


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One per Python worker, kept between its tasks.

    Lists of words have no cycles, so the worker looks for cycles less often.
    """
    made = WordBpe(path)
    gc.freeze()
    gc.set_threshold(100_000, 50, 1000)
    return made


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
