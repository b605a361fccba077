"""Quality rules and a calibrated n-gram classifier, scored in Arrow batches.

Features are hashed 4-byte n-grams, words and word pairs, each block a
distribution over its buckets. A logistic regression is trained on a bounded,
documented sample of labelled rows (``SAMPLE`` documents with the lowest hash
of their id), its margin is calibrated by Platt scaling on rows held out from
the training, and documents below ``THRESHOLD`` are rejected, as are those
that fail the fixed rules. The rules' counts and the scores cover whole texts
and all rows; a batch is worked on in slices of bounded bytes, so memory does
not depend on text sizes beyond the longest text.

Defined results: a null or empty text has no words and fails the rules;
labels that are null, without a document or of one class only train nothing,
and then the rules decide alone; repeated rows get equal results; an empty
table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import common

SAMPLE = 4000
THRESHOLD = 0.5
BITS = 16
#: Texts that training works on at a time, 256 at most.
PIECE = 100
LEAST_WORDS = 10
MOST_REPEATED = 20
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
IS_SPACE = np.isin(np.arange(256), np.frombuffer(SPACES, dtype=np.uint8))
ODD = np.uint64(0x9E3779B97F4A7C15)
RULES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


class Slice(NamedTuple):
    """Texts of a batch as one buffer, each followed by a line end."""

    data: np.ndarray
    first: np.ndarray  # of each text's bytes
    last: np.ndarray  # beyond them
    word_hash: np.ndarray  # of all words, in order
    word_doc: np.ndarray
    word_at: np.ndarray  # the number of each text's first word, and one more

    @classmethod
    def of(cls, texts: list[bytes]) -> Slice:
        data = np.frombuffer(b"\n".join(texts) + b"\n\n\n\n", dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        first = np.cumsum(sizes + 1) - sizes - 1
        black = ~IS_SPACE[data]
        edge = np.diff(black.astype(np.int8), prepend=np.int8(0))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # A word's hash: its bytes weighted by powers of an odd number, then mixed.
        length = end - begin
        at = np.flatnonzero(black)
        place = at - np.repeat(begin, length)
        powers = ODD ** np.arange(max(1, int(length.max(initial=1))), dtype=np.uint64)
        summed = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * powers[place], np.cumsum(length) - length) if len(at) else np.zeros(0, np.uint64)
        mixed = mix(summed + length.astype(np.uint64))
        word_doc = np.searchsorted(first, begin, side="right") - 1
        return cls(data, first, first + sizes, mixed, word_doc, np.searchsorted(word_doc, np.arange(len(texts) + 1)))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def windows(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words."""
    out = np.zeros(max(0, len(word_hash) - n + 1), dtype=np.uint64)
    for k in range(n):
        out = out * ODD + word_hash[k : k + len(out)]
    return mix(out)


def repeated_words(s: Slice, n: int = 5) -> np.ndarray:
    """Of each text: words in n-word windows that it holds twice or more."""
    texts = len(s.first)
    if len(s.word_doc) < n:
        return np.zeros(texts, dtype=np.int64)
    own = s.word_doc[: len(s.word_doc) - n + 1]
    inside = own == s.word_doc[n - 1 :]
    hashes = mix(windows(s.word_hash, n) + own.astype(np.uint64) * ODD)
    ordered = np.sort(hashes[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(texts, dtype=np.int64)
    where = np.searchsorted(twice, hashes)
    found = inside & (twice[np.minimum(where, len(twice) - 1)] == hashes)
    cover = np.zeros(len(s.word_doc) + 1, dtype=np.int32)
    at = np.flatnonzero(found)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + n, -1)
    covered = np.cumsum(cover[:-1]) > 0
    return np.bincount(s.word_doc[covered], minlength=texts)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def rule_counts(s: Slice, texts: list[str], data: list[bytes]) -> list[list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    n_words = np.diff(s.word_at).tolist()
    spaces = [len(d) - len(d.translate(None, SPACES)) for d in data]
    return [
        n_words,
        [len(t) - k for t, k in zip(texts, spaces, strict=True)],
        [len(d) - len(d.translate(None, SYMBOLS)) for d in data],
        [duplicate_lines(t) for t in texts],
        repeated_words(s).tolist(),
    ]


def buckets(s: Slice) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each block of features: a bucket for each occurrence, and its text."""
    shift = np.uint64(64 - BITS)
    d = s.data.astype(np.uint32)
    grams = d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16) | d[3:] << np.uint32(24)
    chars = (grams * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    size = np.maximum(s.last - s.first - 3, 0)
    at = np.repeat(s.first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    words = ((s.word_hash * ODD) >> shift).astype(np.int64)
    together = s.word_doc[:-1] == s.word_doc[1:]
    pairs = ((windows(s.word_hash, 2) * ODD) >> shift).astype(np.int64)
    return [
        (chars[at].astype(np.int64), np.repeat(np.arange(len(size)), size)),
        (words, s.word_doc),
        (pairs[together], s.word_doc[:-1][together]),
    ]


class Model(NamedTuple):
    weights: np.ndarray  # a row for each block of features
    bias: float
    slope: float  # Platt scaling of the margin
    shift: float

    def margins(self, s: Slice) -> np.ndarray:
        out = np.full(len(s.first), self.bias)
        for w, (bucket, doc) in zip(self.weights, buckets(s), strict=True):
            n = np.bincount(doc, minlength=len(out))
            out += np.bincount(doc, weights=w[bucket], minlength=len(out)) / np.maximum(n, 1)
        return out

    def probabilities(self, s: Slice) -> np.ndarray:
        return sigmoid(self.slope * self.margins(s) + self.shift)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(texts: list[str], good: np.ndarray, steps: int = 150, rate: float = 0.5, decay: float = 1e-5, held_out: float = 0.2) -> Model | None:
    """Logistic regression by Adam over all rows, then Platt scaling on held-out rows."""
    if len(texts) < 20 or len(np.unique(good)) < 2:
        return None
    size, every = 1 << BITS, np.arange(len(texts))
    fit = every % round(1 / held_out) != 0
    # Pieces small enough that what a step makes of one stays in the cache, and is soon let go.
    pieces = [features_of(texts, own[k : k + PIECE]) for own in (every[fit], every[~fit]) for k in range(0, len(own), PIECE)]
    trained = [p for p in pieces if fit[p.texts[0]]]
    weight = np.where(good == 1, 0.5 / max(1, good[fit].sum()), 0.5 / max(1, (1 - good[fit]).sum()))
    w, b = np.zeros(3 * size, dtype=np.float32), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        total, gb = np.zeros(len(w)), 0.0
        for p in trained:
            error = (sigmoid(p.margins(w) + b) - good[p.texts]) * weight[p.texts]
            total += np.bincount(p.column, weights=error[p.row] * p.value, minlength=len(w))
            gb += error.sum()
        g = total.astype(np.float32) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        scale = np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w -= (rate * scale * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        b -= rate * scale * mb / (np.sqrt(vb) + 1e-8)
    held = [p for p in pieces if not fit[p.texts[0]]]
    margin = np.concatenate([p.margins(w) + b for p in held])
    slope, shift = platt(margin, good[np.concatenate([p.texts for p in held])])
    return Model(w.reshape(3, size), float(b), slope, shift)


class Features(NamedTuple):
    """Sparse features of some texts: the place of the text among them, the column and the value of each."""

    texts: np.ndarray
    row: np.ndarray
    column: np.ndarray
    value: np.ndarray

    def margins(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.column] * self.value, minlength=len(self.texts))


def features_of(texts: list[str], own: np.ndarray) -> Features:
    """Of each block, the share of each bucket among a text's features."""
    s, size = Slice.of([texts[i].encode() for i in own.tolist()]), 1 << BITS
    rows, columns, values = [], [], []
    for block, (bucket, doc) in enumerate(buckets(s)):
        key, n = np.unique(doc.astype(np.int64) * size + bucket, return_counts=True)
        row = key // size
        rows.append(row.astype(np.uint8))
        columns.append((key % size + block * size).astype(np.int32))
        values.append((n / np.bincount(doc, minlength=len(own))[row]).astype(np.float32))
    return Features(own, *map(np.concatenate, (rows, columns, values)))


def platt(margin: np.ndarray, good: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift that calibrate margins, by Newton's method with Platt's smoothed targets."""
    p, n = good.sum(), len(good) - good.sum()
    if not p or not n:
        return 1.0, 0.0
    target = np.where(good == 1, (p + 1) / (p + 2), 1 / (n + 2))
    unit = margin.std() or 1.0
    x = np.stack([margin / unit, np.ones_like(margin)])
    theta = np.array([1.0, 0.0])
    for _ in range(steps):
        q = sigmoid(theta @ x)
        grad = x @ (q - target) + 1e-6 * theta
        hess = (x * (q * (1 - q))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta -= step * min(1.0, 2.0 / np.abs(step).max())
    return float(theta[0] / unit), float(theta[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Texts and quality of at most ``sample`` labelled documents."""
    picked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("__good"))
    picked = picked.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(sample).withColumnRenamed("doc_id", "__id")
    # At most ``sample`` rows: a bounded broadcast.
    joined = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("__id"))
    rows = joined.groupBy("doc_id", "__good").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"] or "" for r in rows], np.array([r["__good"] for r in rows], dtype=np.int64)


def score(docs: DataFrame, model: Model | None, text: str = "text", *, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """``keep``, the rules' counts, base_failed, kept and quality_prob (null without a model)."""
    kind = docs.select(*keep).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind) + f", {RULES}, base_failed boolean, kept boolean, quality_prob double"
    # Two megabytes at most, whatever the input.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, texts in common.text_slices(batches, text):
            data = [t.encode() for t in texts]
            s = Slice.of(data)
            counts = rule_counts(s, texts, data)
            failed = np.array([n < LEAST_WORDS or 100 * k > MOST_REPEATED * n for n, k in zip(counts[0], counts[4], strict=True)], dtype=bool)
            p = model.probabilities(s) if model else None
            kept = ~failed & (p >= threshold if model else True)
            columns = [batch.column(k) for k in keep] + [pa.array(c, pa.int64()) for c in counts]
            columns += [pa.array(failed), pa.array(kept), pa.array(p, pa.float64()) if model else pa.nulls(len(texts), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *(c.split()[0] for c in RULES.split(", ")), "base_failed", "kept", "quality_prob"])

    return docs.select(*dict.fromkeys((*keep, text))).mapInArrow(run, schema)


def kept_documents(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that pass the rules and the model, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_slices(batches, text):
            s = Slice.of([t.encode() for t in texts])
            n_words, repeated = np.diff(s.word_at), repeated_words(s)
            kept = ~((n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n_words))
            if shared.value:
                kept &= shared.value.probabilities(s) >= threshold
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


def quality_model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    return train(*labelled_sample(docs, labels, sample))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return score(docs, quality_model(docs, common.labels(spark, sf_dir)))
