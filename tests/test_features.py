"""Features and predictions against plain versions."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from inkwell.operators import ml, vectors
from inkwell.plans import models
from inkwell.sources import papers
from inkwell.sources.tables import table

from .conftest import SF


def murmur3(data: bytes, seed: int = 42) -> int:
    """MurmurHash3 of 32 bits, signed, with the tail taken byte by byte as signed numbers."""
    mask = 0xFFFFFFFF
    turn = lambda x, n: ((x << n) | (x >> (32 - n))) & mask
    h = seed
    whole = len(data) // 4 * 4
    words = [int.from_bytes(data[k : k + 4], "little") for k in range(0, whole, 4)]
    for k in words:
        k = turn(k * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
        h = (turn(h ^ k, 13) * 5 + 0xE6546B64) & mask
    k = 0
    for i, b in enumerate(data[whole:]):
        k ^= b << (8 * i)
    if data[whole:]:
        h ^= turn(k * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
    h ^= len(data)
    h = (h ^ (h >> 16)) * 0x85EBCA6B & mask
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_hashed_bags_equal_plain_ones(spark):
    texts = [(1, "The cat, the cat-flap and 3D_x!"), (2, ""), (3, "é日本 É日本 a bc"), (4, "x")]
    rows = vectors.bag_of_words(spark.createDataFrame(texts, "doc_id int, text string"), "text").collect()
    for r in rows:
        counts = {}
        for t in re.findall(r"\b[\w-]{2,}\b", r.text.lower()):
            at = murmur3(t.encode()) % vectors.BOW_BUCKETS
            counts[at] = counts.get(at, 0) + 1
        norm = np.sqrt(sum(n * n for n in counts.values()))
        assert dict(zip(r.bow.indices.tolist(), r.bow.values.tolist(), strict=True)) == pytest.approx({k: n / norm for k, n in counts.items()})


def test_scores_are_those_of_the_weights(spark):
    data = ml.stratified_split(models.vector_data(spark, SF), "label", "vec_id")
    model = LogisticRegression(regParam=0.01).fit(data.where("not held_out"))
    w, b = model.coefficients.toArray(), model.intercept
    held = {r.vec_id: 1 / (1 + np.exp(-(r.features.toArray() @ w + b))) for r in data.where("held_out").select("vec_id", "features").collect()}
    rows = models.classify_with_logreg(spark, SF).collect()
    assert {r.vec_id: r.score for r in rows} == pytest.approx(held, abs=1e-6) and all(r.predicted == (held[r.vec_id] >= 0.5) for r in rows)


def test_every_row_has_a_class_by_the_kernel(spark):
    rows = models.classify_with_kernel(spark, SF).collect()
    assert len(rows) == table(spark, SF, "embeddings").count() and all(r.predicted == (r.score >= 0.5) for r in rows if abs(r.score - 0.5) > 1e-6)


def test_binary_vectors(spark):
    x = np.arange(12, dtype=np.float32).reshape(4, 3) / 7
    x[1] = np.frombuffer(b"\n  \n" * 3, dtype="<f4")  # bytes of floats that look like line ends and spaces
    words = ["a", "é日", "long-word", "z"]
    whole = papers.as_binary_vectors(words, x)
    bare = b"4 3\n" + b"".join(w.encode() + b" " + v.astype("<f4").tobytes() for w, v in zip(words, x, strict=True))
    files = spark.createDataFrame([(1, whole), (2, bare), (3, whole[:-8]), (4, b""), (5, b"no head"), (6, None), (7, b"0 3\n")], "id int, content binary").repartition(3)
    for i, n in ((1, 4), (2, 4), (3, 3), (4, 0), (5, 0), (6, 0), (7, 0)):
        rows = papers.binary_vectors(files.where(F.col("id") == i)).orderBy("idx").collect()
        assert [(r.word, r.idx) for r in rows] == list(zip(words, range(n), strict=False))
        assert all(np.array(r.vec, dtype=np.float32).tobytes() == x[r.idx].tobytes() for r in rows)
