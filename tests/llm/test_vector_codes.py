"""Vector codes against plain rounds over all pairs."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.llm import queries, vector_codes

from ..conftest import SF


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """key, code, error, label_error of (key, vector, label), and the codebooks' digest, by plain whole numbers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dim]
    cuts = [a.tolist() for a in np.array_split(np.arange(dim), parts)]
    whole = [[tuple(math.floor(scale * r[1][i]) for i in at) for at in cuts] for r in kept]
    books = [[w[p] for w in whole[:entries]] for p in range(parts)]
    find = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for w in whole:
                own[find(p, w[p])[1]].append(w[p])
            for e, got in own.items():
                books[p][e] = tuple(sum(c) // len(got) for c in zip(*got, strict=True))
    found = [[find(p, w[p]) for p in range(parts)] for w in whole]
    codes = ["".join(f"{i:02x}" for _, i in f) for f in found]
    errors = [sum(d for d, _ in f) for f in found]
    by = defaultdict(int)
    for r, e in zip(kept, errors, strict=True):
        by[r[2]] += e
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted((str(r[0]), c, e, by[r[2]]) for r, c, e in zip(kept, codes, errors, strict=True)), digest


def coded(df, **settings):
    made, books = vector_codes.vector_codes(df, **settings)
    return sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in made.collect()), books and books.sha256()


@pytest.mark.parametrize("span", [3, 1 << 12, 1 << 27])
def test_searches_equal_all_distances(span):
    rng = np.random.default_rng(span)
    entries = rng.integers(-span, span, (256, 16))
    entries[100:120] = entries[7]  # more equal entries than a leaf has
    parts = np.concatenate([rng.integers(-span, span, (500, 16)), entries])
    books = vector_codes.Codebooks([entries])
    ((found, distance),) = vector_codes.assigned(books.trees(), [parts])
    d = ((parts[:, None, :] - entries) ** 2).sum(axis=2)
    assert (found == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()


def test_branches_are_cut():
    rng = np.random.default_rng(0)
    entries = np.sort(rng.integers(0, 1 << 20, (256, 2)), axis=0)
    seen, tree = [], vector_codes.Node.of(entries.astype(float), np.arange(256))

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(self.shape[0] * other.shape[1])
            return np.asarray(self) @ np.asarray(other)

    parts = rng.integers(0, 1 << 20, (1000, 2)).astype(float).view(Counted)
    vector_codes.nearest(entries.astype(float), tree, parts)
    assert sum(seen) < 0.35 * 256 * 1000


def test_rounds(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k), rng.normal(size=8).round(3).tolist(), int(k) % 3 if k % 5 else None) for k in rng.permutation(400)]
    rows += [(7, [0.5] * 8, 1), (7, [0.25] * 8, 1), (7, [0.25] * 8, 1), (None, [-0.001] * 8, 2), (900, None, 1), (901, [0.1, None] * 4, 1), (902, [math.nan] * 8, 1), (903, [math.inf] + [0.0] * 7, 1), (904, [1.0] * 4, 0), (905, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(1) for c in ("key", "v", "code", "error", "own")}).repartition(3)
    assert coded(df, entries=16) == plain(rows, entries=16)
    assert coded(df) == plain(rows)
    floats = df.withColumn("embedding", F.col("embedding").cast("array<float>"))
    exact = [(k, None if v is None else [x if x is None else float(np.float32(x)) for x in v], label) for k, v, label in rows]
    assert coded(floats, entries=8, parts=3, rounds=2) == plain(exact, entries=8, parts=3, rounds=2)


def test_odd_tables(spark):
    shape = "vec_id long, embedding array<double>, label int"
    assert coded(spark.createDataFrame([], shape)) == ([], None)
    assert coded(spark.createDataFrame([(1, None, 1), (2, [None], 1)], shape)) == ([], None)
    few = [(3, [1.0, 2.0, 3.0, 4.0, 5.0], 1), (1, [1.0, 2.0, 3.0, 4.0, 5.0], 1)]
    assert coded(spark.createDataFrame(few, shape)) == plain(few)
    assert coded(spark.createDataFrame([(1, [], 1), (2, [], None)], shape))[0] == [("1", "00000000", 0, 0), ("2", "00000000", 0, 0)]
    huge = [(1, [1e300, 0.0, 0.0, 0.0], 1), (2, [-1e300, 0.0, 0.0, 0.0], 1), (3, [1.0, 2.0, 3.0, 4.0], 1)]
    assert [r[1:3] for r in coded(spark.createDataFrame(huge, shape))[0]] == [("00" * 4, 0), ("01000000", 0), ("02020202", 0)]
    with pytest.raises(ValueError, match="256"):
        vector_codes.vector_codes(spark.createDataFrame(few, shape), entries=257)


def test_many_labels_join_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 1)
    rows = [(k, [float(k % 17), float(k % 5)], k % 4 if k % 7 else None) for k in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert coded(df, entries=5, parts=2) == plain(rows, entries=5, parts=2)


def test_codes_stand_for_near_vectors(spark):
    rows = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/embeddings.parquet")
    made, books = vector_codes.vector_codes(rows)
    of = {r.vec_id: np.array(r.embedding) for r in rows.collect()}
    for r in made.collect():
        off = np.floor(of[r.vec_id] * 1024) - vector_codes.decoded(r.code, books) * 1024
        assert (off * off).sum() == r.error


def test_the_query_equals_its_sql(spark):
    rows = {tuple(r) for r in vector_codes.op13_vector_codes(spark, SF).collect()}
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    assert rows == set(con.execute(queries.oracle_sql()["op13_vector_codes"]).fetchall()) and len(rows) > 20
