"""Neighbour searches, outlier factors and votes against all distances."""

from __future__ import annotations

import numpy as np
import pytest

from inkwell.operators import ml, neighbours


def plain(x, ids, k, p, queries=None, own=None):
    """The k nearest ids of each query, by distance, then id."""
    queries, own = (x, ids) if queries is None else (queries, own)
    out = {}
    for q, me in zip(queries, own, strict=True):
        d = (np.abs(x - q) ** p).sum(axis=1)
        d = np.sqrt(d) if p == 2 else d
        order = [i for i in np.lexsort((ids, d)) if ids[i] != me][:k]
        out[me] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def frame(spark, x, ids, y=None):
    y = np.zeros(len(ids), dtype=int) if y is None else y
    return spark.createDataFrame([(int(i), v.tolist(), int(c)) for i, v, c in zip(ids, x, y, strict=True)], "__id long, v array<double>, y long").repartition(3)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(8, 6))[rng.integers(0, 8, 900)] * 8 + rng.normal(size=(900, 6))
    x[300:360] = x[7]  # more equal rows than neighbours are asked for
    x[600:] = rng.normal(size=(300, 6)) * 8  # no clusters
    return x, rng.permutation(5000)[:900]


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("cell_rows", [40, 5000])
def test_exact_searches_equal_all_distances(spark, points, monkeypatch, p, cell_rows):
    monkeypatch.setattr(neighbours, "PART_ROWS", 70)
    x, ids = points
    rows = frame(spark, x, ids)
    index = neighbours.CellIndex.build(rows, p, cell_rows)
    assert len(index.centers) == -(-900 // cell_rows) and index.counts.sum() == 900
    found = {r["__id"]: [(n.i, n.d) for n in r.near] for r in index.nearest(rows, 12, apart=0).collect()}
    expected = plain(x, ids, 12, p)
    assert {k: [i for i, _ in v] for k, v in found.items()} == {k: [i for i, _ in v] for k, v in expected.items()}
    assert all(np.allclose([d for _, d in v], [d for _, d in expected[k]]) for k, v in found.items())


def test_other_queries_and_few_rows(spark):
    rng = np.random.default_rng(5)
    x, ids, asked = rng.normal(size=(7, 3)), np.arange(7), rng.normal(size=(4, 3))
    index = neighbours.CellIndex.build(frame(spark, x, ids))
    found = {r["__id"]: [n.i for n in r.near] for r in index.nearest(frame(spark, asked, np.arange(4)), 20).collect()}
    assert found == {k: [i for i, _ in v] for k, v in plain(x, ids, 20, 2, asked, np.arange(4) + 100).items() for k in [k - 100]}
    assert neighbours.CellIndex.build(frame(spark, x[:0], ids[:0])) is None
    assert index.nearest(frame(spark, asked[:0], ids[:0]), 3).count() == 0
    alone = frame(spark, x[:1], ids[:1])
    assert neighbours.CellIndex.build(alone).nearest(alone, 3, apart=0).count() == 0


def test_recall_of_approximate_searches(spark, points):
    x, ids = points
    rows = frame(spark, x, ids)
    index = neighbours.CellIndex.build(rows, cell_rows=40)
    expected = plain(x, ids, 10, 2)
    found = {r["__id"]: {n.i for n in r.near} for r in index.nearest(rows, 10, exact=False, probes=8, apart=0).collect()}
    assert np.mean([len(found[k] & {i for i, _ in v}) / 10 for k, v in expected.items()]) >= 0.9


def test_groups_of_ids_stay_apart(spark, points):
    x, _ = points
    ids = (np.arange(900) % 4 << 20) + np.arange(900)
    rows = frame(spark, x, ids)
    index = neighbours.CellIndex.build(rows, cell_rows=100)
    found = {r["__id"]: [n.i for n in r.near] for r in index.nearest(rows, 6, apart=20).collect()}
    for group in range(4):
        own = ids >> 20 == group
        expected = plain(x[~own], ids[~own], 6, 2, x[own], ids[own])
        assert {k: [i for i, _ in v] for k, v in expected.items()} == {k: found[k] for k in expected}


def test_far_cells_are_not_visited(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(100, 4)) + 1000 * c for c in range(10)])
    rows = frame(spark, x, np.arange(1000))
    index = neighbours.CellIndex.build(rows, cell_rows=100)
    first = rows.selectExpr("__id", "v", "10D as reach")
    assert index.visits(first, 5, 1).selectExpr("max(size(cells))").first()[0] <= 3


def test_outlier_factors_through_cells(spark, points):
    x, ids = points
    x = x[np.r_[0:300, 360:900]]
    rows = frame(spark, x, np.arange(len(x))).drop("y")
    found = {r["__id"]: r["lof"] for r in neighbours.local_outlier_factors(rows, cell_rows=60).collect()}
    d = np.linalg.norm(x[:, None] - x, axis=2)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1)[:, :20]
    own = np.take_along_axis(d, near, axis=1)
    density = 1 / (np.maximum(own, own[near, -1]).mean(axis=1) + 1e-10)
    assert found == pytest.approx(dict(enumerate(density[near].mean(axis=1) / density)))
    assert neighbours.local_outlier_factors(rows.limit(0)).count() == 0


@pytest.mark.parametrize("weights", ["uniform", "distance"])
@pytest.mark.parametrize("p", [1, 2])
def test_classifier(spark, points, weights, p):
    x, ids = points
    y = ids % 3
    df = ml.features(spark.createDataFrame([(int(i), v.tolist(), int(c)) for i, v, c in zip(ids, x, y, strict=True)], "id int, v array<double>, label int").repartition(3), ["v"])
    training, asked = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    model = neighbours.NearestNeighboursClassifier(k=7, weights=weights, p=p).fit(training)
    rows = model.transform(asked).collect()
    t = ids % 4 != 0
    assert len(rows) == (~t).sum()
    for r in rows:
        d = (np.abs(x[t] - np.array(r.v.toArray())) ** p).sum(axis=1) ** (1 / p)
        near = np.argsort(d, kind="stable")[:7]
        w = np.ones(7) if weights == "uniform" else (d[near] == 0).astype(float) if (d[near] == 0).any() else 1 / d[near]
        if len(set(np.sort(d)[6:8])) == 2:  # else any of the equal rows may vote
            share = np.bincount(y[t][near], weights=w, minlength=3) / w.sum()
            assert r.probability.toArray() == pytest.approx(share)
            assert share[int(r.prediction)] == pytest.approx(share.max())
    assert model.transform(asked.limit(0)).count() == 0
