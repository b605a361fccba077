"""Searches over classifiers against plain loops, and kernel features against the kernel."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from inkwell.operators import kernels, linear, ml, search


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(240, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=240) * 0.7 > 0.3).astype(int)
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y, strict=True))], "id int, v array<double>, label int")
    return ml.features(df.repartition(3), ["v"])


@pytest.fixture(scope="module")
def rings(spark):
    """Two classes that no plane parts."""
    rng = np.random.default_rng(1)
    angle, y = rng.uniform(0, 2 * np.pi, 300), np.arange(300) % 2
    x = np.stack([np.cos(angle), np.sin(angle)], axis=1) * (1 + 2 * y)[:, None] + rng.normal(size=(300, 2)) * 0.2
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y, strict=True))], "id int, v array<double>, label int")
    return ml.features(df.repartition(2), ["v"])


def plain_fit(x, y, p, steps=20_000):
    """One problem by plain proximal steps."""
    x, sign, n = np.column_stack([np.ones(len(x)), x]), np.where(y == 1, 1.0, -1.0), len(y)
    weight = np.where(y == 1, n / (2 * max(1, (y == 1).sum())), n / (2 * max(1, (y == 0).sum()))) / n if p.balanced else np.full(n, 1 / n)
    loss = linear.LOSSES[p.loss]
    step = 1 / (loss.curvature * np.linalg.eigvalsh((x * weight[:, None]).T @ x).max() + p.l2)
    w, free = np.zeros(x.shape[1]), np.append(0.0, np.ones(x.shape[1] - 1))
    for _ in range(steps):
        to = w - step * (x.T @ (loss.slope(sign * (x @ w)) * sign * weight) + p.l2 * w * free)
        new = np.sign(to) * np.maximum(np.abs(to) - step * p.l1 * free, 0)
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w


def table_of(rows):
    got = rows.data.select("key", "x", "label", "fold").orderBy("key").collect()
    return np.array([r.x for r in got]), np.array([r.label for r in got]), np.array([r.fold for r in got])


def f1(y, margin):
    p = margin >= 0
    return 2 * (p & (y == 1)).sum() / max(1, (p.sum() + (y == 1).sum()))


def test_bulk_training_equals_one_by_one(data):
    rows = search.Rows(data, "id")
    problems = [linear.Problem("x", loss, l1, l2, balanced, fold) for loss in linear.LOSSES for l1, l2 in ((0.0, 0.05), (0.02, 0.0), (0.01, 0.01)) for balanced, fold in ((True, 0), (False, None))]
    bulk = linear.Bulk(rows.data, problems)
    weights = bulk.fit(1500, 1e-8)
    x, y, fold = table_of(rows)
    found = linear.f1_of(bulk.confusions(weights))
    for p, w, score in zip(problems, weights, found, strict=True):
        t = (fold != linear.HELD) & (fold != (linear.HELD if p.fold is None else p.fold))
        assert w == pytest.approx(plain_fit(x[t], y[t], p), abs=2e-3), p
        out = fold == (linear.HELD if p.fold is None else p.fold)
        assert score == pytest.approx(f1(y[out], w[0] + x[out] @ w[1:]))


def test_linear_and_neighbour_search_find_the_plain_loops_winner(data):
    n = {"LogisticRegression": 6, "SGDClassifier": 6, "LinearSVC": 4, "KNeighborsClassifier": 8}
    found = search.random_search(data, "id", list(n), n=n, steps=1500)
    rows = search.Rows(data, "id")
    x, y, fold = table_of(rows)
    plain = []
    for family, count in n.items():
        drawn = search.draws(search.FAMILIES[family].spaces, count)

        def margins(setting, k, family=family):
            t, out = (fold != linear.HELD) & (fold != k), fold == k
            if family != "KNeighborsClassifier":
                w = plain_fit(x[t], y[t], search.linear_problem(family, setting, int(t.sum()), None))
                return y[out], w[0] + x[out] @ w[1:]
            d = (np.abs(x[out][:, None] - x[t]) ** setting["p"]).sum(axis=2) ** (1 / setting["p"])
            near = np.argsort(d, axis=1)[:, : setting["n_neighbors"]]
            w = 1 / np.take_along_axis(d, near, axis=1) if setting["weights"] == "distance" else np.ones(near.shape)
            return y[out], (w * y[t][near]).sum(axis=1) / w.sum(axis=1) - 0.5 + 1e-12

        cv = [np.mean([f1(*margins(s, k)) for k in rows.folds]) for s in drawn]
        best = int(np.argmax(cv))
        test = f1(*margins(drawn[best], linear.HELD))
        plain.append((family, drawn[best], cv[best], test, 0.7 * test + 0.3 * cv[best] - 2 * max(0, cv[best] - test - 0.05)))
    plain.sort(key=lambda s: -s[-1])
    print([(s.family, s.settings, s.cv, s.test) for s in found], plain)
    assert [(s.family, s.cv, s.test, s.penalised) for s in found] == [(f, pytest.approx(c), pytest.approx(t), pytest.approx(p)) for f, _, c, t, p in plain]
    assert found[0].settings == plain[0][1]
    score, model = search.selected(found)
    assert score is found[0]
    predicted = ml.predict(model, data)
    assert predicted.where("predicted = label").count() > 160


def test_fitted_families(data):
    n = dict.fromkeys(("DecisionTreeClassifier", "RandomForestClassifier", "GradientBoostingClassifier", "XGBClassifier", "LGBMClassifier", "MLPClassifier"), 1)
    small = {f: search.Family(v.kind, [{**s, **({"n_estimators": [3]} if "n_estimators" in s else {})} for s in v.spaces], v.n, v.wide) for f, v in search.FAMILIES.items()}
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(search, "FAMILIES", small)
        found = search.random_search(data, "id", list(n), n=n, k=2)
        again = search.random_search(data, "id", list(n)[:2], n=n, k=2, jobs=1)
        patch.setattr(search, "WIDE", 3)
        assert [s.family for s in search.random_search(data, "id", ["MLPClassifier", "DecisionTreeClassifier"], n=n, k=2)] == ["DecisionTreeClassifier"]
    assert {s.family for s in found} == set(n) and all(0 <= s.cv <= 1 for s in found)
    by = {s.family: (s.folds, s.test) for s in found}
    assert all(by[s.family] == (s.folds, s.test) for s in again)


def test_draws():
    assert len(search.FAMILIES) == 11 and {f: len(search.draws(v.spaces, v.n)) for f, v in search.FAMILIES.items()} == {f: 50 if f in ("LogisticRegression", "SGDClassifier") else 30 for f in search.FAMILIES}
    own = search.draws(search.FAMILIES["KNeighborsClassifier"].spaces, 30)
    assert len({str(s) for s in own}) == 30 and search.draws([{"a": [1, 2]}], 10) != [] and len(search.draws([{"a": [1, 2]}], 10)) == 2
    assert search.draws(search.FAMILIES["SVC"].spaces, 5) == search.draws(search.FAMILIES["SVC"].spaces, 5)


def test_one_class_and_no_rows_are_refused(data):
    with pytest.raises(ValueError, match="two classes"):
        search.random_search(data.where("label = 1"), "id", ["LogisticRegression"])
    with pytest.raises(ValueError, match="no rows"):
        search.random_search(data.limit(0), "id")


def test_kernel_features_give_the_kernel(spark, rings):
    x = np.array([r.v.toArray() for r in rings.select("v").collect()])
    rows = rings.select(F.col("id"), "features")
    for gamma in (0.1, 2.0):
        exact = kernels.radial(x, x, gamma)
        assert exact[:5, :5] == pytest.approx(np.exp(-gamma * ((x[:5, None] - x[:5]) ** 2).sum(axis=2)))
        for components, most in ((300, 1e-4), (100, 0.02))[: 2 if gamma < 1 else 1]:  # a narrow kernel needs a landmark near each row
            model = kernels.RadialFeatures(gamma=gamma, components=components).fit(rows)
            made = np.array([r.kernel.toArray() for r in model.transform(rings).select("kernel").collect()])
            assert np.abs(made @ made.T - exact).max() < most, (gamma, components)
    scaled = kernels.RadialFeatures().fit(rows).map.gamma
    assert scaled == pytest.approx(1 / (2 * x.var())) and kernels.RadialFeatures(gamma="auto").fit(rows).map.gamma == 0.5
    with pytest.raises(ValueError, match="landmarks"):
        kernels.RadialFeatures().fit(rows.limit(0))


def test_kernel_classifiers_part_rings(rings):
    model = Pipeline(stages=[kernels.RadialFeatures(), LinearSVC(featuresCol="kernel", regParam=0.001, standardization=False)]).fit(rings)
    rows = ml.predict(model, rings).select("label", "predicted", "score").collect()
    assert np.mean([r.label == r.predicted for r in rows]) > 0.97 and all((r.score >= 0.5) == (r.predicted == 1) for r in rows)
    found = search.random_search(rings, "id", ["LogisticRegression", "SVC"], n={"LogisticRegression": 3, "SVC": 6})
    assert found[0].family == "SVC" and found[0].settings["kernel"] == "rbf" and found[0].test > 0.9 > found[1].test
    _, chosen = search.selected(found)
    assert np.mean([r.label == r.predicted for r in ml.predict(chosen, rings).collect()]) > 0.9


def test_priority_search_equals_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    y = rng.choice(3, 260, p=[0.2, 0.2, 0.6])
    x = rng.normal(size=(260, 3)) * [1, 10, 0.1] + np.stack([y, -5 * y, 0.05 * (y == 1)], axis=1)
    df = ml.features(spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y, strict=True))], "id int, v array<double>, label int"), ["v"])
    found = search.priority_search(df, "id", n=2)
    assert [len(s[2]) for s in found.searched] == [3] * 4 and found.cv == max(np.mean(s[2]) for s in found.searched)
    split = ml.stratified_split(df.select("id", "label", "features"), "label", "id")
    training = ml.folds(ml.undersampled(split.where("not held_out").drop("held_out"), "label", "id", large=2, like=0), "label", "id", 3).cache()
    counts = {r["label"]: r["count"] for r in training.groupBy("label").count().collect()}
    assert counts[2] == counts[0]
    weighted = training.withColumn("weight", search.balanced(training, counts))
    for name, setting, scores in found.searched[:2]:  # forests depend on how rows are dealt to tasks
        plain = []
        for k in range(3):
            model = search.priority_pipeline(name, setting, sum(counts.values()) * 2 // 3).fit(weighted.where(f"fold <> {k}"))
            rows = model.transform(weighted.where(f"fold = {k}")).select("label", "prediction").collect()
            each = []
            for c in range(3):
                hit, told, true = sum(r.label == c == r.prediction for r in rows), sum(r.prediction == c for r in rows), sum(r.label == c for r in rows)
                each.append(2 * hit / (told + true) if told + true else 0.0)
            plain.append(np.mean(each))
        assert scores == pytest.approx(plain)
    held = {r.id for r in split.where("held_out").collect()}
    assert {r.id for r in found.test.collect()} == held and held
