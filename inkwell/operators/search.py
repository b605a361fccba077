"""Random searches over classifier families, scored by cross-validation, and the choice among them.

Each family draws its settings at random from its space (50 for logistic and
gradient descent, 30 for the others), scores each by its mean F1 over five
stratified folds, refits the best on all training rows, and is tested on rows
held out from the start. The family with the best penalised score is chosen.

All linear families, kernel ones on their feature maps included, are trained
in bulk: their settings and folds share the same passes over the rows. All
nearest-neighbour settings share one search for each distance. The
other families are fitted one by one, ``SEARCH_JOBS`` at a time, as wide rows
make each fit large. On wide features the families that don't suit them are
passed over.

A search sees up to ``MOST_ROWS`` rows, a bounded sample drawn by a hash of the
key; the model that it chooses scores all rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from typing import Any

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.operators import kernels, linear, ml, neighbours
from inkwell.sources.storage import stored

SEED = 42
#: Fits that run at the same time.
SEARCH_JOBS = 4
#: Rows that a search is made with at most.
MOST_ROWS = 5000
#: Rows that a task of a search has.
ROWS_A_TASK = 500
#: Features beyond which rows count as wide.
WIDE = 1 << 14
Space = dict[str, Any]


def log_uniform(low: float, high: float) -> Callable:
    return lambda rng: float(math.exp(rng.uniform(math.log(low), math.log(high))))


def uniform(low: float, width: float) -> Callable:
    return lambda rng: float(rng.uniform(low, low + width))


def whole(low: int, high: int) -> Callable:
    """A whole number from low to below high."""
    return lambda rng: int(rng.integers(low, high))


def draws(spaces: list[Space], n: int, seed: int = SEED) -> list[Space]:
    """``n`` settings from the spaces; from lists alone without repeats, so fewer if they have no more."""
    rng = np.random.default_rng(seed)
    if not any(callable(v) for s in spaces for v in s.values()):
        every: list[Space] = []
        for space in spaces:
            made: list[Space] = [{}]
            for name, values in sorted(space.items()):
                made = [{**m, name: v} for m in made for v in values]
            every += made
        return [every[i] for i in rng.permutation(len(every))[:n]]
    out = []
    for _ in range(n):
        space = spaces[int(rng.integers(len(spaces)))]
        out.append({name: v(rng) if callable(v) else v[int(rng.integers(len(v)))] for name, v in sorted(space.items())})
    return out


@dataclass(frozen=True)
class Family:
    """A kind of classifier: how it is searched, and the spaces that its settings are drawn from."""

    kind: str
    spaces: list[Space]
    n: int = 30
    wide: bool = True


# The families, and the spaces and numbers of their draws.
FAMILIES = {
    "LogisticRegression": Family("linear", [{"C": log_uniform(1e-3, 10), "penalty": ["l2"]}, {"C": log_uniform(1e-3, 10), "penalty": ["l1", "l2"]}], 50),
    "LinearSVC": Family("linear", [{"C": log_uniform(1e-3, 10), "penalty": ["l2"], "loss": ["squared_hinge", "hinge"]}, {"C": log_uniform(1e-3, 10), "penalty": ["l1"], "loss": ["squared_hinge"]}]),
    "LGBMClassifier": Family("boosted", [{"n_estimators": whole(50, 200), "num_leaves": whole(15, 63), "max_depth": [-1, 3, 5, 7], "learning_rate": log_uniform(0.01, 0.3), "min_samples_leaf": whole(5, 40), "subsample": uniform(0.6, 0.4), "max_features": uniform(0.5, 0.5), "class_weight": ["balanced", None]}]),
    "RandomForestClassifier": Family("forest", [{"n_estimators": whole(50, 200), "max_depth": [3, 5, 7, 9, 11], "min_samples_split": whole(5, 30), "min_samples_leaf": whole(3, 15), "max_features": ["sqrt", "log2", 0.3, 0.5], "criterion": ["gini", "entropy"], "min_impurity_decrease": uniform(0.0, 0.05), "class_weight": ["balanced", None]}]),
    "GradientBoostingClassifier": Family("boosted", [{"n_estimators": whole(50, 150), "learning_rate": log_uniform(0.01, 0.3), "max_depth": [2, 3, 4, 5, 6, 7], "min_samples_split": whole(5, 20), "min_samples_leaf": whole(3, 10), "subsample": uniform(0.6, 0.4), "max_features": ["sqrt", "log2", 0.5]}]),
    "XGBClassifier": Family("boosted", [{"n_estimators": whole(50, 150), "learning_rate": log_uniform(0.01, 0.3), "max_depth": [2, 3, 4, 5, 6, 7], "min_samples_leaf": whole(1, 10), "subsample": uniform(0.6, 0.4), "max_features": uniform(0.5, 0.5), "min_impurity_decrease": uniform(0.0, 0.5)}]),
    "MLPClassifier": Family("perceptron", [{"hidden": [(50,), (100,), (50, 25), (100, 50)], "learning_rate": log_uniform(1e-4, 1e-2), "batch_size": [32, 64, 200]}], wide=False),
    "SVC": Family("kernel", [{"C": log_uniform(1e-2, 10), "kernel": ["linear", "rbf"], "gamma": ["scale", "auto", *(float(g) for g in np.exp(np.random.default_rng(SEED).uniform(math.log(1e-4), math.log(1e-1), 20)))]}], wide=False),
    "DecisionTreeClassifier": Family("tree", [{"criterion": ["gini", "entropy"], "max_depth": [3, 5, 7, 10], "min_samples_split": [10, 20, 30], "min_samples_leaf": [5, 10, 15], "max_features": ["sqrt", "log2", 0.5], "min_impurity_decrease": [0.0, 0.01, 0.02], "class_weight": ["balanced", None]}]),
    "KNeighborsClassifier": Family("neighbours", [{"n_neighbors": [5, 7, 9, 11, 15], "weights": ["uniform", "distance"], "p": [1, 2], "leaf_size": [30, 50]}]),
    "SGDClassifier": Family("linear", [{"loss": ["log_loss", "modified_huber"], "penalty": ["l2", "l1", "elasticnet"], "alpha": log_uniform(1e-5, 1e-1), "l1_ratio": uniform(0, 1)}], 50),
}


@dataclass
class Score:
    """What the search of one family found."""

    family: str
    settings: Space
    folds: list[float]
    test: float
    refit: Callable[[], Transformer]

    @property
    def cv(self) -> float:
        return float(np.mean(self.folds))

    @property
    def penalised(self) -> float:
        return 0.7 * self.test + 0.3 * self.cv - 2 * max(0.0, self.cv - self.test - 0.05)


class Rows:
    """A search's rows, stored: features (a vector), x (the same as an array), label (0 or 1) and fold, ``HELD`` for the test's."""

    def __init__(self, data: DataFrame, key: str, label: str = "label", features: str = "features", k: int = 5, seed: int = SEED):
        split = ml.stratified_split(data.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"), F.col(features).alias("features")), "label", "key", seed=seed)
        training = ml.folds(split.where("not held_out").drop("held_out"), "label", "key", k, seed)
        held = split.where("held_out").drop("held_out").withColumn("fold", F.lit(linear.HELD))
        whole = training.union(held.select(*training.columns)).withColumn("x", vector_to_array("features"))
        # A bounded sample: dealt out so that no task has many of its rows, nor many tasks a few.
        self.data = stored(whole.repartition(max(1, data.count() // ROWS_A_TASK)), "search")
        self.folds = list(range(k))
        self.training, self.test = self.data.where(F.col("fold") != linear.HELD), self.data.where(F.col("fold") == linear.HELD)
        counts = {r["label"]: r["count"] for r in self.training.groupBy("label").count().collect()}  # a row for each class
        self.counts, self.n = counts, sum(counts.values())


def best_of(scores: np.ndarray) -> int:
    """The first draw with the highest mean over its folds."""
    return int(np.argmax(scores.mean(axis=1)))


def linear_problem(family: str, setting: Space, n: int, fold: int | None, features: str = "x") -> linear.Problem:
    """A draw's problem; penalties by C are spread over the ``n`` rows trained on."""
    if family == "SGDClassifier":
        ratio = {"l1": 1.0, "l2": 0.0}.get(setting["penalty"], setting["l1_ratio"])
        loss = "logistic" if setting["loss"] == "log_loss" else setting["loss"]
        return linear.Problem(features, loss, setting["alpha"] * ratio, setting["alpha"] * (1 - ratio), True, fold)
    size = 1 / (setting["C"] * max(1, n))
    loss = {"LogisticRegression": "logistic", "SVC": "hinge"}.get(family) or setting["loss"]
    l1 = setting.get("penalty") == "l1"
    return linear.Problem(features, loss, size if l1 else 0.0, 0.0 if l1 else size, True, fold)


def linear_searches(rows: Rows, settings: dict[str, list[Space]], steps: int) -> list[Score]:
    """The linear families and the kernel one, all of them in the same passes."""
    data, maps = rows.data, {}
    for setting in settings.get("SVC", []):
        if setting["kernel"] == "rbf" and setting["gamma"] not in maps:
            marks = kernels.landmarks(rows.training, "x")
            gamma = kernels.gamma_of(setting["gamma"], rows.training, "x", marks.shape[1])
            maps[setting["gamma"]] = f"x{len(maps)}", kernels.RadialMap(marks, gamma)
    if maps:
        mapped = [m.column(F.col("x")).cast("array<float>").alias(name) for name, m in maps.values()]
        data = stored(data.select("label", "fold", "x", *mapped), "kernels")
    column = lambda s: maps[s["gamma"]][0] if s.get("kernel") == "rbf" else "x"
    sizes = {r["fold"]: r["count"] for r in rows.training.groupBy("fold").count().collect()}
    drawn = [(family, setting) for family, own in settings.items() for setting in own]
    problems = [linear_problem(f, s, rows.n - sizes.get(k, 0), k, column(s)) for f, s in drawn for k in rows.folds]
    bulk = linear.Bulk(data, problems)
    scores = linear.f1_of(bulk.confusions(bulk.fit(steps))).reshape(len(drawn), len(rows.folds))
    best = {}
    for family in settings:
        own = [i for i, (f, _) in enumerate(drawn) if f == family]
        best[family] = own[best_of(scores[own])]
    finals = linear.Bulk(data, [linear_problem(*drawn[i], rows.n, None, column(drawn[i][1])) for i in best.values()])
    weights = finals.fit(steps)
    tests = linear.f1_of(finals.confusions(weights))
    out = []
    for (family, i), w, test in zip(best.items(), weights, tests, strict=True):
        setting = drawn[i][1]
        model = linear.LinearModel(w)
        if setting.get("kernel") == "rbf":
            model = PipelineModel([kernels.RadialFeaturesModel(maps[setting["gamma"]][1]), linear.LinearModel(w, "kernel")])
        out.append(Score(family, setting, scores[i].tolist(), float(test), lambda model=model: model))
    return out


def neighbour_scores(near: DataFrame, label: DataFrame, settings: list[Space], folds: list[int]) -> np.ndarray:
    """[setting, fold] F1 from each row's nearest neighbours, in one pass."""
    counted = []
    for i, s in enumerate(settings):
        positive = neighbours.votes(F.slice("near", 1, s["n_neighbors"]), 2, s["weights"])[1] >= 0.5
        true = F.col("label") == 1
        counted += [F.count_if(positive & true).alias(f"a{i}"), F.count_if(positive & ~true).alias(f"b{i}"), F.count_if(~positive & true).alias(f"c{i}")]
    fold = (F.shiftright("__id", ID_BITS) - 1).alias("fold")
    found = {r["fold"]: r for r in near.join(label, "__id").groupBy(fold).agg(*counted).collect()}  # a row for each fold
    none = dict.fromkeys((f"{c}{i}" for c in "abc" for i in range(len(settings))), 0)
    return np.array([linear.f1_of(np.array([[found.get(k, none)[f"{c}{i}"] for c in "abc"] for k in folds], dtype=float)) for i in range(len(settings))])


#: Ids of rows within a fold, in bits; a fold's number stands above them.
ID_BITS = 40


def neighbour_search(rows: Rows, family: str, settings: list[Space]) -> Score:
    """One search for each distance, in which a row's own fold doesn't count, for as many neighbours as any setting asks for."""
    fold = F.shiftleft(F.col("fold").cast("long") + 1, ID_BITS)
    spread = F.monotonically_increasing_id()
    # Partitions take the upper bits of these numbers: with fewer than 2^7 of them, and 2^33 rows in each, the numbers fit below the fold's.
    numbered = stored(rows.data.select("x", "label", "fold").coalesce(100).withColumn("__id", fold.bitwiseOR(spread)), "numbered")
    most, labels = max(s["n_neighbors"] for s in settings), numbered.select("__id", "label")
    training = numbered.where(F.col("fold") != linear.HELD).select("__id", F.col("x").alias("v"), F.col("label").cast("long").alias("y"))
    scores, indexes = np.zeros((len(settings), len(rows.folds))), {}
    for p in sorted({s["p"] for s in settings}):
        indexes[p] = neighbours.CellIndex.build(training, p)
        near = stored(indexes[p].nearest(training.select("__id", "v"), most, apart=ID_BITS), "near")
        own = [i for i, s in enumerate(settings) if s["p"] == p]
        scores[own] = neighbour_scores(near, labels, [settings[i] for i in own], rows.folds)
    best = settings[best_of(scores)]
    held = numbered.where(F.col("fold") == linear.HELD).select("__id", F.col("x").alias("v"))
    test = neighbour_scores(indexes[best["p"]].nearest(held, most), labels, [best], [linear.HELD])[0, 0]
    make = partial(neighbours.NearestNeighboursClassifier, k=best["n_neighbors"], weights=best["weights"], p=best["p"])
    return Score(family, best, scores[best_of(scores)].tolist(), float(test), lambda: make().fit(rows.training))


def share(features: float | str) -> str:
    return features if isinstance(features, str) else str(float(features))


def estimator(kind: str, setting: Space, dim: int, classes: int = 2) -> Estimator:
    """The estimator of a setting. The least rows of a leaf stand in for those of a split, which Spark's trees don't have."""
    least = max(setting.get("min_samples_leaf", 1), -(-setting.get("min_samples_split", 1) // 2))
    weight = {"weightCol": "weight"} if setting.get("class_weight") == "balanced" else {}
    trees = {"minInstancesPerNode": least, "minInfoGain": setting.get("min_impurity_decrease", 0.0), "seed": SEED, **weight}
    if kind == "tree":
        return DecisionTreeClassifier(maxDepth=setting["max_depth"], impurity=setting["criterion"], **trees)
    if kind == "forest":
        return RandomForestClassifier(numTrees=setting["n_estimators"], maxDepth=setting["max_depth"] or 30, impurity=setting.get("criterion", "gini"), featureSubsetStrategy=share(setting.get("max_features", "sqrt")), **trees)
    if kind == "boosted":
        # A tree of so many leaves is about as deep as their logarithm.
        depth = setting["max_depth"] if setting["max_depth"] > 0 else math.ceil(math.log2(setting["num_leaves"]))
        return GBTClassifier(maxIter=setting["n_estimators"], stepSize=setting["learning_rate"], maxDepth=depth, subsamplingRate=setting["subsample"], featureSubsetStrategy=share(setting["max_features"]), **trees)
    if kind == "perceptron":
        return MultilayerPerceptronClassifier(layers=[dim, *setting["hidden"], classes], maxIter=100, stepSize=setting["learning_rate"], blockSize=setting["batch_size"], seed=SEED)
    raise ValueError(kind)


def sampled(data: DataFrame, key: str, most: int, seed: int = SEED) -> DataFrame:
    """``data``, or of more rows than ``most`` those with the lowest hashes of their keys."""
    return data if data.limit(most + 1).count() <= most else data.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(most)


def balanced(rows: DataFrame, counts: dict[int, int]) -> Column:
    """The weight of a row by which all classes weigh the same."""
    weight = F.lit(1.0)
    for c, n in counts.items():
        weight = F.when(F.col("label") == c, sum(counts.values()) / (len(counts) * max(1, n))).otherwise(weight)
    return weight


def fitted_searches(rows: Rows, settings: dict[str, list[Space]], jobs: int) -> list[Score]:
    """Families that are fitted one by one: a fit for each setting and fold, ``jobs`` at a time."""
    dim = len(rows.data.select("x").first()[0])
    data = stored(rows.data.withColumn("weight", balanced(rows.data, rows.counts)), "weighted")
    training = data.where(F.col("fold") != linear.HELD)

    def f1(kind: str, setting: Space, fit_on: DataFrame, out: DataFrame) -> float:
        return ml.f1(estimator(kind, setting, dim).fit(fit_on).transform(out))

    def scored(case: tuple) -> float:
        family, setting, fold = case
        return f1(FAMILIES[family].kind, setting, training.where(F.col("fold") != fold), training.where(F.col("fold") == fold))

    cases = [(f, s, k) for f, own in settings.items() for s in own for k in rows.folds]
    with ThreadPoolExecutor(jobs) as pool:
        found = iter(pool.map(scored, cases))
        scores = {f: np.array([[next(found) for _ in rows.folds] for _ in own]) for f, own in settings.items()}
    out = []
    for family, own in settings.items():
        best, kind = best_of(scores[family]), FAMILIES[family].kind
        test = f1(kind, own[best], training, data.where(F.col("fold") == linear.HELD))
        out.append(Score(family, own[best], scores[family][best].tolist(), test, partial(estimator(kind, own[best], dim).fit, training)))
    return out


def random_search(data: DataFrame, key: str, families: list[str] | None = None, *, n: dict[str, int] | None = None, k: int = 5, seed: int = SEED, jobs: int = SEARCH_JOBS, steps: int = 200, most: int = MOST_ROWS) -> list[Score]:
    """The searches' results, best first; data has ``key``, ``label`` (0 or 1) and ``features``.

    ``n`` overrides the draws of a family. Of equal scores the family that
    comes first in ``families`` wins. All rows stay distributed; the driver has
    the settings and their scores.
    """
    families = families or list(FAMILIES)
    first = data.select("features").first()
    if first is None:
        raise ValueError("no rows to search with")
    chosen = [f for f in families if FAMILIES[f].wide or first[0].size <= WIDE]
    rows = Rows(sampled(data, key, most, seed), key, k=k, seed=seed)
    if len(rows.counts) != 2:
        raise ValueError("a search takes two classes")
    drawn = {f: draws(FAMILIES[f].spaces, (n or {}).get(f, FAMILIES[f].n), seed) for f in chosen}
    of = lambda *kinds: {f: drawn[f] for f in chosen if FAMILIES[f].kind in kinds}
    out: list[Score] = []
    if of("linear", "kernel"):
        out += linear_searches(rows, of("linear", "kernel"), steps)
    for family, own in of("neighbours").items():
        out.append(neighbour_search(rows, family, own))
    if fitted := of("tree", "forest", "boosted", "perceptron"):
        out += fitted_searches(rows, fitted, jobs)
    out.sort(key=lambda s: (-s.penalised, families.index(s.family)))
    return out


def selected(scores: list[Score]) -> tuple[Score, Transformer]:
    """The best family, refitted on all training rows."""
    if not scores or scores[0].penalised <= 0:
        raise ValueError("no family of classifiers reached a positive score")
    return scores[0], scores[0].refit()


# The spaces of the priority classifier's two pipelines.
PRIORITY_SPACES = {
    "LogisticRegression": {"C": [0.01, 0.1, 1.0]},
    "RandomForest": {"n_estimators": [50, 100], "max_depth": [5, 10, None], "min_samples_split": [2, 5], "min_samples_leaf": [1, 2]},
}


def priority_pipeline(name: str, setting: Space, n: int) -> Pipeline:
    """A scaler, fitted with the classifier on the rows of its folds alone, and the classifier."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=name == "LogisticRegression")
    if name == "LogisticRegression":
        # The scaled features are penalised as they are, by C spread over the rows.
        model = LogisticRegression(featuresCol="scaled", regParam=1 / (setting["C"] * max(1, n)), standardization=False, weightCol="weight", family="multinomial")
    else:
        model = estimator("forest", {**setting, "class_weight": "balanced"}, 0).setFeaturesCol("scaled")
    return Pipeline(stages=[scaler, model])


def macro_f1(predicted: DataFrame, classes: int) -> float:
    """Mean F1 over the classes, zero for those that neither occur nor are predicted."""
    rows = {int(r["class"]): r["f1"] for r in ml.confusion(predicted, "label", "prediction").collect()}  # a row for each class
    return float(np.mean([rows.get(c, 0.0) for c in range(classes)]))


@dataclass
class Priority:
    name: str
    settings: Space
    cv: float
    model: Transformer
    test: DataFrame  # rows held out, with predictions
    searched: list[tuple[str, Space, list[float]]]


def priority_search(data: DataFrame, key: str, *, n: int = 10, k: int = 3, classes: int = 3, seed: int = SEED, jobs: int = SEARCH_JOBS, most: int = MOST_ROWS) -> Priority:
    """Both pipelines searched by macro-F1 over ``k`` folds, the better one refitted and applied to the rows held out.

    In training rows, the last class is cut to the size of the first. Data has
    ``key``, ``label`` (from 0) and ``features``; of equal scores the first
    pipeline and draw win.
    """
    split = stored(ml.stratified_split(sampled(data.select(key, "label", "features"), key, most, seed), "label", key, seed=seed), "priorities")
    cut = ml.undersampled(split.where("not held_out").drop("held_out"), "label", key, large=classes - 1, like=0, seed=seed)
    training = ml.folds(cut, "label", key, k, seed)
    counts = {r["label"]: r["count"] for r in training.groupBy("label").count().collect()}
    training = stored(training.withColumn("weight", balanced(training, counts)), "training")
    size = sum(counts.values())
    cases = [(name, s) for name, space in PRIORITY_SPACES.items() for s in draws([space], n, seed)]

    def scored(case: tuple) -> float:
        (name, setting), fold = case
        model = priority_pipeline(name, setting, size * (k - 1) // k).fit(training.where(F.col("fold") != fold))
        return macro_f1(model.transform(training.where(F.col("fold") == fold)), classes)

    with ThreadPoolExecutor(jobs) as pool:
        found = list(pool.map(scored, [(c, f) for c in cases for f in range(k)]))
    scores = np.array(found).reshape(len(cases), k)
    name, setting = cases[best_of(scores)]
    model = priority_pipeline(name, setting, size).fit(training)
    searched = [(c[0], c[1], s.tolist()) for c, s in zip(cases, scores, strict=True)]
    return Priority(name, setting, float(scores[best_of(scores)].mean()), model, model.transform(split.where("held_out")), searched)
