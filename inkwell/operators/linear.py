"""Linear classifiers in bulk: all settings and folds of a search are trained in the same passes over the rows.

A problem is a loss, its penalties, and the fold that it leaves out. A pass
multiplies each batch of rows with the weights of all problems at once and adds
up their gradients; the driver then takes an accelerated proximal step for each
problem, so a search costs as many passes as its slowest problem, not one
training for each setting and fold. What reaches the driver is one gradient for
each problem, summed up in a tree.

Objective: the weighted mean loss + l1 |w| + l2 / 2 |w|^2, the intercept not
penalised. ``hinge`` is rounded over a tenth of the margin around its corner,
so that it has a gradient.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.operators.sums import batch_sums, matrix

#: The fold of rows that no problem is trained on.
HELD = -1
ROUNDED = 0.1
#: Rows that a task of a pass has at least, but for the last.
ROWS_A_TASK = 500
#: Steps of power iteration, and how much larger than its result a curvature may be.
POWER_STEPS, MARGIN = 12, 1.2


class Loss(NamedTuple):
    """The slope of a loss by the signed margin, and its largest curvature."""

    slope: Callable[[np.ndarray], np.ndarray]
    curvature: float


LOSSES = {
    "logistic": Loss(lambda z: -1 / (1 + np.exp(np.clip(z, -500, 500))), 0.25),
    "squared_hinge": Loss(lambda z: -2 * np.maximum(1 - z, 0), 2.0),
    "hinge": Loss(lambda z: -np.clip((1 - z) / ROUNDED, 0, 1), 1 / ROUNDED),
    "modified_huber": Loss(lambda z: np.where(z < -1, -4.0, -2 * np.maximum(1 - z, 0)), 2.0),
}


class Problem(NamedTuple):
    """``features``: a column of arrays. Penalties are of the mean loss; ``fold`` None leaves out the held rows only."""

    features: str
    loss: str
    l1: float
    l2: float
    balanced: bool
    fold: int | None = None


class Weighting(NamedTuple):
    """What tasks need to know of the problems besides their weights."""

    losses: list[str]
    weight: np.ndarray  # of a row of each class, by problem
    fold: np.ndarray

    def rows(self, label: np.ndarray, fold: np.ndarray, problems: np.ndarray) -> np.ndarray:
        """[row, problem]: zero for rows that the problem leaves out."""
        trained = (fold[:, None] != HELD) & (fold[:, None] != self.fold[problems])
        return self.weight[:, problems][label] * trained


class Bulk:
    """Problems over rows with columns of features, ``label`` (0 or 1) and ``fold`` (from 0, or ``HELD``)."""

    def __init__(self, rows: DataFrame, problems: list[Problem]):
        self.problems = problems
        self.columns = list(dict.fromkeys(p.features for p in problems))
        self.by = {c: [j for j, p in enumerate(problems) if p.features == c] for c in self.columns}
        sizes = rows.groupBy("label", "fold").count().collect()  # classes x folds
        own = lambda c, f: sum(r["count"] for r in sizes if r["label"] == c and r["fold"] not in (HELD, f))
        self.counts = np.array([[own(c, p.fold) for p in problems] for c in (0, 1)], dtype=float)
        total = np.maximum(self.counts.sum(axis=0), 1)
        balance = np.where([p.balanced for p in problems], total / np.maximum(2 * self.counts, 1), 1.0)
        self.weighting = Weighting([p.loss for p in problems], balance / total, np.array([HELD if p.fold is None else p.fold for p in problems]))
        # A pass reads all rows, so it should not consist of many tasks of a few rows each.
        own_rows = rows.select(*self.columns, F.col("label").cast("int"), F.col("fold").cast("int"))
        self.rows = own_rows.coalesce(max(1, sum(r["count"] for r in sizes) // ROWS_A_TASK))
        sizes = rows.agg(*[F.max(F.size(c)).alias(c) for c in self.columns]).first()
        self.dims = {c: (sizes[c] or 0) + 1 for c in self.columns}

    def passed(self, weights: dict[str, np.ndarray], active: dict[str, np.ndarray], of: Callable) -> dict[str, np.ndarray]:
        """By column of features, sums over the rows of ``of(x, margins, labels, folds, problems)``, an array of a row for each problem."""
        used = [c for c in self.columns if len(active[c])]
        # Broadcast for this pass only: as part of the plan, each pass's weights would stay with the driver.
        own = self.rows.sparkSession.sparkContext.broadcast({c: (weights[c][active[c]].T, np.array(self.by[c])[active[c]]) for c in used})

        def run(batch: pa.RecordBatch) -> np.ndarray:
            label, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold"))
            out = []
            for c, (w, problems) in own.value.items():
                x = np.column_stack([np.ones(batch.num_rows), matrix(batch.column(c))])
                out.append(of(x, x @ w, label, fold, problems).ravel())
            return np.concatenate(out)

        total, out, at = batch_sums(self.rows, run), {}, 0
        own.destroy()
        for c in used:
            n, width = len(active[c]), getattr(of, "width", self.dims[c])
            out[c], at = total[at : at + n * width].reshape(n, width), at + n * width
        return out

    def curvatures(self) -> dict[str, np.ndarray]:
        """The largest eigenvalue of each problem's weighted moments, from above."""
        alike = {c: {} for c in self.columns}
        for c in self.columns:
            for k, j in enumerate(self.by[c]):
                alike[c].setdefault((self.problems[j].fold, self.problems[j].balanced), []).append(k)
        first = {c: np.array([own[0] for own in alike[c].values()]) for c in self.columns}
        rng = np.random.default_rng(0)
        vectors = {c: rng.standard_normal((len(self.by[c]), self.dims[c])) for c in self.columns}
        for c in self.columns:
            vectors[c] /= np.linalg.norm(vectors[c], axis=1)[:, None]

        weighting = self.weighting

        def moved(x, margins, label, fold, problems):
            return (margins * weighting.rows(label, fold, problems)).T @ x

        for _ in range(POWER_STEPS):
            made = self.passed(vectors, first, moved)
            size = {c: np.linalg.norm(v, axis=1) for c, v in made.items()}
            for c, v in made.items():
                vectors[c][first[c]] = v / np.maximum(size[c], 1e-300)[:, None]
        out = {}
        for c in self.columns:
            out[c] = np.zeros(len(self.by[c]))
            for own, most in zip(alike[c].values(), size[c], strict=True):
                out[c][own] = most * MARGIN
        return out

    def fit(self, steps: int = 300, tolerance: float = 1e-4) -> list[np.ndarray]:
        """The weights of each problem, the intercept first."""
        problem = lambda c, f: np.array([f(self.problems[j]) for j in self.by[c]])
        l1, l2 = ({c: problem(c, f)[:, None] for c in self.columns} for f in (lambda p: p.l1, lambda p: p.l2))
        curve = self.curvatures()
        step = {c: 1 / (problem(c, lambda p: LOSSES[p.loss].curvature) * curve[c] + l2[c][:, 0] + 1e-12)[:, None] for c in self.columns}
        now = {c: np.zeros((len(self.by[c]), self.dims[c])) for c in self.columns}
        ahead, t = {c: now[c].copy() for c in self.columns}, {c: np.ones(len(self.by[c])) for c in self.columns}
        active = {c: np.arange(len(self.by[c])) for c in self.columns}
        penalised = {c: np.append(0.0, np.ones(self.dims[c] - 1)) for c in self.columns}

        weighting = self.weighting

        def gradient(x, margins, label, fold, problems):
            sign = np.where(label == 1, 1.0, -1.0)[:, None]
            z, slope = margins * sign, np.empty_like(margins)
            names = np.array([weighting.losses[j] for j in problems])
            for name in set(names.tolist()):
                slope[:, names == name] = LOSSES[name].slope(z[:, names == name])
            return (slope * sign * weighting.rows(label, fold, problems)).T @ x

        for _ in range(steps):
            if not any(map(len, active.values())):
                break
            for c, made in self.passed(ahead, active, gradient).items():
                a = active[c]
                from_ = ahead[c][a]
                to = from_ - step[c][a] * (made + l2[c][a] * from_ * penalised[c])
                shrunk = np.sign(to) * np.maximum(np.abs(to) - step[c][a] * l1[c][a] * penalised[c], 0)
                moved = shrunk - now[c][a]
                # Momentum starts anew where it leads uphill.
                uphill = ((from_ - shrunk) * moved).sum(axis=1) > 0
                grown = np.where(uphill, 1.0, (1 + np.sqrt(1 + 4 * t[c][a] ** 2)) / 2)
                momentum = np.where(uphill, 0.0, (t[c][a] - 1) / grown)
                now[c][a], ahead[c][a], t[c][a] = shrunk, shrunk + momentum[:, None] * moved, grown
                # Over the step's length this is the slope that is left, whatever the curvature.
                still = (np.abs(shrunk - from_) / step[c][a]).max(axis=1) <= tolerance
                active[c] = a[~still]
        out: list = [None] * len(self.problems)
        for c in self.columns:
            for k, j in enumerate(self.by[c]):
                out[j] = now[c][k]
        return out

    def confusions(self, weights: list[np.ndarray]) -> np.ndarray:
        """[problem, (true positives, false positives, false negatives)] over the rows that each problem leaves out."""

        weighting = self.weighting

        def counted(x, margins, label, fold, problems):
            out, positive = fold[:, None] == weighting.fold[problems], margins >= 0
            true = label[:, None] == 1
            return np.stack([(out & positive & true).sum(axis=0), (out & positive & ~true).sum(axis=0), (out & ~positive & true).sum(axis=0)], axis=1)

        counted.width = 3
        stacked = {c: np.stack([weights[j] for j in self.by[c]]) for c in self.columns}
        made = self.passed(stacked, {c: np.arange(len(self.by[c])) for c in self.columns}, counted)
        out = np.zeros((len(self.problems), 3))
        for c in self.columns:
            out[self.by[c]] = made[c]
        return out


def f1_of(confusions: np.ndarray) -> np.ndarray:
    """F1 of each row of (true positives, false positives, false negatives); zero where undefined."""
    twice = 2 * confusions[:, 0]
    return twice / np.maximum(twice + confusions[:, 1] + confusions[:, 2], 1)


class LinearModel(Transformer):
    """Margins by weights; rows with a vector of features get ``rawPrediction`` and ``prediction``."""

    def __init__(self, weights: np.ndarray, features: str = "features"):
        super().__init__()
        self.weights, self.features = weights, features

    def _transform(self, dataset: DataFrame) -> DataFrame:
        vector = vector_to_array(self.features)
        pairs = F.zip_with(vector, F.lit(self.weights[1:].tolist()), lambda x, w: x * w)
        out = dataset.withColumn("__margin", F.aggregate(pairs, F.lit(float(self.weights[0])), lambda s, x: s + x))
        out = out.withColumn("rawPrediction", array_to_vector(F.array(-F.col("__margin"), F.col("__margin"))))
        return out.withColumn("prediction", (F.col("__margin") >= 0).cast("double")).drop("__margin")
