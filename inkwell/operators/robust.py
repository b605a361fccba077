"""Location and scatter that planted outliers can't inflate: the minimum covariance determinant.

Of all halves of the rows, the one whose covariance has the least determinant
gives the estimate. Concentration steps find it: the rows nearest to the present
center, by the present covariance, are the next half, which never has a larger
determinant. Random starts are tried on a bounded sample; the best goes on over
all rows, where each step is a quantile of distances and one sum of moments,
added up on the executors in a tree. What reaches the driver is the sample,
and one matrix of moments a step.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.operators.sums import batch_sums, matrix

SEED = 42
#: Rows and values of the sample, random starts on it, and steps at most.
SAMPLE, SAMPLE_VALUES, STARTS, STEPS = 2000, 1 << 21, 30, 30
#: Errors of a quantile of distances, in ranks: one in so many.
ACCURACY = 10_000


class Scatter(NamedTuple):
    center: np.ndarray
    covariance: np.ndarray

    @classmethod
    def of_moments(cls, total: np.ndarray) -> Scatter:
        """From the sum of outer products of (1, row)."""
        center = total[0, 1:] / total[0, 0]
        return cls(center, total[1:, 1:] / total[0, 0] - np.outer(center, center))

    @classmethod
    def of_rows(cls, x: np.ndarray) -> Scatter:
        center = x.mean(axis=0)
        return cls(center, (x - center).T @ (x - center) / len(x))

    def precision(self) -> np.ndarray:
        return np.linalg.pinv(self.covariance, hermitian=True)

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared Mahalanobis distances of rows."""
        d = x - self.center
        return np.einsum("ij,jk,ik->i", d, self.precision(), d, optimize=True)

    def log_determinant(self) -> float:
        """Over the directions in which anything varies; fewer such directions count as smaller."""
        values = np.linalg.eigvalsh(self.covariance)
        return float(np.log(np.maximum(values, np.finfo(float).tiny)).sum())


def concentrated(x: np.ndarray, half: int, start: Scatter, steps: int) -> Scatter:
    """``start`` after up to ``steps`` concentration steps among rows x."""
    found = start
    for _ in range(steps):
        d = found.distances(x)
        then = Scatter.of_rows(x[np.argsort(d, kind="stable")[:half]])
        if then.log_determinant() >= found.log_determinant() - 1e-12 and found is not start:
            return found
        found = then
    return found


def sampled_start(sample: np.ndarray) -> Scatter:
    """The best of many random starts on the sample."""
    rng = np.random.default_rng(SEED)
    n, dim = sample.shape
    half = min(n, (n + dim + 2) // 2)
    tried = []
    for _ in range(STARTS):
        first = Scatter.of_rows(sample[rng.choice(n, min(n, dim + 1), replace=False)])
        tried.append(concentrated(sample, half, first, 2))
    tried.sort(key=Scatter.log_determinant)
    return min((concentrated(sample, half, t, STEPS) for t in tried[:3]), key=Scatter.log_determinant)


def moments_within(rows: DataFrame, vector: str, scatter: Scatter, reach: float) -> np.ndarray:
    """Sums of the outer products of (1, row) over the rows within the squared distance ``reach``."""

    def of(x: np.ndarray) -> np.ndarray:
        x = x[scatter.distances(x) <= reach]
        x = np.column_stack([np.ones(len(x)), x])
        return x.T @ x

    total = batch_sums(rows.select(F.col(vector).alias("v")), lambda batch: of(matrix(batch.column("v"))).ravel())
    size = 1 + len(scatter.center)
    return total.reshape(size, size)


def squared_distance(scatter: Scatter, vector: Column) -> Column:
    center, precision = scatter.center, scatter.precision()

    @F.arrow_udf("double")
    def distance(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            d = matrix(batch).reshape(len(batch), len(center)) - center
            yield pa.array(np.einsum("ij,jk,ik->i", d, precision, d, optimize=True), pa.float64())

    return distance(vector)


def chi_square(share: float, dim: int) -> float:
    """The quantile of a chi-square distribution, by Wilson and Hilferty's approximation, for the two shares used here."""
    z = {0.5: 0.0, 0.975: 1.959963985}[share]
    return dim * (1 - 2 / (9 * dim) + z * (2 / (9 * dim)) ** 0.5) ** 3


def minimum_covariance_determinant(rows: DataFrame, vector: str = "v") -> Scatter | None:
    """Center and covariance of the most concentrated half of the arrays ``vector``, reweighted; none without rows."""
    n, dim = rows.agg(F.count(vector), F.max(F.size(vector))).first()
    if not n:
        return None
    size = max(dim + 2, min(SAMPLE, SAMPLE_VALUES // max(1, dim)))
    picked = rows.select(F.col(vector).alias("v")).orderBy(F.xxhash64(vector, F.lit(SEED))).limit(size).collect()
    found = sampled_start(np.array([r.v for r in picked], dtype=float))
    share = min(1.0, ((n + dim + 2) // 2) / n)
    quantile = lambda s, q: float(rows.select(squared_distance(s, F.col(vector)).alias("d")).agg(F.percentile_approx("d", q, ACCURACY)).first()[0])
    before = np.inf
    for _ in range(STEPS):
        found = Scatter.of_moments(moments_within(rows, vector, found, quantile(found, share)))
        now = found.log_determinant()
        if not now < before - 1e-9:
            break
        before = now
    # Scaled so that the median distance is that of a normal distribution, then over all rows that are no outliers by that.
    scaled = Scatter(found.center, found.covariance * max(quantile(found, 0.5), np.finfo(float).tiny) / chi_square(0.5, dim))
    return Scatter.of_moments(moments_within(rows, vector, scaled, chi_square(0.975, dim)))
