"""Kernel features: a radial kernel's feature map from landmark rows, so that linear classifiers are kernel ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.operators.sums import batch_sums, matrix

SEED = 42
#: The most landmarks, and values that they may have together: what is broadcast with a map is bounded by them.
COMPONENTS, VALUES = 256, 1 << 21
#: Eigenvalues below this share of the largest count as none.
SMALL = 1e-10


def radial(x: np.ndarray, z: np.ndarray, gamma: float) -> np.ndarray:
    """exp(-gamma d^2) of all rows of x with all of z."""
    return np.exp(-gamma * np.maximum((x * x).sum(axis=1)[:, None] + (z * z).sum(axis=1) - 2 * (x @ z.T), 0))


class RadialMap:
    """The map x -> k(x, landmarks) K^-1/2, whose products are the kernel's where the landmarks span it."""

    def __init__(self, landmarks: np.ndarray, gamma: float):
        self.landmarks, self.gamma = landmarks, gamma
        values, vectors = np.linalg.eigh(radial(landmarks, landmarks, gamma))
        kept = values > SMALL * values.max(initial=0)
        self.root = vectors[:, kept] / np.sqrt(values[kept])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return radial(x, self.landmarks, self.gamma) @ self.root

    def column(self, vector: Column) -> Column:
        """The features of a column of arrays, as arrays."""

        @F.arrow_udf("array<double>")
        def mapped(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                made = self(matrix(batch)) if len(batch) else np.zeros((0, self.root.shape[1]))
                offsets = np.arange(len(batch) + 1) * self.root.shape[1]
                yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(made.ravel(), pa.float64()))

        return mapped(vector)


def landmarks(rows: DataFrame, vector: str, components: int = COMPONENTS, seed: int = SEED) -> np.ndarray:
    """Up to ``components`` distinct rows of the arrays ``vector``, drawn by a hash: a bounded sample."""
    dim = rows.agg(F.max(F.size(vector))).first()[0] or 1
    most = max(1, min(components, VALUES // dim))
    picked = rows.select(F.col(vector).alias("v")).distinct().orderBy(F.xxhash64("v", F.lit(seed)), "v").limit(most).collect()
    return np.array([r.v for r in picked], dtype=float).reshape(len(picked), -1 if picked else dim)


def scale_gamma(rows: DataFrame, vector: str) -> float:
    """1 / (components x variance of all their values), the usual choice."""
    total = batch_sums(rows.select(F.col(vector).alias("v")), lambda b: np.array([(x := matrix(b.column("v"))).size, x.sum(), (x * x).sum(), x.shape[1] * len(x), len(x)]))
    if total is None:
        return 1.0
    variance = total[2] / total[0] - (total[1] / total[0]) ** 2
    return 1 / (total[3] / total[4] * variance) if variance > 0 else 1.0


class _Settings(HasInputCol, HasOutputCol):
    gamma = Param(Params._dummy(), "gamma", "scale, auto or a number", TypeConverters.toString)
    components = Param(Params._dummy(), "components", "landmarks at most", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "of the draw of landmarks", TypeConverters.toInt)


class RadialFeatures(Estimator, _Settings):
    """Fits a ``RadialMap`` of vectors, for a linear classifier in a pipeline."""

    @keyword_only
    def __init__(self, *, inputCol: str = "features", outputCol: str = "kernel", gamma: str = "scale", components: int = COMPONENTS, seed: int = SEED):
        super().__init__()
        self._set(**{k: str(v) if k == "gamma" else v for k, v in self._input_kwargs.items()})
        self._setDefault(inputCol="features", outputCol="kernel", gamma="scale", components=COMPONENTS, seed=SEED)

    def _fit(self, dataset: DataFrame) -> RadialFeaturesModel:
        rows = dataset.select(vector_to_array(self.getInputCol()).alias("v"))
        marks = landmarks(rows, "v", self.getOrDefault(self.components), self.getOrDefault(self.seed))
        if not len(marks):
            raise ValueError("no rows for landmarks")
        return self._copyValues(RadialFeaturesModel(RadialMap(marks, gamma_of(self.getOrDefault(self.gamma), rows, "v", marks.shape[1]))))


def gamma_of(gamma: str | float, rows: DataFrame, vector: str, dim: int) -> float:
    return scale_gamma(rows, vector) if gamma == "scale" else 1 / max(1, dim) if gamma == "auto" else float(gamma)


class RadialFeaturesModel(Model, _Settings):
    def __init__(self, fitted: RadialMap):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="kernel", gamma="scale", components=COMPONENTS, seed=SEED)
        self.map = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), array_to_vector(self.map.column(vector_to_array(self.getInputCol()))))
