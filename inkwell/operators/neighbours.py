"""Nearest neighbours through cells: an index, exact and approximate searches, outlier factors, a classifier.

``CellIndex.build`` fits coarse centers on a bounded sample and places every
row into the cell of its nearest center. A search visits, for each query, the
nearest cells that hold ``k`` rows or more (``probes`` cells at least), which
bounds the distance to its k-th neighbour; an exact search then visits every
other cell whose rows may be within that bound by the triangle inequality, and
only distances within the bound are kept. An approximate search leaves that
second visit out.

Rows and queries meet by cell in a shuffle. Large cells, and cells with many
queries, are split into parts of a bounded size, so a task compares a bounded
number of rows with a bounded number of queries, however the rows are spread
over the cells. What reaches the driver is the sample and a row for each
cell, both bounded.

The work of an exact search is that of the cells visited: nearly linear where
rows cluster, and all pairs (in blocks) where all rows are about equally far
from each other, as no bound can tell them apart then.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from inkwell.operators.sums import matrix
from inkwell.sources.storage import stored

SEED = 42
#: The most cells, sampled rows a cell, and the most values that are sampled.
MAX_CELLS, SAMPLED, SAMPLE_VALUES = 4096, 64, 1 << 21
#: Rows, and values, of a cell that meet as many queries in a task; queries and values that a step of it works on.
PART_ROWS, PART_VALUES, STEP, STEP_VALUES = 1 << 14, 1 << 20, 512, 1 << 22
#: Rows among which a first bound of the k-th distance is sought.
FIRST = 2048
NEAR = "array<struct<d: double, i: long, y: long>>"


def distances(x: np.ndarray, y: np.ndarray, p: int) -> np.ndarray:
    """Distances of all rows of x to all of y, to the power p, up to rounding."""
    if p == 2:
        return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T), 0)
    width = max(1, STEP_VALUES // max(1, y.size))
    return np.concatenate([np.abs(x[k : k + width, None, :] - y).sum(axis=2) for k in range(0, len(x), width)]) if len(x) else np.zeros((0, len(y)))


def centers_of(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """``cells`` centers of a sample by a few rounds of k-means from distinct random rows."""
    distinct = np.unique(sample, axis=0)
    centers = np.random.default_rng(SEED).permutation(distinct)[:cells]
    for _ in range(rounds if len(distinct) > cells else 0):
        own = np.concatenate([distances(sample[k : k + STEP], centers, 2).argmin(axis=1) for k in range(0, len(sample), STEP)])
        order = np.argsort(own, kind="stable")
        used, heads = np.unique(own[order], return_index=True)
        centers[used] = np.add.reduceat(sample[order], heads, axis=0) / np.diff(heads, append=len(own))[:, None]
    return centers


def part_rows(dim: int) -> int:
    return max(1, min(PART_ROWS, PART_VALUES // max(1, dim)))


def rough(x: np.ndarray, y: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Distances to the power p but for a summand of each query, the summands, and how far they may be off."""
    if p != 2:
        made = distances(x, y, p)
        return made, np.zeros(len(x)), 1e-9 * (1 + made.max(initial=0))
    # In single precision, near the rows' center, where products lose least.
    center = y.mean(axis=0)
    x, y = (x - center).astype(np.float32), (y - center).astype(np.float32)
    own, other = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
    made = x @ (-2 * y.T)
    made += other
    return made, own, (x.shape[1] + 8) * 2.4e-7 * float(own.max(initial=0) + other.max(initial=0))


def without_own(power: np.ndarray, own: np.ndarray, ids: np.ndarray, apart: int) -> None:
    """Infinite distances between queries and rows whose ids are equal but for the lowest ``apart`` bits."""
    if apart:
        own, ids = own >> apart, ids >> apart
        for group in np.unique(own):
            power[np.ix_(own == group, ids == group)] = np.inf
        return
    order = np.argsort(ids)
    at = np.minimum(np.searchsorted(ids, own, sorter=order), len(ids) - 1)
    same = np.flatnonzero(ids[order[at]] == own)
    power[same, order[at[same]]] = np.inf


def near_rows(x: np.ndarray, reach: np.ndarray, own: np.ndarray, y: np.ndarray, ids: np.ndarray, k: int, p: int, apart: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the k rows nearest to each query, within its reach, in order of query, distance and id."""
    power, summand, slack = rough(x, y, p)
    if apart is not None:
        without_own(power, own, ids, apart)
    limit = reach**p - summand
    loose = np.flatnonzero(~np.isfinite(reach))
    if len(loose):
        # The k-th distance among some of the rows bounds the one among all.
        some = power[loose, : max(k, FIRST)]
        limit[loose] = np.partition(some, min(k, some.shape[1]) - 1, axis=1)[:, min(k, some.shape[1]) - 1]
    query, row = np.nonzero((power <= (limit + 2 * slack).astype(power.dtype)[:, None]) & np.isfinite(power))
    width = max(1, STEP_VALUES // max(1, x.shape[1]))
    parts = [(np.abs(x[query[a : a + width]] - y[row[a : a + width]]) ** p).sum(axis=1) for a in range(0, len(query), width)]
    d = np.concatenate(parts) if parts else np.zeros(0)
    d = np.sqrt(d) if p == 2 else d
    keep = d <= reach[query]
    query, row, d = query[keep], row[keep], d[keep]
    order = np.lexsort((ids[row], d, query))
    query, row, d = query[order], row[order], d[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < k], row[rank < k], d[rank < k]


class CellIndex(NamedTuple):
    """Placed rows (__id, v, y, cell) and, of each cell, its center, its rows' largest distance to it, and their number."""

    rows: DataFrame
    centers: np.ndarray
    radii: np.ndarray
    counts: np.ndarray
    p: int

    @classmethod
    def build(cls, rows: DataFrame, p: int = 2, cell_rows: int | None = None) -> CellIndex | None:
        """An index of rows (__id long, v array<double>, y long); none without rows. Ids are distinct."""
        n, dim = rows.agg(F.count("*"), F.max(F.size("v"))).first()
        if not n:
            return None
        cells = max(1, min(MAX_CELLS, -(-n // (cell_rows or part_rows(dim))), SAMPLE_VALUES // max(1, dim) // 8))
        size = max(cells, min(SAMPLED * cells, SAMPLE_VALUES // max(1, dim)))
        sample = np.array([r.v for r in rows.select("v", "__id").orderBy(F.xxhash64("__id", F.lit(SEED)), "__id").limit(size).collect()], dtype=float)
        centers = centers_of(sample, cells)

        def place(batches):
            for batch in batches:
                for k in range(0, batch.num_rows, STEP):
                    piece = batch.slice(k, STEP)
                    power = distances(matrix(piece.column("v")), centers, p)
                    cell = power.argmin(axis=1)
                    far = power[np.arange(len(cell)), cell]
                    yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(cell, pa.int32()), pa.array(np.sqrt(far) if p == 2 else far, pa.float64())], names=["__id", "v", "y", "cell", "far"])

        placed = stored(rows.select("__id", "v", "y").mapInArrow(place, "__id long, v array<double>, y long, cell int, far double"), "cells")
        radii, counts = np.zeros(len(centers)), np.zeros(len(centers), dtype=np.int64)
        for r in placed.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect():  # a row for each cell
            radii[r.cell], counts[r.cell] = r.far, r.n
        return cls(placed.drop("far"), centers, radii, counts, p)

    def visits(self, queries: DataFrame, k: int, probes: int) -> DataFrame:
        """Queries (__id, v, reach and more) with ``cells``: without a reach the nearest, which hold k rows, else all others within reach."""
        shape = StructType([*queries.schema.fields, StructField("cells", ArrayType(IntegerType()))])
        centers, radii, counts, p = self.centers, self.radii, self.counts, self.p

        def run(batches):
            for batch in batches:
                for k0 in range(0, batch.num_rows, STEP):
                    piece = batch.slice(k0, STEP)
                    power = distances(matrix(piece.column("v")), centers, p)
                    d = np.sqrt(power) if p == 2 else power
                    order = np.argsort(d, axis=1, kind="stable")
                    held = np.cumsum(counts[order], axis=1)
                    # One row more than k, as a query may be a row itself.
                    need = np.maximum(np.minimum((held < k + 1).sum(axis=1) + 1, len(centers)), min(probes, len(centers)))
                    first = np.arange(len(centers)) < need[:, None]
                    reach = piece.column("reach").to_numpy(zero_copy_only=False)
                    known = ~np.isnan(reach.astype(float))
                    slack = 1e-9 * (d.max(initial=0) + radii.max(initial=0) + 1)
                    within = np.take_along_axis(d - radii, order, axis=1) <= np.where(known, reach, 0.0)[:, None].astype(float) + slack
                    chosen = np.where(known[:, None], within & ~first, first) & (counts[order] > 0)
                    yield pa.RecordBatch.from_arrays([*piece.columns, pa.array([o[c].tolist() for o, c in zip(order, chosen, strict=True)], pa.list_(pa.int32()))], names=shape.names)

        return queries.mapInArrow(run, shape)

    def met(self, visits: DataFrame, k: int, apart: int | None) -> DataFrame:
        """__id, near: up to k rows of each part of each cell that a query visits."""
        spark, most = visits.sparkSession, part_rows(self.centers.shape[1])
        each = visits.select("__id", "v", "reach", F.explode("cells").alias("cell"))
        wanted = each.groupBy("cell").agg(F.ceil(F.count("*") / most).cast("int").alias("queries"))
        sizes = spark.createDataFrame([(c, -(-int(n) // most)) for c, n in enumerate(self.counts) if n], "cell int, rows int")
        split = F.broadcast(wanted.join(F.broadcast(sizes), "cell"))  # a row for each cell
        dealt = lambda parts, seed: F.pmod(F.xxhash64("__id", F.lit(seed)), F.col(parts)).cast("int")
        copies = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
        left = each.join(split, "cell").select("cell", dealt("queries", 5).alias("a"), copies("rows").alias("b"), "__id", "v", "reach")
        right = self.rows.join(split, "cell").select("cell", copies("queries").alias("a"), dealt("rows", 6).alias("b"), "__id", "v", "y")
        p = self.p

        def run(a: pa.Table, b: pa.Table) -> pa.Table:
            own, lists = a["__id"].to_numpy(), []
            if a.num_rows and b.num_rows:
                x, reach, y, ids, ys = matrix(a["v"]), a["reach"].to_numpy().astype(float), matrix(b["v"]), b["__id"].to_numpy(), b["y"].to_numpy()
                reach = np.where(np.isnan(reach), np.inf, reach)
                for at in range(0, len(own), STEP):
                    query, row, d = near_rows(x[at : at + STEP], reach[at : at + STEP], own[at : at + STEP], y, ids, k, p, apart)
                    found = pa.StructArray.from_arrays([pa.array(d, pa.float64()), pa.array(ids[row], pa.int64()), pa.array(ys[row], pa.int64())], names=["d", "i", "y"])
                    steps = np.searchsorted(query, np.arange(min(STEP, len(own) - at) + 1))
                    lists.append(pa.ListArray.from_arrays(pa.array(steps, pa.int32()), found))
            kind = pa.list_(pa.struct([("d", pa.float64()), ("i", pa.int64()), ("y", pa.int64())]))
            near = pa.chunked_array([x.cast(kind) for x in lists], kind)
            return pa.table({"__id": pa.array(own if lists else own[:0], pa.int64()), "near": near})

        return left.groupBy("cell", "a", "b").cogroup(right.groupBy("cell", "a", "b")).applyInArrow(run, f"__id long, near {NEAR}").where(F.size("near") > 0)

    def nearest(self, queries: DataFrame, k: int, *, exact: bool = True, probes: int = 1, apart: int | None = None) -> DataFrame:
        """__id, near: the k nearest rows as (d, i, y) of each query (__id long, v array<double>), by distance, then id.

        ``apart``: rows don't count whose id is the query's, but for so many of
        the lowest bits (0: the query's own row). Queries that no row counts
        for are left out.
        """
        best = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)
        asked = queries.select("__id", "v", F.lit(None).cast("double").alias("reach"))
        first = stored(self.met(stored(self.visits(asked, k, probes), "visits"), k, apart).groupBy("__id").agg(best.alias("near")), "near")
        if not exact:
            return first
        bound = first.select("__id", F.when(F.size("near") >= k, F.element_at("near", -1)["d"]).otherwise(F.lit(float("inf"))).alias("reach"))
        again = queries.select("__id", "v").join(bound, "__id", "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf"))))
        rest = stored(self.visits(again, k, probes).where(F.size("cells") > 0), "visits")
        return first.union(self.met(rest, k, apart)).groupBy("__id").agg(best.alias("near"))


def local_outlier_factors(rows: DataFrame, k: int = 20, cell_rows: int | None = None) -> DataFrame:
    """__id, lof: the density of a row's k exact neighbours over its own, of rows (__id long, v array<double>)."""
    index = CellIndex.build(rows.withColumn("y", F.lit(0).cast("long")), cell_rows=cell_rows)
    if index is None:
        return rows.select("__id", F.lit(1.0).alias("lof"))
    near = stored(index.nearest(rows, k, apart=0))
    reach = near.select(F.col("__id").alias("i"), F.element_at("near", -1)["d"].alias("reach"))
    pairs = near.select("__id", F.inline("near"))
    dense = stored(pairs.join(reach, "i").groupBy("__id").agg((1 / (F.avg(F.greatest("d", "reach")) + 1e-10)).alias("density")))
    others = dense.select(F.col("__id").alias("i"), F.col("density").alias("other"))
    own = pairs.join(others, "i").groupBy("__id").agg(F.avg("other").alias("other"))
    return own.join(dense, "__id").select("__id", (F.col("other") / F.col("density")).alias("lof"))


def votes(near: Column, classes: int, weights: str = "uniform") -> Column:
    """Each class's share of the neighbours' votes; ``distance``: weighted by its inverse, where equal rows alone count if there are any."""
    exact = F.exists(near, lambda s: s["d"] == 0)
    weight = (lambda s: F.lit(1.0)) if weights == "uniform" else lambda s: F.when(exact, F.when(s["d"] == 0, 1.0).otherwise(0.0)).otherwise(1 / s["d"])
    total = F.aggregate(near, F.lit(0.0), lambda t, s: t + weight(s))
    own = lambda c: F.aggregate(near, F.lit(0.0), lambda t, s: t + F.when(s["y"] == c, weight(s)).otherwise(0.0))
    return F.array(*[own(c) / total for c in range(classes)])


class _Settings(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol):
    k = Param(Params._dummy(), "k", "neighbours that vote", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "uniform or distance", TypeConverters.toString)
    p = Param(Params._dummy(), "p", "1 for Manhattan, 2 for Euclidean distances", TypeConverters.toInt)
    exact = Param(Params._dummy(), "exact", "whether all cells that may hold neighbours are visited", TypeConverters.toBoolean)
    probes = Param(Params._dummy(), "probes", "cells that a query visits at least", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(k=5, weights="uniform", p=2, exact=True, probes=1)


class NearestNeighboursClassifier(Estimator, _Settings):
    """Classes 0, 1, ... by the votes of the k nearest training rows."""

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", k: int = 5, weights: str = "uniform", p: int = 2, exact: bool = True, probes: int = 1):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> NearestNeighboursModel:
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("v"), F.col(self.getLabelCol()).cast("long").alias("y"))
        rows = stored(rows.withColumn("__id", F.monotonically_increasing_id()), "training")
        index = CellIndex.build(rows, self.getOrDefault(self.p))
        if index is None:
            raise ValueError("no rows to vote")
        return self._copyValues(NearestNeighboursModel(index, rows.agg(F.max("y")).first()[0] + 1))


class NearestNeighboursModel(Model, _Settings):
    def __init__(self, index: CellIndex, classes: int):
        super().__init__()
        self._defaults()
        self.index, self.classes = index, classes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Rows are stored with ids first, so that these stay the same however often they are read."""
        rows = stored(dataset.withColumn("__id", F.monotonically_increasing_id()), "queries")
        value = self.getOrDefault
        near = self.index.nearest(rows.select("__id", vector_to_array(self.getFeaturesCol()).alias("v")), value(self.k), exact=value(self.exact), probes=value(self.probes))
        share = votes(F.col("near"), self.classes, value(self.weights))
        voted = near.select("__id", share.alias("__share"))
        out = rows.join(voted, "__id").drop("__id")
        most = (F.array_position("__share", F.array_max("__share")) - 1).cast("double")
        return out.withColumn(self.getProbabilityCol(), array_to_vector("__share")).withColumn(self.getPredictionCol(), most).drop("__share")
