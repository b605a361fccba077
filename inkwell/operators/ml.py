"""Splits, scores, predictions and outliers of topic and priority classifiers."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators import neighbours, robust
from inkwell.sources.storage import stored

SEED = 42
#: A class's shuffled order is cut into two to this many buckets.
BUCKET_BITS = 8
FOLDS = 5


def md5_order(key: str, seed: int) -> Column:
    """The first half of the MD5 of ``key:seed`` as a signed number, which other engines can make, too."""
    digits = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    high, low = (F.conv(F.substring(digits, k, 8), 16, 10).cast("long") for k in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def with_class_rank(df: DataFrame, label: str, key: str, seed: int = SEED, order: Column | None = None) -> DataFrame:
    """``df`` with ``__r``, a row's place in a shuffled order of its class from 1 (a function of key and seed), and ``__n``, the class's size.

    The order is that of a hash (``order``, a long, if given) and, where it is
    equal, of the key. The hash's high bits cut each class into buckets: rows
    are ranked within a bucket, after the buckets before it, so no task holds a
    class.
    """
    hashed = F.xxhash64(key, F.lit(seed)) if order is None else order
    drawn = df.withColumn("__h", hashed).withColumn("__b", F.shiftright("__h", 64 - BUCKET_BITS).cast("int"))
    sizes = drawn.groupBy(label, "__b").agg(F.count("*").alias("__size"))
    own = Window.partitionBy(label)
    before = own.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col(label).alias("__label"), F.col("__b").alias("__bucket"), F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__base"), F.sum("__size").over(own).alias("__n"))
    place = F.row_number().over(Window.partitionBy(label, "__b").orderBy("__h", key))
    met = F.col(label).eqNullSafe(F.col("__label")) & (F.col("__b") == F.col("__bucket"))
    # At most classes x buckets rows: a bounded broadcast.
    ranked = drawn.withColumn("__place", place).join(F.broadcast(bases), met)
    return ranked.withColumn("__r", F.col("__base") + F.col("__place")).drop("__h", "__b", "__place", "__label", "__bucket", "__base")


def stratified_split(df: DataFrame, label: str, key: str, share: float = 0.2, seed: int = SEED) -> DataFrame:
    """``df`` with ``held_out``: about ``share`` of each class."""
    return with_class_rank(df, label, key, seed, md5_order(key, seed)).withColumn("held_out", F.col("__r") <= F.round(F.col("__n") * share)).drop("__r", "__n")


def folds(df: DataFrame, label: str, key: str, k: int = FOLDS, seed: int = SEED) -> DataFrame:
    return with_class_rank(df, label, key, seed, md5_order(key, seed)).withColumn("fold", ((F.col("__r") - 1) % k).cast("int")).drop("__r", "__n")


def undersampled(df: DataFrame, label: str, key: str, large: Any, like: Any, seed: int = SEED) -> DataFrame:
    """At most as many rows of class ``large`` as class ``like`` has."""
    counts = df.where(F.col(label) == F.lit(like)).agg(F.count("*").alias("__most"))
    ranked = with_class_rank(df, label, key, seed, md5_order(key, seed)).crossJoin(F.broadcast(counts))  # one row
    return ranked.where((F.col(label) != F.lit(large)) | (F.col("__r") <= F.col("__most"))).drop("__r", "__n", "__most")


def penalised(test: Column, cv: Column) -> Column:
    """0.7 test + 0.3 cv, less twice what their gap exceeds 0.05 by."""
    return 0.7 * test + 0.3 * cv - 2 * F.greatest(F.lit(0.0), cv - test - 0.05)


def ranked_models(scores: DataFrame) -> DataFrame:
    """name, test, cv, score (to nine places), rank; ties go to the first name. A row for each model: few."""
    scored = scores.withColumn("score", F.round(penalised(F.col("test"), F.col("cv")), 9))
    return scored.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "name")))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """class, precision, recall, f1, support; zero where undefined."""
    both = df.select(F.explode(F.array(F.struct(F.col(label).alias("c"), F.lit(1).alias("t"), F.lit(0).alias("p")), F.struct(F.col(predicted).alias("c"), F.lit(0).alias("t"), F.lit(1).alias("p")))).alias("x"), (F.col(label) == F.col(predicted)).alias("same"))
    sums = both.groupBy(F.col("x.c").alias("class")).agg(F.sum("x.t").alias("support"), F.sum("x.p").alias("predicted"), F.sum(F.when(F.col("same"), F.col("x.t")).otherwise(0)).alias("hit"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    p, r = ratio(F.col("hit"), F.col("predicted")), ratio(F.col("hit"), F.col("support"))
    return sums.select("class", p.alias("precision"), r.alias("recall"), ratio(2 * p * r, p + r).alias("f1"), "support")


def features(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    """Blocks in the given order as one vector; arrays become vectors first."""
    kinds = dict(df.dtypes)
    ready = df
    for c in columns:
        if kinds[c].startswith("array"):
            ready = ready.withColumn(c, array_to_vector(F.transform(c, lambda x: x.cast("double"))))
    return VectorAssembler(inputCols=columns, outputCol=out).transform(ready)


def f1(predicted: DataFrame, label: str = "label") -> float:
    rows = {r["class"]: r["f1"] for r in confusion(predicted, label, "prediction").collect()}  # a row for each class
    return float(rows.get(1, rows.get(1.0, 0.0)) if len(rows) <= 2 else np.mean(list(rows.values())))


def predict(model: Transformer | PipelineModel, data: DataFrame) -> DataFrame:
    """``data`` with score = P(class 1) (or the sigmoid of the margin) and label = score >= 0.5."""
    out = model.transform(data)
    if "probability" in out.columns:
        score = vector_to_array("probability")[1]
    else:
        score = 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))
    return out.withColumn("score", score).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def predict_class(model: Transformer, data: DataFrame) -> DataFrame:
    """``data`` with predicted and score, the probability of the predicted class."""
    out = model.transform(data)
    return out.withColumn("predicted", F.col("prediction").cast("int")).withColumn("score", F.get(vector_to_array("probability"), F.col("prediction").cast("int")))


def without_outliers(data: DataFrame, method: str | None, contamination: float = 0.1, vector: str = "features") -> DataFrame:
    """``data`` without the ``contamination`` share of rows that lie farthest out; unknown methods change nothing.

    ``elliptic``: Mahalanobis distance by the minimum covariance determinant.
    ``forest``: path lengths in random isolation trees, grown on a bounded
    sample and applied in Arrow batches. ``lof``: exact local outlier factors
    among all rows. The reference's names of the first two are accepted.
    """
    method = {"elliptic_envelope": "elliptic", "isolation_forest": "forest"}.get(method, method)
    if method == "lof":
        data = stored(data.withColumn("__id", F.monotonically_increasing_id()))
        far = neighbours.local_outlier_factors(data.select("__id", vector_to_array(vector).alias("v")))
        scored = data.join(far.withColumnRenamed("lof", "__far"), "__id").drop("__id")
    elif method == "elliptic":
        scatter = robust.minimum_covariance_determinant(data.select(vector_to_array(vector).alias("v")))
        if scatter is None:
            return data
        scored = data.withColumn("__far", robust.squared_distance(scatter, vector_to_array(vector)))
    elif method == "forest":
        sample = np.array([r[0].toArray() for r in data.select(vector).orderBy(F.xxhash64(vector_to_array(vector))).limit(256).collect()])
        trees = [isolation_tree(sample, np.random.default_rng(SEED + t)) for t in range(50)] if len(sample) else []

        @F.pandas_udf("double")
        def depth(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield -pd.Series([np.mean([path_length(t, np.asarray(v)) for t in trees]) for v in batch], dtype=float)

        scored = data.withColumn("__far", depth(vector_to_array(vector)))
    else:
        return data
    scored = stored(scored, "distances")
    cut = scored.agg(F.percentile_approx("__far", 1 - contamination, 10000)).first()[0]
    return scored.where(F.col("__far") <= F.lit(cut)).drop("__far")


def isolation_tree(rows: np.ndarray, rng: np.random.Generator, depth: int = 0, most: int = 8):
    """(dimension, threshold, low, high), or the size of a leaf."""
    if depth >= most or len(rows) < 2:
        return len(rows)
    d = int(rng.integers(rows.shape[1]))
    low, high = rows[:, d].min(), rows[:, d].max()
    if low == high:
        return len(rows)
    t = float(rng.uniform(low, high))
    return d, t, isolation_tree(rows[rows[:, d] < t], rng, depth + 1, most), isolation_tree(rows[rows[:, d] >= t], rng, depth + 1, most)


def path_length(tree, v: np.ndarray) -> float:
    depth = 0
    while isinstance(tree, tuple):
        d, t, low, high = tree
        tree, depth = (low if v[d] < t else high), depth + 1
    return depth + (2 * (np.log(tree - 1) + 0.5772) - 2 * (tree - 1) / tree if tree > 1 else 0.0)
