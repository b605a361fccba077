"""Scores of texts in batches, by a stored model that each worker loads once."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from inkwell.operators import linear
from inkwell.operators.picks import first_wins
from inkwell.sources.storage import shared_folder, stored

#: Buckets of a text's words: two to this many.
BITS = 10
BATCH = 256
WORD = re.compile(r"\w+")
#: Labelled texts that a model is trained on at most.
MOST_ROWS = 5000


def word_shares(texts: list[str], bits: int = BITS) -> np.ndarray:
    """[text, bucket]: unit counts of the texts' hashed words, in lower case."""
    out = np.zeros((len(texts), 1 << bits))
    for row, text in zip(out, texts, strict=True):
        np.add.at(row, [zlib.crc32(w.encode()) & ((1 << bits) - 1) for w in WORD.findall((text or "").lower())], 1)
    return out / np.maximum(np.linalg.norm(out, axis=1), 1e-12)[:, None]


class TextModel(NamedTuple):
    """Logistic regression on hashed words: weights, the intercept first."""

    weights: np.ndarray

    @property
    def bits(self) -> int:
        return (len(self.weights) - 1).bit_length() - 1

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-(word_shares(texts, self.bits) @ self.weights[1:] + self.weights[0])))

    def save(self, spark: SparkSession) -> str:
        """The path, in the shared folder, that the model was written to."""
        path = shared_folder(spark, "text-model")
        spark.createDataFrame([(i, float(w)) for i, w in enumerate(self.weights)], "place int, weight double").coalesce(1).write.parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextModel:
        return cls(np.array([r.weight for r in spark.read.parquet(path).orderBy("place").collect()]))


def trained(rows: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id", *, bits: int = BITS, l2: float = 1e-4, most: int = MOST_ROWS) -> TextModel:
    """A model of the labels 0 and 1, from up to ``most`` rows with the lowest hashes of their keys; classes weigh the same."""

    @F.arrow_udf("array<double>")
    def shares(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            made = word_shares(batch.to_pylist(), bits)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) << bits, pa.int32()), pa.array(made.ravel(), pa.float64()))

    picked = rows.where(F.col(label).isNotNull()).orderBy(F.xxhash64(key, F.lit(42)), key).limit(most)
    data = stored(picked.select(shares(F.col(text)).alias("x"), F.col(label).cast("int").alias("label"), F.lit(0).alias("fold")), "shares")
    bulk = linear.Bulk(data, [linear.Problem("x", "logistic", 0.0, l2, True)])
    return TextModel(bulk.fit()[0])


def scored(rows: DataFrame, make_scorer: Callable[[], Callable[[list[str]], np.ndarray]], text: str = "text", out: str = "score", batch: int = BATCH) -> DataFrame:
    """``rows`` with the scores of their texts; a worker calls ``make_scorer`` once and its result for each batch. Null texts are empty."""

    def make():
        scorer = make_scorer()
        return lambda texts: np.asarray(scorer(list(texts)), dtype=np.float64)

    return rows.withColumn(out, predict_batch_udf(make, return_type=DoubleType(), batch_size=batch)(F.coalesce(F.col(text), F.lit(""))))


def scored_by(rows: DataFrame, path: str, text: str = "text", out: str = "score", batch: int = BATCH) -> DataFrame:
    """``rows`` with the probabilities of the model stored at ``path``; the model, of a fixed size, is broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast(TextModel.load(rows.sparkSession, path))
    return scored(rows, lambda: shared.value.probabilities, text, out, batch)


def candidate_text(symbol: Column, n: Column, abstract: Column) -> Column:
    """A candidate as it is scored: symbol and count, a period, and the abstract."""
    return F.concat(symbol, F.lit(" "), n.cast("string"), F.lit(". "), F.coalesce(abstract, F.lit("")))


def best_candidates(mentions: DataFrame, texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, symbol, n, text: the most frequent symbol of each text (of equal ones the first in order), as it is scored.

    One row a text, so no text is repeated for its other candidates.
    """
    best = first_wins(mentions, [key], [F.desc("n"), "token"]).select(F.col(key).alias("__key"), F.col("token").alias("symbol"), "n")
    met = texts.select(key, text).join(best, F.col(key) == F.col("__key"))
    return met.select(key, "symbol", "n", candidate_text(F.col("symbol"), F.col("n"), F.col(text)).alias("text"))
