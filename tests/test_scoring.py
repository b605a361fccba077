"""Batch scores by a stored model against scoring in one process."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.operators import dictionary, scoring
from inkwell.plans import texts as plans
from inkwell.sources.tables import table

from .conftest import SF


@pytest.fixture(scope="module")
def labelled(spark):
    good = [(i, f"a calm text about gene number {i} and its work", 1) for i in range(40)]
    bad = [(100 + i, f"buy now cheap offer {i} click here", 0) for i in range(40)]
    return spark.createDataFrame(good + bad + [(900, None, 1), (901, "no label", None)], "doc_id int, text string, label int").repartition(3)


def test_a_stored_model_scores_batches_as_one_process_does(spark, labelled):
    model = scoring.trained(labelled)
    path = model.save(spark)
    back = scoring.TextModel.load(spark, path)
    assert (back.weights == model.weights).all() and back.bits == scoring.BITS
    rows = [(i, t) for i, t in enumerate(["a calm gene", "click here now", "", None, "é" * 3000])]
    df = spark.createDataFrame(rows, "id int, text string").withColumn("x", F.lit(1)).repartition(2)
    found = {r.id: r.score for r in scoring.scored_by(df, path, batch=2).collect()}
    assert found == pytest.approx(dict(enumerate(model.probabilities([t or "" for _, t in rows]).tolist())))
    assert found[0] > 0.5 > found[1]
    assert scoring.scored_by(df.limit(0), path).count() == 0


def test_a_worker_loads_its_model_once(spark):
    def make():
        loaded = []

        def scorer(texts):
            loaded.append(len(texts))
            return np.full(len(texts), float(len(loaded)))

        return scorer

    rows = spark.range(100).select(F.col("id").cast("string").alias("text")).coalesce(1)
    assert scoring.scored(rows, make, batch=10).agg(F.max("score")).first()[0] == 10


def test_candidates_are_the_most_frequent(spark):
    docs = spark.createDataFrame([(1, "b a b a c"), (2, "none"), (3, "c"), (4, None)], "doc_id int, text string")
    mentions = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "c", 1), (3, "c", 1), (4, "d", 1)], "doc_id int, token string, n long")
    assert {tuple(r) for r in scoring.best_candidates(mentions, docs).collect()} == {(1, "a", 2, "a 2. b a b a c"), (3, "c", 1, "c 1. c"), (4, "d", 1, "d 1. ")}


def test_the_query_scores_every_document_with_a_name(spark):
    docs = table(spark, SF, "documents")
    rows = plans.gene_scores(spark, SF).collect()
    found = dictionary.mentions(docs, plans.curated_names(spark, SF)).collect()
    best = {}
    for r in found:
        best[r.doc_id] = min(best.get(r.doc_id, (0, "")), (-r.n, r.token))
    assert {(r.doc_id, r.symbol, r.n) for r in rows} == {(k, t, -n) for k, (n, t) in best.items()}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    right = Counter((r.score >= 0.5) == (labels[r.doc_id] == 1) for r in rows if labels.get(r.doc_id) is not None)
    assert right[True] > 0.85 * sum(right.values())
