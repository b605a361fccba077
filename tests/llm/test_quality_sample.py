"""The quality model is trained on as many labelled rows as there are, up to its documented sample."""

from __future__ import annotations

import inspect

from inkwell.llm import quality


def test_sample_and_steps(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "concat('text ', id) as text")
    labels = spark.range(5000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    texts, good = quality.labelled_sample(docs, labels)
    assert len(texts) == len(good) == 4000
    assert inspect.signature(quality.train).parameters["steps"].default == 150
