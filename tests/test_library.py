"""References' files, requests, writes, models and vectors beyond what SQL compares."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from inkwell.operators import ml, references, taxonomy
from inkwell.plans import library, models, registry
from inkwell.sources import models as stored_models
from inkwell.sources import papers

from .conftest import SF


@pytest.mark.parametrize("name", ["main_markdown_files", "main_pdf_files", "scoped_tei_files", "supplement_files", "reference_embedding_files", "curated_taxonomy", "lineage_records", "labels_from_csv"])
def test_queries_have_rows(spark, name):
    assert registry.queries()[name](spark, SF).limit(1).count() == 1


def test_every_kind_and_outcome_occurs(spark):
    assert {r.status for r in library.manual_indexing_results(spark, SF).collect()} == {"created", "exists", "invalid"}
    assert any(r.file_id is not None for r in library.reference_embedding_files(spark, SF).collect())


def test_conversion_outcomes(spark):
    rows = [
        ("a", 0, 0.0, 200, "running", []), ("a", 1, 15.0, 200, "running", [references.MAIN_TEXT]), ("a", 2, 30.0, 200, "no_sources", []), ("b", 0, 0.0, 202, "running", None),
        ("c", 0, 0.0, 503, "converted", None), ("d", 0, 1200.0, 200, "running", []), ("e", 0, 0.0, None, None, None), ("f", 0, 1300.0, 200, None, None),
    ]
    polls = spark.createDataFrame(rows, "curie string, seq int, elapsed double, http int, status string, converted_classes array<string>")
    outcomes = lambda **k: {r.curie: r.outcome for r in references.conversion_outcomes(polls, **k).collect()}
    assert outcomes() == {"a": "converted", "b": "running", "c": "failed", "d": "timeout", "e": "failed", "f": "timeout"}
    assert outcomes(wait_for_supplements=True)["a"] == "no_sources"
    assert references.conversion_outcomes(polls.limit(0)).count() == 0


def test_an_unknown_method_has_no_code(spark):
    wanted = spark.createDataFrame([("telepathy", "WB")], "method string, mod string")
    existing = spark.createDataFrame([], "method string, mod string, source_id long")
    with pytest.raises(Exception, match="telepathy"):
        references.with_source_ids(wanted, existing).collect()


def test_labelled_references(spark):
    rows = [(0, "R1", None, "1"), (1, None, "x1", "1"), (2, "", "x2", "0"), (3, None, "x1", None), (4, "R4", None, None), (5, None, "nowhere", "1"), (6, "R6", "x1", "0")]
    df = spark.createDataFrame(rows, "seq int, curie string, xref string, label string")
    xrefs = spark.createDataFrame([("x1", "X1"), ("x2", "X2")], "xref string, curie string")
    found = lambda start=None: sorted((r.seq, r.curie, r.category) for r in references.labelled_references(df, xrefs, start).collect())
    every = [(0, "R1", "positive"), (1, "X1", "positive"), (2, "X2", "negative"), (4, "R4", "negative"), (6, "R6", "negative")]
    assert found() == every and found("X2") == every[2:] and found("never") == []


def test_a_stored_model_scores_as_before(spark):
    data = ml.stratified_split(models.vector_data(spark, SF), "label", "vec_id")
    fitted = LogisticRegression(regParam=0.01).fit(data.where("not held_out"))
    before = {r.vec_id: round(r.score, 6) for r in ml.predict(fitted, data.where("held_out")).collect()}
    rows = library.stored_model_scores(spark, SF).collect()
    assert {r.vec_id: r.score for r in rows} == pytest.approx(before) and {r.topic for r in rows} == {"halves"}
    with pytest.raises(Exception):
        stored_models.load_model(spark, "/nowhere/at/all")


def test_word_vectors_and_lineages_of_odd_input(spark):
    lines = spark.createDataFrame([("3 2",), ("a 1 2",), ("b 1",), ("c 1 x",), (None,), ("",), ("d -1e-3 2.5 ",)], "value string")
    assert [(r.word, [round(x, 4) for x in r.vec]) for r in papers.word_vectors(lines, 2).orderBy("word").collect()] == [("a", [1.0, 2.0]), ("d", [-0.001, 2.5])]
    records = spark.createDataFrame([(1, None), (2, "not json"), (3, '{"taxonomy_nodes":[{"taxonomy":{"parents":[1,2,"x",3]}}]}')], "taxid int, json string")
    rows = {r.taxid: (r.parent_tid, r.parents, r.rank, r.ranks) for r in taxonomy.lineage(records).collect()}
    assert rows == {1: (None, [], "", []), 2: (None, [], "", []), 3: (None, [3, 2, 1], "", [])}
    assert taxonomy.first_lineage(taxonomy.lineage(records.withColumn("source", F.lit(1)))).count() == 1
