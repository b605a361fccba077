"""The pipeline's stages on the smallest documents, each against a plain version of its decisions."""

from __future__ import annotations

import corpus_pipeline
from inkwell.llm import common, mixing, near_dup, packing, pii, quality
from tests.conftest import SF


def test_stages(spark, tmp_path):
    docs = common.documents(spark, SF)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        made.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == docs.columns
        kept[name] = (docs, out)
        docs = out
    before, after = kept["quality_rules"]
    model = quality.quality_model(before, common.labels(spark, SF))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in quality.score(before, model).where("kept").collect()}
    before, after = kept["near_dup"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in near_dup.components(before, percent=corpus_pipeline.NEAR_PERCENT).where("kept").collect()}
    before, after = kept["pii"]
    crf = pii.trained()
    texts = {r.doc_id: pii.redact_text(r.text, pii.find(r.text, crf)[1]) for r in before.collect()}
    assert {r.doc_id: r.text for r in after.collect()} == texts
    before, after = kept["mixing"]
    assert {r.text for r in after.collect()} <= {r.text for r in before.collect()} and after.groupBy("doc_id").count().where("count > 3").count() == 0
    before, after = kept["packing"]
    assert after.groupBy("doc_id").count().count() == before.select("doc_id").distinct().count()
    assert after.agg({"length": "max"}).first()[0] <= packing.CAPACITY
    assert mixing.MOST == 3
