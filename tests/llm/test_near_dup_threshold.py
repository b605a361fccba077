"""The pipeline's near-duplicate stage at its own threshold, against a plain version."""

from __future__ import annotations

import corpus_pipeline
from inkwell.llm import near_dup


def test_bands_and_cut_offs_follow_the_threshold():
    assert [near_dup.bands_of(p) for p in (85, 80)] == [(28, 6), (34, 5)]
    assert [near_dup.least_estimate(85, *s) for s in (near_dup.SHORT, near_dup.LONG)] == [0.77, 0.80]
    assert [near_dup.least_estimate(80, *s) for s in (near_dup.SHORT, near_dup.LONG)] == [0.70, 0.73]


def test_pairs_at_the_pipelines_threshold(spark):
    """Pairs of similarity 0.80 exactly (36 of 45 shingles) are links, pairs of 0.76 (35 of 46) aren't."""
    rows = []
    for pair in range(60):
        own = [f"p{pair}w{k}" for k in range(44)]
        shared = 40 if pair % 2 else 39
        other = own[:shared] + [f"p{pair}x{k}" for k in range(45 - shared)]
        rows += [(2 * pair, " ".join(own)), (2 * pair + 1, " ".join(other))]
    sets = {k: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for k, t in rows}
    linked = {k for k in range(0, 120, 2) if 100 * len(sets[k] & sets[k + 1]) >= 80 * len(sets[k] | sets[k + 1])}
    assert len(linked) == 30
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_dup_stage(spark, docs, "").collect()}
    assert kept == set(range(120)) - {k + 1 for k in linked}
