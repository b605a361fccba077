"""Allele rules, windows and chains against plain versions."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.functions import alleles
from inkwell.plans import papers


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["e1", "E1", " ", "\n", "x", "e12", ".", "control strain ", "y" * 30, "z" * 48]), max_size=25).map("".join), st.integers(0, 60))
def test_windows_equal_those_of_a_pattern(text, reach):
    expected = [m[0] for m in re.finditer(rf".{{0,{reach}}}\be1\b.{{0,{reach}}}", text, re.I)]
    assert list(alleles.windows(text, "e1", reach)) == expected


@pytest.mark.parametrize("case", papers.CASES, ids=lambda c: str(c[0]))
def test_rules_hold_within_other_text(case):
    _, sentence, name, reason = case
    for text in (sentence, f"Some words of a paper.\n{sentence}\nAnd more words.", f"{'Long text of no concern. ' * 200}\n{sentence}"):
        assert alleles.rejection(text, name) == reason
    assert alleles.rejection(None, name) is None and alleles.rejection(sentence, "") is None


def test_the_first_rule_gives_the_reason():
    text = "unc-119(ed3) is identical to ed3, a positive control. Figure 2 ed3."
    assert alleles.rejection(text, "ed3") == "background marker (ed3)"
    assert alleles.rejection("e1370 was used as a control. e1370 e1370 of daf-2 were studied far from that other mention of it here.\ne1370\ne1370", "e1370") is None


def test_documents_of_many_names(spark):
    rows = [(1, "daf-2(e1370) and unc-119(ed3)", ["e1370", "ed3", "e1370", "", None, "zz1"]), (1, "ok99 was a positive control", ["ok99"]), (2, None, ["a1"]), (3, "text", None), (None, "gfp was seen", ["gfp"])]
    docs = spark.createDataFrame(rows, "doc_id int, text string, names array<string>").repartition(2)
    expected = Counter([(1, "e1370", None), (1, "ed3", "background marker (ed3)"), (1, "zz1", None), (1, "ok99", "control allele (ok99)"), (2, "a1", None), (None, "gfp", "reagent name (gfp)")])
    found = alleles.judged(docs, "text", "names", "doc_id")
    assert Counter(tuple(r) for r in found.collect()) == expected
    assert {tuple(r) for r in alleles.reasons(found).collect()} == {("background marker", 1), ("control allele", 1), ("reagent name", 1)}
    listed = spark.createDataFrame([("ed3",), ("gfp",), ("ed3",)], "name string")
    assert Counter(r.name for r in alleles.judged(docs, "text", "names", "doc_id", listed).collect()) == {"ed3": 1, "gfp": 1}
    assert alleles.judged(docs.limit(0), "text", "names", "doc_id").count() == 0


def test_chain():
    text = "daf-2(e1370) and ok1255 in unc-119(ed3), Figure 1 b2."
    assert alleles.chained(text, ["e1370.", "b2"]) == ["e1370", "daf-2", "ok1255", "unc-119", "ed3"]
    assert alleles.chained("no names", ["x12.", "x12"]) == ["x12"] and alleles.chained(None, []) == []
