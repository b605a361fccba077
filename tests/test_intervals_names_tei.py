"""Sweeps over intervals, names in texts, and TEI documents, against plain versions."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.operators import dictionary, intervals
from inkwell.sources import papers, tei


@pytest.mark.parametrize("bits", [0, 3, 16])
def test_points_in_intervals(spark, bits):
    rng = random.Random(bits)
    points = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(-20, 60)]), i) for i in range(500)]
    spans = [(rng.choice(["a", "b", None]), a := rng.randrange(-25, 60), rng.choice([None, a, a - 2, a + 1, a + 9, a + 30])) for _ in range(60)]
    left = spark.createDataFrame(points, "k string, pos int, n int").withColumn("start", F.lit("clash")).repartition(3)
    right = spark.createDataFrame(spans, "k string, start int, end int").repartition(2)
    found = {r.n: r.inside for r in intervals.covered(left, right, "k", bits=bits).collect()}
    expected = {n: k is not None and p is not None and any(k == s and e is not None and a <= p < e for s, a, e in spans) for k, p, n in points}
    assert found == expected and len(set(expected.values())) == 2
    assert intervals.covered(left.limit(0), right, "k").count() == 0
    assert not any(r.inside for r in intervals.covered(left, right.limit(0), "k").collect())


def test_many_spans_over_a_point_make_no_pairs(spark):
    points = spark.range(2000).select(F.lit("a").alias("k"), F.lit("t").alias("token"), F.col("id").alias("pos"))
    spans = spark.range(2000).select(F.lit("a").alias("k"), F.lit(0).alias("start"), F.lit(2000).alias("end"))
    plan = intervals.covered(points, spans, "k")
    assert "Join" not in plan._jdf.queryExecution().toString() and plan.where("inside").count() == 2000
    assert [r.token for r in papers.page_only(points, spans, "k").collect()] == ["t"]
    assert papers.page_only(points, spans.withColumn("end", F.lit(1999)), "k").count() == 0


def plain_matches(names, text, fold):
    low = dictionary.lowered if fold else str
    seen, behind, out = low(text), 0, []
    split = lambda i: 0 < i < len(seen) and seen[i].isalnum() and seen[i - 1].isalnum()
    for at in range(len(seen)):
        fits = [n for n in names if n and seen.startswith(low(n), at) and not split(at) and not split(at + len(n))]
        if at >= behind and fits:
            best = max(fits, key=lambda n: (len(n), n))
            out.append((best, at, at + len(best)))
            behind = at + len(best)
    return out


ALPHABET = "ab1-_. é(ß"


@settings(max_examples=400, deadline=None)
@given(st.sets(st.text(ALPHABET, min_size=1, max_size=5), max_size=12), st.text(ALPHABET, max_size=40), st.booleans())
def test_name_index_equals_all_names(names, text, fold):
    assert list(dictionary.NameIndex.of(names, fold).find(text)) == plain_matches(names, text, fold)


@pytest.mark.parametrize("fold", [False, True])
def test_matches_in_parts_equal_those_of_one_index(spark, fold):
    rng = random.Random(7)
    words = ["unc", "Unc", "unc-119", "ed3", "x", "lin", "(", "C.", "elegans", "12", "lé"]
    names = sorted({" ".join(rng.choices(words, k=rng.randrange(1, 4))) for _ in range(120)})
    texts = [(i % 40 if i else None, " ".join(rng.choices(words, k=rng.randrange(0, 40)))) for i in range(90)] + [(7, None), (8, "")]
    docs = spark.createDataFrame(texts, "doc_id int, text string").withColumns({c: F.lit(1) for c in ("name", "start", "__part")}).repartition(3)
    listed = spark.createDataFrame([(n,) for n in [*names, None, "", names[0]]], "name string")
    expected = sorted(((k, *m) for k, t in texts for m in plain_matches(names, t or "", fold)), key=str)
    for most in (1000, 13):
        found = dictionary.longest_matches(docs, listed, fold=fold, most=most)
        assert sorted((tuple(r) for r in found.collect()), key=str) == expected and found.columns == ["doc_id", "name", "start", "end"]
    assert dictionary.longest_matches(docs, listed.limit(0)).count() == 0 and dictionary.longest_matches(docs.limit(0), listed, most=13).count() == 0


def test_long_lists_take_few_bytes():
    rng = np.random.default_rng(0)
    names = [f"{p}-{n} protein" for p, n in zip(rng.integers(0, 5000, 100_000).tolist(), range(100_000), strict=True)]
    index = dictionary.NameIndex.of(names)
    held = sum(a.nbytes for a in index if isinstance(a, np.ndarray)) + len(index.data)
    assert held < 45 * len(names) and index.shown is None
    assert [m[0] for m in index.find(f"see {names[77]} and {names[99]}s, {names[5]}.")] == [names[77], names[5]]


CASES = {
    "<TEI><text><body><list><item><p>one</p> two</item><item>a<item>b</item>c</item></list></body></text></TEI>": "one two. abc.",
    "<TEI><text><body><div><head>H</head><p>see <formula>x</formula> and rest.</p></div></body></text></TEI>": "see x and rest. x. H.",
    "<TEI><text><body><p xml:id='a/b'>kept</p><p/><p> </p><note place='foot'><p>n</p></note></body></text></TEI>": "kept. n.",
    "<TEI><text><body><figure><head>F</head><figDesc>d</figDesc><table><head>T</head><row><cell>1</cell><cell/></row></table></figure></body></text></TEI>": "1. d. F. T.",
    "<tei:TEI xmlns:tei='u'><tei:text><tei:body><tei:p>a<tei:lb/>b &copy; &amp;lt; [c]</tei:p></tei:body></tei:text></tei:TEI>": "ab © c .",
    "<TEI><teiHeader><abstract><p>A</p></abstract></teiHeader><text><front><p>no</p></front><body><p>yes!</p><p>cut <hi>he": "A. yes!. cut he.",
    "no markup": "",
    "": "",
}


@pytest.mark.parametrize("xml", CASES)
def test_tei_parts(xml):
    assert tei.read(xml)[2] == CASES[xml]


def test_tei_titles_abstracts_and_columns(spark):
    own = "<TEI><teiHeader><title>T <hi>one</hi></title><abstract><div><p>A.</p><p>B <b>c</b></p></div></abstract></teiHeader><text><body/></text></TEI>"
    rows = [(1, own), (2, None), (3, own.replace("<title>", "<title>series</title><titleStmt><title>").replace("</title><abstract>", "</title></titleStmt><abstract>"))]
    found = {r.id: (r.title, r.abstract, r.fulltext) for r in tei.tei(spark.createDataFrame(rows, "id int, text string")).collect()}
    assert found == {1: ("T one", "A. B c", "A. B c."), 2: (None, None, None), 3: ("T one", "A. B c", "A. B c.")}
    assert tei.tei(spark.createDataFrame([], "text string")).count() == 0


def test_attribute_tokens():
    xml = """<TEI><biblStruct xml:id="b117"><biblScope unit="page">e1370</biblScope><biblScope unit="volume">e2222</biblScope></biblStruct>
    <ref target="#b12" n="unc119x">b45 and fig1 and e1500</ref><biblScope unit="pages">e1500 e901</biblScope><p xml:id="sec3x2">iv2</p></TEI>"""
    assert tei.attribute_tokens(xml) == ["b45", "e1500", "e2222", "iv2", "unc119x"]
    assert tei.read(xml, attributes=True)[2].endswith("b45. e1500. e2222. iv2. unc119x.")
    assert tei.attribute_tokens("<p>e123</p>") == ["e123"] and not re.search("e1370", " ".join(tei.attribute_tokens(xml)))
