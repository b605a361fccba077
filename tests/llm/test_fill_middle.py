"""Fill-in-the-middle rows against lists of units."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.llm import fill_middle, queries

from ..conftest import SF

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
TEXTS = [
    (1, "The quick brown fox, it's here!\nThe end."), (2, None), (3, ""), (4, " \n\t"), (5, "word" * 50_000 + "é😀 1" * 50_000), (6, "letters"), (7, "a <P> marker"), (8, "<S>"), (9, "x<M>y"),
    (10, "<<S<P<M <S >"), (11, "日本語 text 😀😀 mixed é"), (11, "another text of one key"), (None, "no key here"), (12, "same"), (12, "same"), (-5, "negative key, two  spaces"),
] + [(100 + i, f"text {i}: <{'SPM'[i % 3]} and <{'SPM'[i % 2]}< or >{i}< <<<") for i in range(60)]


def plain(key, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return key, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return key, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abZ<>SPM é😀\n@[`{", max_size=40), min_size=1, max_size=6), st.data())
def test_places_equal_lists_of_units(texts, data):
    runs = fill_middle.Runs.of(texts)
    units = [UNIT.findall(t) for t in texts]
    assert runs.counts().tolist() == list(map(len, units))
    cuts = [data.draw(st.integers(0, len(u))) for u in units]
    assert runs.places(np.array(cuts)).tolist() == [len("".join(u[:k])) for u, k in zip(units, cuts, strict=True)]


def test_rows_and_round_trip(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("key", "n", "form", "output", "row")}).repartition(3)
    made = fill_middle.fill_in_middle(df)
    rows = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows) == Counter(plain(k, t) for k, t in TEXTS)
    assert Counter((r.doc_id, r.back) for r in rows) == Counter((k, t or "") for k, t in TEXTS)
    assert {"plain", "psm", "spm"} == {r.form for r in rows}
    whole = fill_middle.transformed_documents(df)
    assert whole.columns == df.columns and Counter((r.doc_id, r.text, r.n, r.form) for r in whole.collect()) == Counter((k, plain(k, t)[-1], 1, 1) for k, t in TEXTS)
    none = df.limit(0)
    assert fill_middle.fill_in_middle(none).count() == 0 and fill_middle.transformed_documents(none).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>SPMa ", max_size=30).filter(lambda t: not any(m in t for m in fill_middle.MARKERS)), st.integers(0, 30), st.integers(0, 30))
def test_no_marker_arises_where_parts_meet(text, a, b):
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    psm = f"{text[:a]}<S>{text[b:]}<M>{text[a:b]}"
    assert psm.index("<S>") == a and psm.index("<M>") == a + 3 + len(text) - b


def test_the_query_equals_its_sql(spark):
    rows = {tuple(r) for r in fill_middle.op12_fill_in_middle(spark, SF).collect()}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert rows == set(con.execute(queries.oracle_sql()["op12_fill_in_middle"]).fetchall()) and len(rows) > 100
    assert all(r[-1] for r in rows)
