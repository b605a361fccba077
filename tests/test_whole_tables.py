"""Queries over whole tables, each against a plain version."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest

from inkwell.operators import vectors
from inkwell.plans import registry, texts

from .conftest import SF

MORE = SF.replace("0.001", "0.01")
MASK = 0xFFFFFFFF


def rows_of(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet").collect()


def murmur3(data: bytes, seed: int = 42) -> int:
    h, whole = seed, len(data) // 4 * 4
    turn = lambda x, r: (x << r | x >> (32 - r)) & MASK
    for at in range(0, whole, 4):
        k = turn(int.from_bytes(data[at : at + 4], "little") * 0xCC9E2D51 & MASK, 15) * 0x1B873593 & MASK
        h = (turn(h ^ k, 13) * 5 + 0xE6546B64) & MASK
    if whole < len(data):
        h ^= turn(int.from_bytes(data[whole:], "little") * 0xCC9E2D51 & MASK, 15) * 0x1B873593 & MASK
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & MASK
    h = (h ^ h >> 13) * 0xC2B2AE35 & MASK
    return h ^ h >> 16


def test_bag_of_words_of_all_documents(spark):
    found = {r.doc_id: r.bow for r in registry.queries()["hashed_bag_of_words"](spark, SF).collect()}
    docs = rows_of(spark, "documents")
    assert set(found) == {d.doc_id for d in docs} and len(found) > 100
    for d in docs:
        counts = Counter(murmur3(t.encode()) % (1 << 18) for t in re.findall(r"\b[\w-]{2,}\b", d.text.lower()))
        size = math.sqrt(sum(n * n for n in counts.values()))
        bow = found[d.doc_id]
        assert bow.size == 1 << 18
        assert dict(zip(bow.indices.tolist(), bow.values.tolist(), strict=True)) == pytest.approx({k: n / size for k, n in counts.items()})


def plain_tokens(text):
    marks = lambda c: unicodedata.category(c)[0] not in "LN"
    for w in re.findall(r"[^\x20\x09-\x0D]+", text):
        while w and marks(w[0]):
            w = w[1:]
        while w and marks(w[-1]):
            w = w[:-1]
        if w:
            yield w.lower()


@pytest.fixture(scope="module")
def counts(spark):
    """doc_id, token -> n for the names of all items."""
    names = {t for r in rows_of(spark, "benchmark") for t in plain_tokens(r.text)}
    assert names > {t for r in rows_of(spark, "benchmark") if r.item_id < 20 for t in plain_tokens(r.text)}
    return Counter((d.doc_id, t) for d in rows_of(spark, "documents") for t in plain_tokens(d.text) if t in names)


def test_mentions_of_all_names(spark, counts):
    found = {(r.doc_id, r.token): r.n for r in registry.queries()["dictionary_mentions"](spark, SF).collect()}
    assert found == {k: n for k, n in counts.items() if n >= 2}


def test_idf_and_gate_of_all_names(spark, counts):
    n_docs, df, sizes = len(rows_of(spark, "documents")), Counter(t for _, t in counts), Counter(k for k, _ in counts)
    idf = {t: math.log((n_docs + 1) / (n + 1)) + 1 for t, n in df.items()}
    found = {r.token: (r.df, r.idf) for r in registry.queries()["document_frequency_idf"](spark, SF).collect()}
    assert {t: n for t, (n, _) in found.items()} == df
    assert {t: x for t, (_, x) in found.items()} == pytest.approx(idf, abs=1e-8)
    scores = {(k, t): n / sizes[k] * idf[t] for (k, t), n in counts.items() if n >= 2}
    gated = {(r.doc_id, r.token): r.tfidf for r in registry.queries()["tfidf_gate"](spark, SF).collect()}
    assert gated == pytest.approx({k: x for k, x in scores.items() if x >= 0.5}, abs=1e-8)


def test_longest_matches_of_all_items(spark):
    names = {n for r in rows_of(spark, "benchmark") for n in (r.text, " ".join(r.text.split(" ")[:3])) if n}
    expected = set()
    for d in rows_of(spark, "documents"):
        text, free = d.text, 0
        spans = [(m.start(), -m.end(), n) for n in names for m in re.finditer(f"(?={re.escape(n)})", text) for m in [re.compile(re.escape(n)).match(text, m.start())]]
        split = lambda i: 0 < i < len(text) and text[i].isalnum() and text[i - 1].isalnum()
        for a, b, n in sorted(s for s in spans if not split(s[0]) and not split(-s[1])):
            if a >= free:
                expected.add((d.doc_id, n, a, -b))
                free = -b
    found = {tuple(r) for r in registry.queries()["dictionary_longest_match"](spark, SF).collect()}
    assert found == expected
    assert any(len(n.split(" ")) > 3 for _, n, _, _ in found)


def test_names_of_all_parts(spark):
    parts = rows_of(spark, "part", MORE)
    exact, folded = {}, {}
    for p in parts:
        if p.p_size < 40:
            curie = f"PART:{p.p_partkey}"
            exact[p.p_name] = max(exact.get(p.p_name, ""), curie)
            folded[p.p_name.upper()] = max(folded.get(p.p_name.upper(), ""), curie)
    expected = set()
    for p in parts:
        name = p.p_name if p.p_partkey % 2 == 0 else p.p_name.upper()
        if curie := exact.get(name) or folded.get(name.upper()):
            expected.add((p.p_partkey, name, curie))
    assert {tuple(r) for r in registry.queries()["name_to_curie_fallback"](spark, MORE).collect()} == expected
    assert max(k for k, _, _ in expected) >= 500


def test_spans_of_all_events(spark):
    at = defaultdict(list)
    last = {}
    for e in rows_of(spark, "events", MORE):
        at[e.user_id, e.event_type].append(e.event_id)
        last[e.user_id] = max(last.get(e.user_id, e.event_id), e.event_id)
    expected = {(k, t) for (k, t), ids in at.items() if max(ids) < last[k]}
    assert expected
    found = [tuple(r) for r in registry.queries()["tokens_inside_spans"](spark, MORE).collect()]
    assert len(found) == len(expected) and set(found) == expected


def test_export_of_all_events(spark):
    events = rows_of(spark, "events")
    expected = Counter()
    for e in events:
        score = e.value if e.value is None else e.value / 100
        level = "UNKNOWN_LEVEL_NONE" if score is None else "neg" if score == 0 else "low" if score < 0.667 else "medium" if score < 0.833 else "high"
        flag, department = ("gene", "cam") if e.event_id % 2 == 0 else ("UNKNOWN_FLAG_ATP:1", "UNKNOWN_ATP_ATP:1")
        expected[int(e.event_id >= 250), f"{e.ts:%y%m%d}\t\t:{e.user_id}\t{flag}:{level}\t{department}"] += 1
    found = Counter((r.part, r.value) for r in registry.queries()["export_lines"](spark, SF).collect())
    assert found == expected and found.total() == len(events) > 500


def test_pivot_of_all_sources(spark):
    docs = rows_of(spark, "documents")
    sources = {d.source for d in docs}
    assert len(sources) > 5
    has = {(d.lang, d.source) for d in docs}
    found = registry.queries()["mod_pivot_matrix"](spark, SF)
    assert set(found.columns) == {"lang", *sources}
    assert {(r.lang, s): r[s] for r in found.collect() for s in sources} == {(x, s): int((x, s) in has) for x, _ in has for s in sources}


def test_concepts_in_all_buckets(spark):
    planes, expected = vectors.projection(64), Counter()
    assert planes.shape == (4, 12, 64)
    for r in rows_of(spark, "embeddings"):
        for t, signs in enumerate(planes @ np.asarray(r.embedding, dtype=float) > 0):
            expected[r.label, t * 4096 + sum(1 << b for b in range(12) if signs[b])] += 1
    assert Counter({(r.label, r.bucket): r.n for r in registry.queries()["lsh_bag_of_concepts"](spark, SF).collect()}) == expected


def test_all_dimensions(spark):
    expected = {r.vec_id: list(r.embedding) for r in rows_of(spark, "embeddings")}
    found = {r.vec_id: [r[f"d{i}"] for i in range(64)] for r in registry.queries()["wide_vectors"](spark, SF).collect()}
    assert set(found) == set(expected) and all(found[k] == pytest.approx(expected[k], abs=1e-6) for k in expected)


def test_twins_in_all_languages(spark):
    expected, langs = {}, set()
    for d in rows_of(spark, "documents"):
        names = set(re.findall("[A-Za-z]{3,}", d.text))
        cased = {n.upper() for n in names if n != n.upper()}
        if left := names - cased:
            expected[d.doc_id] = len(left)
            langs.add(d.lang)
    assert {r.doc_id: r.n for r in registry.queries()["no_shouting_twins"](spark, SF).collect()} == expected and len(langs) > 1


def test_antibody_rules_in_all_languages(spark):
    expected = {}
    for d in rows_of(spark, "documents"):
        found = set()
        for s in re.sub(r"([.!?])[ \t\n\r\f\v]+", "\\1\x01", d.text).split("\x01"):
            low = f" {s.lower()} ".split("\n")[0] + ("\n" if "\n" in s else "")
            for a in texts.FIRST:
                for b in texts.SECOND:
                    if any(re.search(rf"^[^\n]*{x}[ \t\n\r\f\v]([^\n]*){y}[\s.;:,'\")\]}}>?]", low) for x, y in ((a, b), (b, a))):
                        found.add(f"{a} {b}")
        expected[d.doc_id] = ", ".join(sorted(found)) or None
    rows = registry.queries()["antibody_style_rules"](spark, SF).collect()
    assert {r.doc_id: r.note for r in rows} == expected
    assert all(r.negated == (r.note is None) for r in rows)


def test_ranks_are_gapless_and_follow_the_hash(spark):
    from pyspark.sql import functions as F

    from inkwell.operators import dictionary, ml

    df = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 > 0, "a").when(F.col("id") % 20 > 0, "b").alias("c"))
    rows = ml.with_class_rank(df, "c", "k", 9).withColumn("h", F.xxhash64("k", F.lit(9))).collect()
    for c, size in (("a", 2700), ("b", 150), (None, 150)):
        own = sorted((r["h"], r["k"], r["__r"]) for r in rows if r["c"] == c)
        assert [r for _, _, r in own] == list(range(1, size + 1)) and {r["__n"] for r in rows if r["c"] == c} == {size}
    names = spark.createDataFrame([(t,) for t in ("b", "a", "ä", "Z", "a", "zz", "m")], "token string")
    assert {r.token: r.id for r in dictionary.token_ids(names).collect()} == {t: i for i, t in enumerate(sorted({"b", "a", "ä", "Z", "zz", "m"}), 1)}
    assert dictionary.token_ids(names.limit(0)).count() == 0 and ml.with_class_rank(df.limit(0), "c", "k").count() == 0
