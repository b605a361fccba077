"""Each dealt operator against a plain version, with nulls, empty and long texts, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from html import unescape

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.llm import common, fingerprints, html_text, mixing, near_dup, packing, pii, quality, sharding, token_counts, warc, wordbpe

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox, it's here!\nThe end.", "b"), (2, None, "a"), (3, "", None), (4, "   \n\t ", "a"), (5, LONG, "a"), (6, "same same same same same same same same same same", "c"),
    (7, "mail a.b@c.example.org or +1 (555) 123-4567 from 10.0.0.1 card 4111111111111111 token = \"0123456789abcdef0123456789abcdef01234567\"", "b"),
    (8, LONG + " tail", "é"), (9, LONG.replace("w5x5 ", ""), "a"), (9, "two rows of one key", "b"), (10, "two rows of one key", "b"), (10, "two rows of one key", "b"), (None, "no key", "b"),
    (11, "É<|endoftext|>é  ﬁ 日本語 😀 don't #1", "c"), (12, "one", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Also extra columns whose names clash with those that operators make."""
    df = spark.createDataFrame(TEXTS, "doc_id long, text string, source string")
    extra = {c: F.lit(1) for c in ("size", "kept", "sid", "node", "key", "range", "head", "n_tokens", "piece", "hub")}
    return df.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long")).withColumns(extra).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def bpe():
    return wordbpe.word_bpe(wordbpe.default_path())


def ids(bpe, text):
    return bpe.library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="abcé'sTß 1.,-<|endoftx>\n", max_size=80))
def test_own_tokenizer_equals_the_librarys(text):
    bpe = wordbpe.word_bpe(wordbpe.default_path())
    assert np.frombuffer(bpe.encode([text])[0], "<u4").tolist() == ids(bpe, text)


def test_packing(docs, none, bpe):
    rows = packing.pack(docs).collect()
    assert packing.pack(none).count() == 0
    expected = Counter()
    for key, text, _ in TEXTS:
        own = [*ids(bpe, text), 1]
        for k in range(0, len(own), 4096):
            expected[key, k // 4096, k, len(own[k : k + 4096]), zlib.crc32(np.array(own[k : k + 4096], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096


def test_best_fit_takes_the_fullest_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert [bins.place(n) for n in (4, 7, 3)] == [(0, 0), (1, 0), (1, 7)]
    assert bins.place(8) == (2, 0) and bins.place(2) == (2, 8) and bins.place(9) == (3, 0)
    assert bins.place(9) == (4, 0) and bins.place(6) == (0, 4)


def test_token_counts(docs, none, bpe):
    rows = token_counts.count_tokens(docs).collect()
    wanted = Counter((k, len((t or "").encode()), len(ids(bpe, t)), len(ids(bpe, t)) > 2048) for k, t, _ in TEXTS)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == wanted
    assert token_counts.count_tokens(none).count() == 0


def test_sharding(docs, none):
    rows = sharding.shard_rows(docs).collect()
    assert sharding.shard_rows(none).count() == 0 and len(rows) == len(TEXTS)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t, _ in TEXTS)
    heavy = sharding.shard_rows(docs.sparkSession.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")), weights=[1.0, 3.0]).groupBy("shard").count().collect()
    assert 2.5 < {r["shard"]: r["count"] for r in heavy}[1] / {r["shard"]: r["count"] for r in heavy}[0] < 3.6


def test_mixing(docs, none):
    sizes = mixing.document_sizes(docs)
    rows = mixing.taken_words(sizes).collect()
    assert len(rows) == len(TEXTS) and mixing.taken_words(mixing.document_sizes(none)).count() == 0
    n = [len(WORD.findall(t or "")) for _, t, _ in TEXTS]
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((k, m) for (k, _, _), m in zip(TEXTS, n, strict=True))
    source = Counter()
    for (_, _, s), m in zip(TEXTS, n, strict=True):
        source[s] += m
    order = sorted(source, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, dict(weight), sum(n)
    while True:  # water filling, one round at a time
        level = left / (sum(open_.values()) or 1)
        full = [s for s in open_ if open_[s] * level > 3 * source[s]]
        if not full:
            break
        for s in full:
            target[s] = 3 * source[s]
            left -= target[s]
            del open_[s]
    target |= {s: w * level for s, w in open_.items()}
    taken = Counter()
    for r in rows:
        assert r.taken <= 3 * r["size"] and r.target == pytest.approx(target[r.source]) and r.source_size == source[r.source]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 2 * mixing.BLOCK for s in source)
    assert rows == mixing.taken_words(sizes).collect() or sorted(map(str, rows)) == sorted(map(str, mixing.taken_words(sizes).collect()))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and max(Counter(r.doc_id for r in mixed.where("doc_id = 5").collect()).values(), default=0) <= 3


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_permutations(spark, n):
    made = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("p")).collect()
    assert sorted(r.p for r in made) == list(range(n))


def plain_rules(text):
    words = WORD.findall(text or "")
    runs = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    cover = {k + i for k in range(len(words) - 4) if runs[tuple(words[k : k + 5])] > 1 for i in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)


def test_quality(spark, docs, none):
    rows = quality.score(docs, None).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *(r[c] for c in names)) for r in rows) == Counter((k, *plain_rules(t)) for k, t, _ in TEXTS)
    assert all(r.kept == (not r.base_failed) for r in rows) and quality.score(none, None).count() == 0
    kept = quality.kept_documents(docs, None)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)
    good = [f"the plain words of text number {i} go on and on in a calm and usual way here" for i in range(60)]
    bad = [f"BUY!! NOW!! {i} $$$ ### CLICK!! HERE!! %%% WIN!! &&& CASH!! {i}" for i in range(60)]
    model = quality.train(good + bad, np.array([1] * 60 + [0] * 60), steps=60)
    p = model.probabilities(quality.Slice.of([t.encode() for t in ("some calm words of usual text go on here", "WIN!! $$$ NOW!! ### CASH!! CLICK!!")]))
    assert p[0] > 0.5 > p[1]
    assert quality.train(["a"], np.array([1])) is None


def test_quality_on_held_out_labels(spark):
    from tests.conftest import SF

    sf = SF.replace("0.001", "0.01")
    docs, labels = common.documents(spark, sf), common.labels(spark, sf)
    model = quality.quality_model(docs, labels.where("doc_id % 2 = 0"))
    scored = quality.score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    right = scored.select(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("int") + F.when(F.col("base_failed") & (F.col("quality") == 1), 1).otherwise(0))).first()[0]
    assert right > 0.9


def test_near_duplicates(spark, none):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for base in range(12):
        own = list(rng.choice(words, 120))
        for copy in range(8):
            made = list(own)
            for at in rng.choice(120, int(rng.integers(0, 5)), replace=False):
                made[at] = "changed"
            texts.append(" ".join(made).upper() if copy % 3 == 0 else " ".join(made))
    texts += [None, "", "few words", "Few  words", " ", texts[0]]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(3, texts[0]), (3, texts[0]), (None, texts[0]), (None, "alone without a key")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).repartition(3)
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.components(df).collect()}

    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").lower())
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    least = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[top(i)].append(k)
    expected = set()
    for i, (k, _) in enumerate(rows):
        component = min(least[top(i)], default=None) if sets[i] else k
        expected.add((k, len(sets[i]), component, k == component))
    assert found == expected
    assert near_dup.components(none).count() == 0


def test_odd_sketches_estimate_high_similarities():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:-80], rng.integers(0, 2**63, 80, dtype=np.uint64)])
    one, two = near_dup.odd_sketches([a, b])[:, near_dup.SHORT[1] // 64 :].view(np.uint64)
    odd = sum(bin(int(x ^ y)).count("1") for x, y in zip(one, two, strict=True))
    k, bits = near_dup.LONG
    assert 1 + bits / (4 * k) * np.log(1 - 2 * odd / bits) == pytest.approx(920 / 1080, abs=0.05)


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@-_%+ 0123456789()x\n", max_size=60))
def test_patterns_equal_plain_ones(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_pii(docs, none):
    rows = {(r.doc_id, r.base_sha256): r for r in pii.detect(docs).collect()}
    own = next(r for (k, _), r in rows.items() if k == 7)
    assert (own.n_email, own.n_ip, own.n_card, own.n_phone) == (1, 1, 1, 1) and "secret:" in own.spans
    for key, text, _ in TEXTS:
        assert (key, hashlib.sha256(pii.joined(plain_spans(text or "")).encode()).hexdigest()) in rows
    assert pii.detect(none).count() == 0
    redacted = pii.redact(docs)
    assert redacted.columns == docs.columns
    text = redacted.where("doc_id = 7").first()
    assert text.text == 'mail <EMAIL> or <PHONE> from <IP> card <CARD> token = "<SECRET>"' and text.n_chars == len(text.text)
    assert redacted.where("doc_id = 2").first().text is None


def test_field_finds_held_out_entities():
    crf, hit, wrong, missed = pii.trained(), 0, 0, 0
    for text, spans in pii.labelled_sentences(60, seed=123):
        found = set(crf.decode(text, pii.units_of(text)))
        hit, wrong, missed = hit + len(found & set(spans)), wrong + len(found - set(spans)), missed + len(set(spans) - found)
    assert hit / (hit + wrong) > 0.9 and hit / (hit + missed) > 0.9


PAGE = """<html><head><title>x</title><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li><a href="/a">the of and</a></li></ul></nav>
<div class="ad">Buy the best of all now.</div><article><h1>A &amp; title</h1><p><b>The first part of it,<br>and more<p>Les.</p><aside>side</aside><div class="comments"><p>A reader said so.</p></div></article>
<form>name <input></form><footer>&copy; now</footer></body"""


def test_html(spark):
    rows = [(1, "u", PAGE), (2, "v", None), (3, None, ""), (4, "w", "just text & more < of it"), (4, "w", "just text & more < of it")]
    found = {(r.page_id, r.text, r.n_chars) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()}
    main = "A & title\nThe first part of it, and more\nLes."
    assert (1, main, len(main)) in found and (2, "", 0) in found and (3, "", 0) in found
    long = "The story of the town is that it was there for the people who had been in it and of it. " * 4
    page = f"<div class='menu'><a href=x>Home</a></div><div>{long}</div><div>Short.</div><div>{long}</div><div><a href=y>{long}</a></div>"
    assert html_text.main_text(page) == "\n".join([long.strip(), "Short.", long.strip()])
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_on_pages(spark):
    from tests.conftest import SF

    for r in html_text.extract(common.pages(spark, SF), keep=("page_id", "html")).collect():
        article = r.html.split("<article>")[1].split("</article>")[0]
        parts = [" ".join(unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p)


def test_warc(spark):
    rows = [(1, "http://a/x", "<p>One</p><a href='y'>two</a>"), (2, None, None)]
    made = warc.derivatives(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", F.lit(1)), with_record=True).collect()
    assert len(made) == 4
    for r in made:
        (back,) = warc.read_records(bytes(r.record))
        source = warc.response(*next(x for x in rows if x[0] == r.page_id))
        assert back.get("WARC-Refers-To") == source.get("WARC-Record-ID") == r.refers_to and warc.sha1(back.block) == r.block_digest and r.source_digest == warc.sha1(source.block)
    assert {r.content for r in made if r.record_type == "conversion"} == {"One\ntwo", ""}
    import gzip

    source = warc.response(1, "u", "x\r\n\r\ny")
    assert list(warc.read_records(source.to_bytes() * 2)) == [source] * 2 == list(warc.read_records(gzip.compress(source.to_bytes()) * 2))
    assert list(warc.read_records(b"no record")) == [] and warc.derive(warc.Record([("WARC-Type", "request")], b"")) == []


def likeness(a, b):
    a, b = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_fingerprints(spark, docs, none):
    rows = fingerprints.fingerprint(docs).collect()
    assert len(rows) == len(TEXTS) and fingerprints.fingerprint(none).count() == 0
    # Nulls, ties and repeated rows: each row's own digest columns, from its neighbour in the stated order.
    order = sorted({(k is not None, k or 0, t or "") for k, t, _ in TEXTS})
    after = defaultdict(set)
    for i, own in enumerate(order):
        after[own[1:]].add(order[(i + 1) % len(order)][2])
    tied = {k for k, n in Counter(o[:2] for o in order).items() if n > 1}  # ordered by a hash of the text
    body = {(k or 0, t or "") for k, t, _ in TEXTS}
    for r in rows:
        own = [t for k, t in body if k == (r.doc_id or 0) and len(t) == r.n_chars]
        near = set().union(*(after[r.doc_id or 0, t] for t in own))
        digests = {hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest() for t in own for n in near}
        assert r.edited_sha256 in digests or (True, r.doc_id) in tied or any(n == t2 for n in near for k2, t2 in body if (True, k2) in tied)
    same = [r for r in rows if r.doc_id == 10]
    assert len(same) == 2 and same[0] == same[1] and len({r.fingerprint for r in rows if r.n_chars == 19}) == 1
    assert {r.fingerprint for r in rows if r.n_chars == 0} == {"0" * len(rows[0].fingerprint)}
    named = fingerprints.fingerprint(docs.where("doc_id is not null").withColumn("body", F.concat(F.lit("k"), "doc_id")), key="body")
    assert named.count() == len(TEXTS) - 1
    from tests.conftest import SF

    texts = sorted((r.doc_id, r.text) for r in common.documents(spark, SF).collect())
    made = {r.doc_id: r for r in fingerprints.fingerprint(common.documents(spark, SF)).collect()}
    errors = []
    for i, (key, text) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert made[key].n_chars == len(text) and made[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [made[key].near_edited - likeness(text, edited), made[key].near_next - likeness(text, after)]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.1
    by = defaultdict(set)
    for key, text in texts:
        by[text].add(made[key].fingerprint)
    assert all(len(f) == 1 for f in by.values())
