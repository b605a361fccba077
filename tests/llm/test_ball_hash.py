"""SimHash links and components against a plain version."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.llm import ball_hash, common

from ..conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_shingles(text, n=3):
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] * bool(words)


def plain_bits(text):
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in plain_shingles(text)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(keys, prints):
    root = list(range(len(keys)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                root[top(i)] = top(j)
    least = defaultdict(list)
    for i, k in enumerate(keys):
        if k is not None:
            least[top(i)].append(k)
    return [min(least[top(i)], default=None) for i in range(len(keys))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aBÉß日😀 \t\n\x0b\x1c\x85.xyz", max_size=120), min_size=1, max_size=5))
def test_hashes_equal_the_librarys(texts):
    hashes, count = ball_hash.shingle_hashes([t.encode() for t in texts])
    expected = [[xxhash.xxh64_intdigest(s.encode(), 42) for s in plain_shingles(t)] for t in texts]
    assert count.tolist() == list(map(len, expected)) and hashes.tolist() == [h for own in expected for h in own]
    assert ball_hash.fingerprints_of(hashes, count).tolist() == list(map(plain_bits, texts))


def test_hashes_of_every_size():
    data = np.frombuffer(bytes(range(1, 101)) * 2 + bytes(8), dtype=np.uint8)
    end = np.arange(70)
    found = ball_hash.xxh64(data, np.zeros(70, dtype=np.int64), end)
    assert found.tolist() == [xxhash.xxh64_intdigest(data[:n].tobytes(), 42) for n in end]


def test_more_shingles_than_one_step():
    text = " ".join(f"w{i * 7919 % 65537}" for i in range(ball_hash.STEP + 5000))
    hashes, count = ball_hash.shingle_hashes([b"a b c d", text.encode(), b""])
    bits = ball_hash.fingerprints_of(hashes, count)
    assert [int(bits[0]), int(bits[2])] == [plain_bits("a b c d"), 0]
    own = hashes[count[0] :]
    assert int(bits[1]) == sum(1 << b for b in range(64) if 2 * int(((own >> np.uint64(b)) & np.uint64(1)).sum()) > len(own))


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_links_connect_all_near_fingerprints(spark, radius):
    rng = np.random.default_rng(radius)
    prints = set()
    for base in rng.integers(0, 2**63, 12, dtype=np.uint64).tolist():
        for _ in range(15):
            prints.add(base ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 5)), replace=False)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = ball_hash.links(spark.createDataFrame([(p,) for p in signed], "bits long"), radius).collect()
    mask = (1 << 64) - 1
    near = lambda a, b: bin((a ^ b) & mask).count("1") <= radius
    assert all(near(r.a, r.b) and r.b < r.a for r in found)

    def groups(pairs):
        root = {p: p for p in signed}

        def top(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in pairs:
            root[top(a)] = top(b)
        out = defaultdict(set)
        for p in signed:
            out[top(p)].add(p)
        return {frozenset(g) for g in out.values()}

    assert groups((r.a, r.b) for r in found) == groups((a, b) for a in signed for b in signed if near(a, b))


def test_an_odd_radius_is_refused(spark):
    with pytest.raises(ValueError, match="even"):
        ball_hash.links(spark.range(1).select(F.col("id").alias("bits")), 3)


def test_components(spark):
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(300)]
    texts = []
    for _ in range(10):
        own = list(rng.choice(words, 400))
        for copy in range(6):
            made = list(own)
            if copy % 2:
                made[int(rng.integers(0, 400))] = "changed"
            texts.append(" ".join(made).upper() if copy == 2 else "\n".join(made))
    texts += [None, "", " \t", "one", "One", "two words", texts[0] + " ", texts[0]]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(3, texts[0]), (3, texts[0]), (None, texts[0]), (None, "alone without a key"), (8, texts[7])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("key", "bits", "first", "root", "variant")}).repartition(3)
    prints = [plain_bits(t) for _, t in rows]
    expected = sorted(zip([k for k, _ in rows], prints, plain_components([k for k, _ in rows], prints), strict=True), key=str)
    found = [(r.doc_id, r.bits & (1 << 64) - 1, r.component_id) for r in ball_hash.components(df).collect()]
    assert sorted(found, key=str) == expected
    kept = ball_hash.unique_documents(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {k for k, _, c in expected if k == c}
    none = df.limit(0)
    assert ball_hash.components(none).count() == 0 and ball_hash.unique_documents(none).count() == 0


def test_the_query_equals_a_plain_version(spark):
    docs = sorted((r.doc_id, r.text) for r in common.documents(spark, SF).collect())
    prints = [plain_bits(t) for _, t in docs]
    expected = {(k, f"{p:016x}", c) for (k, _), p, c in zip(docs, prints, plain_components([k for k, _ in docs], prints), strict=True)}
    rows = ball_hash.op11_simhash(spark, SF).collect()
    assert len(rows) == len(docs) and {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == expected
    assert len({c for _, _, c in expected}) < len(docs)
