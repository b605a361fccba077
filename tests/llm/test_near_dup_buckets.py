"""Buckets of many members, split into parts and decided in several rounds, against all pairs."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np

from inkwell.llm import near_dup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_large_buckets_in_parts_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "PART_ROWS", 8)
    rounds = []
    plain = near_dup.hubs_of
    # Two hubs instead of sixteen at first, so that more rounds are needed.
    monkeypatch.setattr(near_dup, "hubs_of", lambda members, hubs: rounds.append(hubs) or plain(members, hubs // 8))
    rng = np.random.default_rng(11)
    words = [f"w{k}" for k in range(5000)]
    base = [str(w) for w in rng.choice(words, 240)]
    texts = []
    for _ in range(130):
        own = list(base)
        for at in rng.choice(240, int(rng.integers(1, 9)), replace=False):
            own[at] = str(rng.choice(words))
        texts.append(" ".join(own))
    texts += [texts[3], texts[7].upper(), " ".join(str(w) for w in rng.choice(words, 5000)) * 2]
    rows = [(int(k), t) for k, t in zip(rng.permutation(1000)[: len(texts)], texts, strict=True)]
    found = {r.doc_id: r.component_id for r in near_dup.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (WORD.findall(t.lower()) for _, t in rows)]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    least = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        least[top(i)].append(k)
    assert found == {k: min(least[top(i)]) for i, (k, _) in enumerate(rows)}
    assert len(rounds) > 2 and 3 <= len(set(found.values())) < 100


def test_digests_are_told_apart_by_both_halves():
    one = near_dup.digest(np.arange(5, dtype=np.uint64))
    assert len(one) == 2 and one[0] != one[1] and one != near_dup.digest(np.arange(6, dtype=np.uint64))
