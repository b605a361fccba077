"""Mixing: counts per shard, permutations, and each document's words against a plain recount."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from inkwell.llm import common, mixing
from tests.conftest import SF


@pytest.fixture(scope="module")
def sizes(spark):
    return common.cut(mixing.document_sizes(common.documents(spark, SF)))


def test_shards_slots_and_words(spark, sizes):
    sources = common.cut(mixing.source_targets(sizes))
    counts = common.cut(mixing.shard_counts(sources, shard_slots=64))
    slots = mixing.draw_slots(counts).collect()
    by = {(r.sid, r.shard): r.n for r in counts.collect()}
    # Each shard takes of each source what was drawn for it, and a source's slots have no gap.
    assert Counter((r.sid, r.shard) for r in slots) == Counter(by)
    total, n_blocks = defaultdict(int), {r.sid: r.n_blocks for r in counts.collect()}
    for (sid, _), n in by.items():
        total[sid] += n
    for sid, n in total.items():
        own = sorted((r.slot, r.shard, r.block) for r in slots if r.sid == sid)
        assert [s for s, _, _ in own] == list(range(n)) and [h for _, h, _ in own] == sorted(h for _, h, _ in own)
        for epoch in range(0, n, n_blocks[sid]):
            blocks = [b for s, _, b in own if epoch <= s < epoch + n_blocks[sid]]
            assert len(set(blocks)) == len(blocks) and set(blocks) <= set(range(n_blocks[sid]))
    # The counts vary as a multinomial draw's do: chi-square near its degrees of freedom.
    shards = 1 + max(h for _, h in by)
    chi = sum((by.get((sid, h), 0) - n / shards) ** 2 / (n / shards) for sid, n in total.items() for h in range(shards))
    freedom = len(total) * (shards - 1)
    assert shards > 3 and abs(chi - freedom) < 6 * (2 * freedom) ** 0.5
    # Each document's words, recounted word by word.
    times = Counter((r.sid, r.block) for r in slots)
    known = sizes.withColumnRenamed("source", "s").join(sources, F.col("s").eqNullSafe(F.col("source"))).drop("s")
    held = mixing.stream_starts(known.where("size > 0")).collect()
    streams = defaultdict(list)
    for r in held:
        streams[r.sid].append((r.start, r.size))
    assert all(a + n == b for own in streams.values() for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:], strict=False))
    wanted = Counter()
    for r in held:
        wanted[r.doc_id] += sum(times[r.sid, w // mixing.BLOCK] for w in range(r.start, r.start + r.size))
    made = Counter()
    for r in mixing.taken_words(sizes, shard_slots=64).collect():
        made[r.doc_id] += r.taken
        assert (r.first_shard is None) == (r.taken == 0)
    assert +made == +wanted


def test_clashing_names(spark):
    rows = [(1, "a b c " * 50, "s", "x", 1.0), (1, "a b c " * 50, "s", "x", 1.0), (2, None, None, None, None), (3, "d " * 99, None, "y", 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row string, share double")
    docs = docs.withColumns({c: F.lit(7) for c in ("key", "from", "id", "of", "copies", "__share", "__copies", "size", "sid", "block")})
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= {1, 3}
    assert mixing.mixed_documents(docs.limit(0)).count() == 0
