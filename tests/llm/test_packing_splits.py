"""Packing over many splits: as few sequences as over one, every piece once, no gaps."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from inkwell.llm import common, packing

from ..conftest import SF


def sequences(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def pieces(rows):
    return Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)


def test_splits_hardly_change_the_number_of_sequences(spark):
    docs = common.documents(spark, SF.replace("0.001", "0.01"))
    found = {n: packing.pack(docs.repartition(n)).collect() for n in (1, 32)}
    least = -(-sum(r.length for r in found[1]) // packing.CAPACITY)
    counts = {n: sequences(rows, packing.CAPACITY) for n, rows in found.items()}
    assert pieces(found[1]) == pieces(found[32])
    assert least <= counts[32] <= 1.01 * counts[1] + 1 and counts[1] <= 1.02 * least + 1


@pytest.mark.parametrize("bins", [1, 5])
def test_closed_and_merged_sequences(spark, monkeypatch, bins):
    monkeypatch.setattr(packing, "MERGED", 300)
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.repeat(F.lit("a b "), (F.col("id") * 7 % 23).cast("int"))).alias("text"), F.lit(1).alias("open"), F.lit(1).alias("key"))
    rows = packing.pack(docs.repartition(6), capacity=50, open_bins=bins, with_ids=True).collect()
    assert {len(r.ids) == r.length for r in rows} == {True} and {r.doc_id for r in rows} == set(range(200))
    assert sequences(rows, 50) < 1.3 * sum(r.length for r in rows) / 50 + 6
    assert {r.sequence_id >= packing.AGAIN for r in rows} == {True, False}


def test_no_sequence_is_lost_by_best_fit():
    bins = packing.BestFit(10, 2)
    for n in (4, 7, 3, 8, 2, 9, 9, 6):
        bins.place(n)
    still = {number for own in bins.bins for number in own}
    assert set(bins.closed) | still == set(range(bins.next)) and not set(bins.closed) & still
