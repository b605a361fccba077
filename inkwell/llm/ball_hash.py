"""Near-duplicates by SimHash: fingerprints of word shingles, linked where few bits differ.

A fingerprint bit is 1 where it is set in over half of the XXH64 hashes of a
text's 3-word shingles (lower-case A-Z, repeats included). Fingerprints that
differ in ``radius`` bits or fewer are linked.

Meet-in-the-middle ball hashing finds the links: every distinct fingerprint
emits all variants within half the radius, and the variants are shuffled. Two
fingerprints within the radius share a variant, and of those that share one,
any two are within the radius. So it is enough to link all of a variant's
fingerprints with its least one: at most a ball's fingerprints (65 for radius
2) meet at a variant, and no pairs are enumerated. The links found are
deduplicated and verified by counting the bits in which they differ.

Rows of one fingerprint are one node from the start, so exact copies, however
many, are one row here. Components come from star steps over the links.

The hash is computed for many shingles at once: lanes of eight, four and one
bytes are gathered from the buffer of a slice's words, for all shingles that
have them. Shingles of 32 bytes or more take the library.

Defined results: null, empty and wordless texts have the fingerprint zero and
are linked like any other; texts with fewer than three words have one shingle;
repeated rows get the same component; a null key is no candidate for a
component's smallest key, and a component of null keys only has a null id; texts
are hashed whole, in slices of bounded bytes beyond the longest text; an empty
table gives no row. Extra columns, whatever their names, are ignored by
``components`` and stay as they are in ``unique_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkwell.llm import common, near_dup
from inkwell.llm.quality import IS_SPACE

SHINGLE = 3
SEED = 42
RADIUS = 2
# The primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: Shingles whose bits are counted at a time.
STEP = 1 << 16


def turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def xxh64(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many stretches of ``data``, which has eight bytes or more beyond the last."""
    size = end - begin
    out = np.empty(len(size), dtype=np.uint64)
    whole = memoryview(data)
    for i in np.flatnonzero(size >= 32).tolist():
        out[i] = xxhash.xxh64_intdigest(whole[begin[i] : end[i]], seed)
    # The others in order of their sizes, so that those that have a lane are the last ones.
    short = np.flatnonzero(size < 32)
    short = short[np.argsort(size[short].astype(np.uint8), kind="stable")]
    at, left = begin[short], size[short]
    h = np.uint64(seed) + P5 + left.astype(np.uint64)
    lanes8, lanes4 = (np.ndarray((len(data) - width + 1,), dtype=f"<u{width}", buffer=data, strides=(1,)) for width in (8, 4))
    for k in range(3):
        some = slice(int(np.searchsorted(left, 8 * k + 8)), None)
        lane = turned(lanes8[at[some] + 8 * k] * P2, 31) * P1
        h[some] = turned(h[some] ^ lane, 27) * P1 + P4
    at, left = at + (left & ~7), left & 7
    some = np.flatnonzero(left >= 4)
    h[some] = turned(h[some] ^ (lanes4[at[some]].astype(np.uint64) * P1), 23) * P2 + P3
    at, left = at + (left & 4), left & 3
    for k in range(3):
        some = np.flatnonzero(left > k)
        h[some] = turned(h[some] ^ (data[at[some] + k].astype(np.uint64) * P5), 11) * P1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    out[short] = h ^ (h >> np.uint64(32))
    return out


def shingle_hashes(texts: list[bytes], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all texts' shingles, in order, and each text's number of them."""
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    first = np.cumsum(sizes + 1) - sizes - 1
    black = ~IS_SPACE[data]
    edge = np.diff(black.astype(np.int8), prepend=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    word_at = np.append(np.searchsorted(begin, first), len(begin))
    # The words alone, one space after each.
    keep = black.copy()
    keep[end] = True
    joined = np.where(black, data, np.uint8(32))[keep]
    length = end - begin
    start = np.cumsum(length + 1) - length - 1
    words = np.diff(word_at)
    count = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    span = np.repeat(np.minimum(words, n), count)
    lead = np.repeat(word_at[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    last = lead + span - 1
    joined = np.concatenate([joined, np.zeros(8, dtype=np.uint8)])
    return xxh64(joined, start[lead], start[last] + length[last]), count


def fingerprints_of(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Each text's fingerprint: the bits set in over half of its hashes; zero without any."""
    ends = np.cumsum(count)
    votes = np.zeros((len(count), 64), dtype=np.int64)
    own = np.repeat(np.arange(len(count)), count)
    for k in range(0, len(hashes), STEP):
        bits = np.unpackbits(np.ascontiguousarray(hashes[k : k + STEP], dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        doc = own[k : k + STEP]
        heads = np.flatnonzero(np.diff(doc, prepend=-1))
        votes[doc[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    assert not len(ends) or ends[-1] == len(hashes)
    return np.packbits(2 * votes > count[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE) -> DataFrame:
    """key and bits, the fingerprint as a signed number."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_slices(batches, "text"):
            made = fingerprints_of(*shingle_hashes([t.encode() for t in texts], n))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(made.view(np.int64), pa.int64())], names=["key", "bits"])

    made = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, bits long")
    return made.withColumnRenamed("key", key)


def ball(radius: int) -> list[int]:
    """All 64-bit numbers, signed, of up to ``radius`` bits: what to flip for the variants of a fingerprint."""
    flips = [sum(1 << b for b in at) for n in range(radius + 1) for at in combinations(range(64), n)]
    return [f - (1 << 64) if f >> 63 else f for f in flips]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b), b the smaller, that connect all of the distinct ``bits`` that differ in ``radius`` bits or fewer."""
    if radius % 2 or not 0 <= radius <= 4:
        raise ValueError("the radius is an even number up to 4")
    flips = F.array(*[F.lit(f).cast("long") for f in ball(radius // 2)])
    emitted = prints.select("bits", F.explode(flips).alias("flip")).select("bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("variant"))
    least = F.min("bits").over(Window.partitionBy("variant"))
    met = emitted.select(F.col("bits").alias("a"), least.alias("b")).where("a <> b").distinct()
    return met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, n: int = SHINGLE) -> DataFrame:
    """key, bits and component_id (the smallest key reachable by links) for each row."""
    rows = common.cut(fingerprints(docs.select(F.col(key).alias("__id"), F.col(text).alias("__text")), "__id", "__text", n))
    nodes = common.cut(rows.groupBy("bits").agg(F.min("__id").alias("first"), F.count("*").alias("copies")))
    edges = common.cut(links(nodes.select("bits"), radius))
    roots = near_dup.stars(edges)
    named = nodes.join(roots.withColumnRenamed("node", "bits"), "bits", "left").select("bits", "first", "copies", F.coalesce("root", "bits").alias("root"))
    # Roots of several nodes only: all else is a component by itself.
    least = named.join(roots.select("root").distinct(), "root", "left_semi").groupBy("root").agg(F.min("first").alias("least"))
    found = named.join(least, "root", "left").where("least is not null or copies > 1").select("bits", F.coalesce("least", "first").alias("component"))
    component = F.coalesce("component", "__id")
    return rows.join(found, "bits", "left").select(F.col("__id").alias(key), "bits", component.alias("component_id"))


def unique_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` without the documents that another of their component stands for."""
    kept = components(docs, key, text, radius).where(F.col(key).eqNullSafe(F.col("component_id"))).select(F.col(key).alias("kept")).distinct()
    # Rows travel as one column, so that no name of theirs can clash.
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("id"))
    return whole.join(kept, F.col("id").eqNullSafe(F.col("kept")), "left_semi").select("row.*")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = components(common.documents(spark, sf_dir))
    return made.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
