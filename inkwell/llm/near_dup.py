"""Near-duplicate documents: banded MinHash, odd sketches, exact confirmation.

1. One pass over the texts gives each document's set of 5-word shingles (as
   64-bit hashes) in short form: its size, a 128-bit digest and MinHash bands.
   Documents of equal digest are one node from here on, which has a number, so
   exact copies are never compared or expanded. Nodes that share a band with
   another get an odd sketch, a parity bitmap into which MinHash samples are
   folded.
2. Nodes that share a band are candidates. The bands follow from the threshold:
   28 bands of 6 rows miss a pair of Jaccard similarity 0.85 with probability
   below 2e-6, and so do 34 bands of 5 rows one of 0.80.
3. No bucket is expanded into all its pairs. In each round, every bucket that
   still holds two components or more compares its members with a few hubs of
   other components, then drops the hubs, all of whose pairs it has now
   decided. Links merge components, so most pairs of a large group need no
   comparison. Rounds go on, with more hubs each, until every bucket is
   decided: there is no cap, only work that shrinks.
4. Candidate pairs are dropped by size, then by odd sketch: the population
   count of the XOR of two sketches estimates the similarity, most precisely
   where it is high. What is left is confirmed on the full sets.
5. Components come from alternating large-star and small-star steps.

A large bucket is split by a hash of the member, and only its hubs are repeated
in each part. The joins on a component's root and on a bucket's key shuffle both
sides for the join alone (``apart``), so that adaptive execution can split a key
with a large share of the rows; without that, the side that was aggregated by
the key would bind the other one to its partitions. Tables of a round are
deleted after it.

Hashes are 64 bits wide (digests 128): two different shingles of a pair of
documents are taken for equal with probability below 1e-9, and two of N
different sets share a node with probability N^2 / 2^129 (of 10^10 sets: 1e-19).

Defined results: null, empty and wordless texts have no shingle and are
components of their own; texts with fewer than five words have one shingle;
repeated rows get the same component; a null key is no candidate for a
component's smallest key, and a component of null keys only has a null id; an
empty table gives no row. Extra columns, whatever their names, are ignored by
``components`` and stay as they are in ``unique_documents``.

Recall: a pair at the threshold shares no band with probability ``MISSED`` at
most, and each sketch passes it over with probability 3e-7 (five standard
errors); a component loses a document only if all its links are missed.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import common
from inkwell.llm.quality import ODD, Slice, mix, windows

SHINGLE = 5
PERCENT = 85
#: With which probability a pair at the threshold may share no band, and the most MinHash samples of all bands.
MISSED, SAMPLES = 2e-6, 176
#: Members that one part of a bucket holds.
PART_ROWS = 1024
#: What ``apart`` turns keys with.
APART = 0x5DEECE66D
#: MinHash samples and bits of the short and the long odd sketch.
SHORT, LONG = (672, 1024), (2048, 2048)


def bands_of(percent: int) -> tuple[int, int]:
    """Bands and rows a band: the longest bands that within ``SAMPLES`` miss a pair at the threshold with probability ``MISSED`` at most."""
    likeness = min(percent, 99) / 100
    fits = [(math.ceil(math.log(MISSED) / math.log1p(-(likeness**rows))), rows) for rows in range(1, 17)]
    return max((f for f in fits if f[0] * f[1] <= SAMPLES), key=lambda f: f[1], default=fits[0])


def least_estimate(percent: int, samples: int, bits: int) -> float:
    """The estimate below which a pair isn't confirmed: five standard errors below the threshold.

    Both the samples drawn and the bits on which several of them fell vary.
    """
    likeness = percent / 100
    flips = 2 * samples * (1 - likeness)
    folded = (bits / 4 * math.expm1(4 * flips / bits) - flips) / (2 * samples) ** 2
    return math.floor(100 * (likeness - 5 * math.sqrt(likeness * (1 - likeness) / samples + folded))) / 100


def shingle_sets(s: Slice, n: int = SHINGLE) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, in order of value."""
    hashes = windows(s.word_hash, n)
    out = []
    for a, b in zip(s.word_at[:-1].tolist(), s.word_at[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(hashes[a : b - n + 1]))
        elif b > a:
            out.append(windows(s.word_hash[a:b], b - a) + np.uint64(b - a))
        else:
            out.append(hashes[:0])
    return out


def samples_of(sets: list[np.ndarray], k: int, seed: int) -> np.ndarray:
    """[set, k] MinHash samples of sets that aren't empty."""
    rng = np.random.default_rng(seed)
    a = (rng.integers(0, 2**63, k, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
    b = rng.integers(0, 2**63, k, dtype=np.uint64)
    least = np.full((len(sets), k), ~np.uint64(0), dtype=np.uint64)
    width = max(16, 65536 // k)
    for i, own in enumerate(sets):
        for first in range(0, len(own), width):
            part = own[first : first + width]
            np.minimum(least[i], (a[:, None] * part[None, :] + b[:, None]).min(axis=1), out=least[i])
    return mix(least)


def band_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """[set, band] keys: a band's hashed samples and its number."""
    least = samples_of(sets, bands * rows, 20240607)
    keys = np.zeros((len(sets), bands), dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys * ODD + least[:, r::rows])
    return (keys + np.arange(bands, dtype=np.uint64) * ODD).view(np.int64)


def odd_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """[set, word]: the short bitmap, then the long one, in which each sample has flipped the bit that it hashes to."""
    least = samples_of(sets, LONG[0], 20240608)
    hashed = mix(least + np.arange(LONG[0], dtype=np.uint64) * ODD)
    out = []
    for k, bits in (SHORT, LONG):
        bit = (hashed[:, :k] >> np.uint64(64 - (bits - 1).bit_length())).astype(np.int64)
        flat = np.bincount((np.arange(len(sets))[:, None] * bits + bit).ravel(), minlength=len(sets) * bits) & 1
        out.append(np.packbits(flat.astype(np.uint8).reshape(len(sets), bits), axis=1).view(np.int64))
    return np.concatenate(out, axis=1)


def digest(own: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    return struct.unpack("<2q", hashlib.blake2b(own.tobytes(), digest_size=16).digest())


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, d1, d2 (the digest) and bands; the last three null without shingles."""
    kind = docs.schema[key].dataType.simpleString()
    shape = bands_of(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_slices(batches, text):
            sets = shingle_sets(Slice.of([t.encode().lower() for t in texts]))
            full = [i for i, own in enumerate(sets) if len(own)]
            digests: list = [(None, None)] * len(sets)
            bands: list = [None] * len(sets)
            for i, k in zip(full, band_keys([sets[i] for i in full], *shape), strict=True):
                digests[i], bands[i] = digest(sets[i]), k
            columns = [batch.column(key), pa.array(list(map(len, sets)), pa.int64()), *(pa.array([d[half] for d in digests], pa.int64()) for half in (0, 1)), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n_shingles", "d1", "d2", "bands"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_shingles long, d1 long, d2 long, bands array<long>")


def full_sets(docs: DataFrame, text: str = "text") -> DataFrame:
    """d1, d2 (the digest), shingles, sketch: the whole set of each text that has one, and its odd sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in common.text_slices(batches, text):
            sets = [s for s in shingle_sets(Slice.of([t.encode().lower() for t in texts])) if len(s)]
            digests = [digest(s) for s in sets]
            lists = [[s.view(np.int64) for s in sets], list(odd_sketches(sets))]
            halves = [pa.array([d[half] for d in digests], pa.int64()) for half in (0, 1)]
            yield pa.RecordBatch.from_arrays([*halves, *(pa.array(x, pa.list_(pa.int64())) for x in lists)], names=["d1", "d2", "shingles", "sketch"])

    return docs.select(text).mapInArrow(run, "d1 long, d2 long, shingles array<long>, sketch array<long>")


def estimate(odd: Column, samples: int, bits: int) -> Column:
    """Jaccard similarity of two sets from how many bits their odd sketches differ in."""
    return 1 + F.lit(bits / (4.0 * samples)) * F.ln(F.greatest(F.lit(1e-9), 1 - 2 * odd.cast("double") / bits))


def likely_link(a: Column, b: Column, percent: int = PERCENT) -> Column:
    """Whether both sketches allow a link: the short one in generated code, the long one where that passes."""
    short = SHORT[1] // 64
    first = reduce(lambda x, y: x + y, [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(short)])
    differing = F.zip_with(F.slice(a, short + 1, LONG[1] // 64), F.slice(b, short + 1, LONG[1] // 64), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    second = F.aggregate(differing, F.lit(0), lambda s, x: s + x)
    return (estimate(first, *SHORT) >= least_estimate(percent, *SHORT)) & (estimate(second, *LONG) >= least_estimate(percent, *LONG))


def is_star(edges: DataFrame) -> bool:
    """Whether each node points at one root, and no root points on."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("in").alias("in")).where("out > 1 or (out = 1 and in = 1)").isEmpty()


def apart(df: DataFrame, key: str) -> DataFrame:
    """``df`` with its key under another expression, for a join that must not take over the partitions of an aggregate by the key.

    Each side of such a join is then shuffled for it, and Spark may split the
    partitions of a key that has a large share of the rows.
    """
    return df.withColumn(key, F.col(key).bitwiseXOR(F.lit(APART)))


def star_step(edges: DataFrame) -> DataFrame:
    """Edges (a, b) after a large-star and a small-star step: the same components, closer to stars."""
    edges = edges.where("a <> b")
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = apart(both.where("v > u"), "u").join(apart(least, "u"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    below = large.groupBy("u").agg(F.min("v").alias("m"))
    small = apart(large, "u").join(apart(below, "u"), "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").union(below.select("u", "m"))
    return common.cut(small.distinct())


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that isn't its component's smallest."""
    old = None
    while True:
        made = star_step(edges)
        common.drop(old)
        if is_star(made):
            return made.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = old = made


def hubs_of(members: DataFrame, hubs: int) -> DataFrame:
    """key, parts, node, comp, hub for the buckets that still hold two components or more.

    A bucket's lowest node is a hub, and so are about ``hubs`` others drawn by a hash.
    """
    buckets = members.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("node").alias("lowest")).where("low <> high")
    drawn = F.pmod(F.xxhash64("node", "key", F.lit(hubs)), F.greatest(F.lit(1), F.ceil(F.col("n") / hubs))) == 0
    hub = (F.col("node") == F.col("lowest")) | drawn
    met = apart(members, "key").join(apart(buckets.select("key", "n", "lowest"), "key"), "key")
    return apart(met, "key").select("key", F.ceil(F.col("n") / PART_ROWS).alias("parts"), "node", "comp", hub.alias("hub"))


def candidates(live: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Undecided pairs (a, b, n_a, n_b) of members and hubs of other components.

    Sizes and odd sketches are compared within the join, so pairs that can't
    be links are never rows. A pair belongs to the lowest key that both have:
    it is a row once, in the round that makes either a hub there. A bucket's
    members are dealt to its parts, and each part gets all its hubs.
    """
    own = live.where("hub").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    own = own.select("key", "part", *[F.col(c).alias(f"h_{c}") for c in ("node", "comp", "n", "sketch", "bands")])
    first = F.array_min(F.array_intersect("bands", "h_bands")) == F.col("key")
    near = likely_link(F.col("sketch"), F.col("h_sketch"), percent)
    sized = F.expr(f"100 * least(n, h_n) >= {percent} * greatest(n, h_n)")
    dealt = live.withColumn("__part", F.pmod(F.xxhash64("node", F.lit(41)), F.col("parts"))).drop("hub", "parts").withColumnRenamed("key", "__key")
    met = dealt.join(own, (F.col("__key") == F.col("key")) & (F.col("__part") == F.col("part")) & (F.col("comp") != F.col("h_comp")) & sized & near & first)
    low = F.col("node") < F.col("h_node")
    one, two = (lambda c: F.when(low, F.col(c)).otherwise(F.col(f"h_{c}"))), (lambda c: F.when(low, F.col(f"h_{c}")).otherwise(F.col(c)))
    return met.select(one("node").alias("a"), two("node").alias("b"), one("n").alias("n_a"), two("n").alias("n_b")).distinct()


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, component_id (the smallest key reachable by links) and kept, for each row."""
    docs = docs.select(F.col(key).alias("__id"), F.col(text).alias("__text"))
    rows = common.cut(signatures(docs, "__id", "__text", percent))
    # A node's number is given once, when the table is written.
    nodes = rows.where("n_shingles > 0").groupBy("d1", "d2").agg(F.min("__id").alias("first"), F.count("*").alias("copies"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    nodes = common.cut(nodes.withColumn("node", F.monotonically_increasing_id()))
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("__n")).where("__n > 1").select("key")
    members = first_members = common.cut(banded.join(shared, "key").select("key", "node", F.col("node").alias("comp")))
    own = members.select("node").distinct()
    firsts = nodes.join(own, "node", "left_semi").select(F.col("first").alias("__first"))
    owners = docs.join(firsts.distinct(), F.col("__id").eqNullSafe(F.col("__first")), "left_semi")
    named = nodes.join(own, "node", "left_semi").select("d1", "d2", "node")
    sets = common.cut(full_sets(owners, "__text").join(named, ["d1", "d2"]).dropDuplicates(["node"]).select("node", "shingles", "sketch"))
    known = nodes.select("node", "n", "bands").join(sets.select("node", "sketch"), "node")
    edges, hubs, behind = None, 16, None
    while True:
        live = common.cut(hubs_of(members, hubs).join(known, "node"))
        common.drop(behind)
        if live.isEmpty():
            break
        likely = candidates(live, percent)
        whole_a, whole_b = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")
        both = F.size(F.array_intersect("set_a", "set_b"))
        links = likely.join(whole_a, "a").join(whole_b, "b").where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).select("a", "b")
        links = common.cut(links)
        left = live.where("not hub").select("key", "node")
        if not links.isEmpty():
            # One step a round: components may be behind, which costs comparisons, not links.
            old, edges = edges, star_step(links if edges is None else links.union(edges))
            common.drop(old)
        common.drop(links)
        if edges is None:
            left = left.withColumn("comp", F.col("node"))
        else:
            nearest = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
            left = left.join(nearest, "node", "left").select("key", "node", F.coalesce("root", "node").alias("comp"))
        members, hubs, behind = left, min(16 * hubs, 4096), live
    for table in (first_members, sets, live):
        common.drop(table)
    named = nodes.select("d1", "d2", "node", "first", "copies")
    if edges is not None:
        roots = stars(edges)
        named = named.join(roots, "node", "left").select("d1", "d2", "first", "copies", F.coalesce("root", "node").alias("root"))
        ends = roots.select("root").distinct()
        least = named.join(ends, "root", "left_semi").groupBy("root").agg(F.min("first").alias("least"))
        found = named.join(least, "root", "left").where("least is not null or copies > 1").select("d1", "d2", F.coalesce("least", "first").alias("component"))
    else:
        found = named.where("copies > 1").select("d1", "d2", F.col("first").alias("component"))
    component = F.when(F.col("component").isNull(), F.col("__id")).otherwise(F.col("component"))
    joined = rows.select("__id", "n_shingles", "d1", "d2").join(found, ["d1", "d2"], "left")
    return joined.select(F.col("__id").alias(key), "n_shingles", component.alias("component_id")).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def unique_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that another of their component stands for."""
    kept = components(docs, key, text, percent).where("kept").select(F.col(key).alias("kept")).distinct()
    # Rows travel as one column, so that no name of theirs can clash.
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("id"))
    return whole.join(kept, F.col("id").eqNullSafe(F.col("kept")), "left_semi").select("row.*")


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(common.documents(spark, sf_dir))
