"""Vector codes: product quantisation in whole numbers, with kd-tree searches.

Components become the integers ``floor(scale * x)``, vectors are cut into equal
consecutive parts, and each part position has a codebook of ``entries``
vectors, at first those parts of the smallest keys. In each round every part
goes to its nearest entry, and the entry becomes the floored mean of its parts;
after the last round parts are assigned once more.

Each round broadcasts one kd-tree for each codebook (a bounded size: parts x
entries x width). A batch of parts first goes down to the leaf on its side of
every split, then the whole tree is searched by branch and bound: a node is
visited by the parts to which its box is not farther than their best entry.
Boxes at an equal distance are visited too, so of entries at equal distances
the lowest index wins. All distances are exact: whole numbers, in double
precision where they are below 2^53 and in 64 bits elsewhere.

An entry's sums are made in each task, then by partial sums in Spark; what
reaches the driver is one row for each entry. Nothing is drawn at random, so
a lost executor costs repeated work, not other results.

Defined results: rows without a vector, or with a null or infinite component
or one that is no number, are left out; equal keys are ordered by their
vectors, and null keys come last; the dimension is that of the first row in
that order, and vectors of another length are left out; if it can't be cut
evenly, the first parts are longer by one; integers so large that a squared
distance might not fit in 64 bits (beyond 2^28 for parts of 16) count as the
largest that fit; of fewer vectors than entries, all become entries; rows of
equal vectors get equal codes; an empty table gives no row. Extra columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import common

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Entries that a leaf of a tree holds at most, unless they are equal.
LEAF = 16
#: Vectors that a step works on, labels that are broadcast, and the parts into which larger joins spread a label.
STEP, BROADCAST_LABELS, SALTS = 4096, 100_000, 16


class Node(NamedTuple):
    """A box of entries: a leaf with its entries, or two halves split where ``axis`` is below ``at``."""

    low: np.ndarray
    high: np.ndarray
    index: np.ndarray  # of a leaf's entries, ascending
    entries: np.ndarray
    axis: int = -1
    at: float = 0.0
    below: Node | None = None
    above: Node | None = None

    @classmethod
    def of(cls, entries: np.ndarray, index: np.ndarray) -> Node:
        low, high = entries.min(axis=0), entries.max(axis=0)
        if len(index) <= LEAF or not (high > low).any():
            return cls(low, high, index, entries)
        axis = int(np.argmax(high - low))
        along = np.sort(entries[:, axis])
        at = along[len(along) // 2]
        if at == along[0]:
            at = along[np.searchsorted(along, at, side="right")]
        side = entries[:, axis] < at
        return cls(low, high, index[:0], entries[:0], axis, at, cls.of(entries[side], index[side]), cls.of(entries[~side], index[~side]))


def squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def nearest(entries: np.ndarray, tree: Node, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each part, the nearest entry (of equal ones the lowest) and its squared distance."""
    least = np.full(len(parts), np.inf if parts.dtype == np.float64 else np.iinfo(np.int64).max, dtype=parts.dtype)
    found = np.full(len(parts), len(entries))
    home = np.full(len(parts), -1)

    def meet(leaf: Node, rows: np.ndarray) -> None:
        x = parts[rows]
        d = squares(x)[:, None] + squares(leaf.entries) - 2 * (x @ leaf.entries.T)
        own = d.argmin(axis=1)  # the first of the least, so the lowest of the leaf
        d, index = d[np.arange(len(rows)), own], leaf.index[own]
        better = (d < least[rows]) | ((d == least[rows]) & (index < found[rows]))
        least[rows[better]], found[rows[better]] = d[better], index[better]

    def descend(node: Node, rows: np.ndarray) -> None:
        if node.below is None:
            home[rows] = node.index[0]
            meet(node, rows)
        elif len(rows):
            side = parts[rows, node.axis] < node.at
            descend(node.below, rows[side])
            descend(node.above, rows[~side])

    def search(node: Node, rows: np.ndarray) -> None:
        if node.below is None:
            rows = rows[home[rows] != node.index[0]]
        x = parts[rows]
        rows = rows[squares(np.maximum(np.maximum(node.low - x, x - node.high), 0)) <= least[rows]]
        if not len(rows):
            return
        if node.below is None:
            meet(node, rows)
        else:
            search(node.below, rows)
            search(node.above, rows)

    if len(parts):
        descend(tree, np.arange(len(parts)))
        search(tree, np.arange(len(parts)))
    return found, least.astype(np.int64)


class Codebooks(NamedTuple):
    """Each part position's entries, as integers."""

    entries: list[np.ndarray]
    scale: int = SCALE

    @property
    def dim(self) -> int:
        return sum(e.shape[1] for e in self.entries)

    def limits(self) -> list[int]:
        """The largest integers of each part: four times their squares, summed over the part, fit in 64 bits."""
        return [math.isqrt((2**63 - 1) // (4 * max(1, e.shape[1]))) for e in self.entries]

    def parts(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The parts of [row, component] vectors, as integers."""
        whole = np.floor(vectors.astype(np.float64) * self.scale)
        cuts = np.cumsum([e.shape[1] for e in self.entries])[:-1]
        return [np.clip(x, -most, most).astype(np.int64) for x, most in zip(np.split(whole, cuts, axis=1), self.limits(), strict=True)]

    def trees(self) -> list[dict[type, tuple[np.ndarray, Node]]]:
        """A kd-tree for each part, in double precision and in 64 bits."""
        return [{kind: (e.astype(kind), Node.of(e.astype(kind), np.arange(len(e)))) for kind in (np.float64, np.int64)} for e in self.entries]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for e in self.entries for x in e.ravel().tolist()).encode()).hexdigest()


def assigned(trees: list[dict[type, tuple[np.ndarray, Node]]], parts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Entry and squared distance of each part, by part."""
    for own, x in zip(trees, parts, strict=True):
        entries = own[np.int64][0]
        top = max(int(abs(x).max(initial=0)), int(abs(entries).max(initial=0)))
        kind = np.float64 if 4 * max(1, x.shape[1]) * top * top < 1 << 53 else np.int64
        yield nearest(*own[kind], x.astype(kind))


def kept(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """key, vector and label under names of their own, without null vectors and those with components that are no finite numbers."""
    odd = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("v"), F.col(label).alias("label"))
    return rows.where(F.col("v").isNotNull() & ~F.exists("v", odd))


def seeds(rows: DataFrame, parts: int, entries: int, scale: int) -> Codebooks | None:
    """Codebooks of the first rows by key; none without rows."""
    order = [F.col("key").asc_nulls_last(), "v"]
    first = rows.select("key", "v").orderBy(*order).limit(entries).collect()  # at most ``entries`` rows
    if not first:
        return None
    dim = len(first[0].v)
    if any(len(r.v) != dim for r in first):
        first = rows.where(F.size("v") == dim).select("key", "v").orderBy(*order).limit(entries).collect()
    made = Codebooks([np.zeros((0, len(at)), dtype=np.int64) for at in np.array_split(np.arange(dim), parts)], scale)
    return made._replace(entries=made.parts(np.array([r.v for r in first], dtype=np.float64).reshape(len(first), dim)))


def steps(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of a batch with their vectors."""
    for k in range(0, batch.num_rows, STEP):
        piece = batch.slice(k, STEP)
        yield piece, piece.column("v").flatten().to_numpy(zero_copy_only=False).reshape(piece.num_rows, dim)


def updated(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part to its nearest entry, every entry to the floored mean of its parts; unused entries stay."""
    sc = rows.sparkSession.sparkContext
    trees = sc.broadcast(books.trees())
    dim, shapes = books.dim, [e.shape for e in books.entries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = [np.zeros(n, dtype=np.int64) for n, _ in shapes], [np.zeros(s, dtype=np.int64) for s in shapes]
        for batch in batches:
            for _, v in steps(batch, dim):
                parts = books.parts(v)
                for p, (entry, _) in enumerate(assigned(trees.value, parts)):
                    order = np.argsort(entry, kind="stable")
                    own, heads = np.unique(entry[order], return_index=True)
                    counts[p][own] += np.diff(heads, append=len(entry))
                    sums[p][own] += np.add.reduceat(parts[p][order], heads, axis=0) if shapes[p][1] else 0
        at = [(p, e) for p, n in enumerate(counts) for e in np.flatnonzero(n).tolist()]
        columns = [pa.array([p for p, _ in at], pa.int32()), pa.array([e for _, e in at], pa.int32()), pa.array([int(counts[p][e]) for p, e in at], pa.int64()), pa.array([sums[p][e] for p, e in at], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "total"])

    made = rows.select("v").mapInArrow(run, "part int, entry int, n long, total array<long>")
    width = max(w for _, w in shapes)
    added = made.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(width)]).alias("total"))
    entries = [e.copy() for e in books.entries]
    for r in added.collect():  # a row for each entry
        entries[r.part][r.entry] = [x // r.n for x in r.total[: shapes[r.part][1]]]
    trees.destroy()
    return books._replace(entries=entries)


def encoded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """key, label, code (two hexadecimal digits a part) and error (squared distances, summed over the parts)."""
    trees, dim = rows.sparkSession.sparkContext.broadcast(books.trees()), books.dim
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, v in steps(batch, dim):
                found = list(assigned(trees.value, books.parts(v)))
                codes = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                width = 2 * len(found)
                columns = [piece.column("key"), piece.column("label"), pa.array([codes[k : k + width] for k in range(0, len(codes), width)], pa.string()), pa.array(sum(d for _, d in found), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "code", "error"])

    return rows.select("key", "label", "v").mapInArrow(run, f"key {fields['key']}, label {fields['label']}, code string, error long")


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` with the sum of ``error`` over their label, nulls together; ``rows`` is read twice."""
    sums = common.cut(rows.groupBy(F.col("label").alias("own")).agg(F.sum("error").alias("label_error")))
    if sums.count() <= BROADCAST_LABELS:
        return rows.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("own"))).drop("own")
    # Too many to broadcast: each label's rows are spread over parts, each of which gets the sum.
    sums = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = rows.withColumn("dealt", F.pmod(F.xxhash64("key", "code"), F.lit(SALTS)).cast("int"))
    return spread.join(sums, F.col("label").eqNullSafe(F.col("own")) & (F.col("dealt") == F.col("salt"))).drop("own", "salt", "dealt")


def vector_codes(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks | None]:
    """key, code, error and label_error of each vector, and the codebooks (none for an empty table)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits: up to 256 entries")
    rows = kept(vectors, key, vector, label)
    books = seeds(rows, parts, entries, scale)
    if books is None:
        return rows.select(F.col("key").alias(key), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")), None
    rows = rows.where(F.size("v") == books.dim)
    for _ in range(rounds):
        books = updated(rows, books)
    made = with_label_error(common.cut(encoded(rows, books)))
    return made.select(F.col("key").alias(key), "code", "error", "label_error"), books


def decoded(code: str, books: Codebooks) -> np.ndarray:
    """The vector, in the scale of the input, for which a code stands."""
    index = bytes.fromhex(code)
    return np.concatenate([e[i] for e, i in zip(books.entries, index, strict=True)]) / books.scale


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    made, books = vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return made.withColumn("codebooks_sha256", F.lit(books.sha256() if books else ""))
