"""Best-fit packing of tokenised documents into sequences of bounded length.

Bounded-space online best fit: each input partition keeps at most ``open_bins``
sequences open. A piece goes to the open sequence with the least room that
still takes it; if none does and all places are in use, the fullest closes.
The open sequences are kept in a bitset keyed by their free space, so a choice
is a shift and a lowest-set-bit. Partitions are packed independently, straight
after the scan: memory is bounded by ``open_bins``, and a lost task reads its
split again in the same order.

What a partition's open sequences hold at its end is packed again, together
with that of the other partitions and the longest pieces first, in groups of
``MERGED`` tokens. Only these pieces are shuffled, at most ``open_bins``
sequences of a split; the number of sequences then hardly depends on how the
input is split.

Defined results: a null or empty text is a document of the end token alone; a
repeated row is a document of its own; only documents longer than a sequence
are cut; an empty table gives no row. Other input columns are not carried on,
except the key, whatever its type (null included).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, StructField, StructType

from inkwell.llm import common, wordbpe

CAPACITY = 4096
OPEN_BINS = 1024
#: Tokens of the open sequences that one task packs again.
MERGED = 1 << 24
END_ID = 1
#: Numbers of sequences from the second step on; those of the first are a split's number times 2^40 and up.
AGAIN = 1 << 61


class BestFit:
    """The open sequences of one partition."""

    def __init__(self, capacity: int, open_bins: int, first: int = 0):
        self.capacity, self.open_bins, self.next = capacity, open_bins, first
        self.free = 0  # bit f is set while an open sequence has f places free
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = 0
        self.closed: list[int] = []  # since they were last taken from here

    def _take(self, free: int) -> int:
        own = self.bins[free]
        number = own.pop()
        if not own:
            self.free &= ~(1 << free)
        self.n_open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The sequence that takes a piece of ``length``, and where it begins there."""
        fits = self.free >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.n_open == self.open_bins:
                self.closed.append(self._take((self.free & -self.free).bit_length() - 1))
            free, number = self.capacity, self.next
            self.next += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.free |= 1 << left
            self.n_open += 1
        else:
            self.closed.append(number)
        return number, self.capacity - free


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", *, path: str | None = None, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """A row for each piece of each document: where it lies in which sequence.

    ``with_ids`` adds the piece's token ids (``ids``), from which sequences can
    be written: order by ``sequence_id, offset``.
    """
    path = path or wordbpe.default_path()
    key_type = df.schema[key].dataType
    columns = "piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    shape = StructType([StructField("key", key_type), *StructType.fromDDL(columns).fields, StructField("open", BooleanType())])
    arrow = to_arrow_schema(shape)

    def batch_of(rows: list[tuple], open_: bool) -> pa.RecordBatch:
        made = zip(*rows, strict=True) if rows else [()] * (len(shape) - 1)
        return pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(made, arrow, strict=False)), pa.array([open_] * len(rows), pa.bool_())], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = wordbpe.word_bpe(path)
        bins = BestFit(capacity, open_bins, TaskContext.get().partitionId() << 40)
        last = np.array([end_id], dtype="<u4").tobytes()
        held: dict[int, list[tuple]] = {}  # the pieces of each open sequence
        for batch, texts in common.text_slices(batches, "text"):
            for own_key, own in zip(batch.column("key").to_pylist(), bpe.encode(texts), strict=True):
                own += last
                total = len(own) // 4
                for piece, first in enumerate(range(0, total, capacity)):
                    n = min(capacity, total - first)
                    cut = own[4 * first : 4 * (first + n)]
                    number, at = bins.place(n)
                    row = (own_key, piece, first, n, zlib.crc32(cut), number, at)
                    held.setdefault(number, []).append((*row, np.frombuffer(cut, dtype="<u4").astype(np.int32)) if with_ids else row)
            if bins.closed:
                yield batch_of([row for number in bins.closed for row in held.pop(number)], False)
                bins.closed = []
        yield batch_of([row for rows in held.values() for row in rows], True)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = list(batches)
        if not own:
            return
        whole = pa.Table.from_batches(own)
        # An order that doesn't depend on how the rows arrived.
        whole = whole.take(pc.sort_indices(whole, [("length", "descending"), ("ids_crc32", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")]))
        bins = BestFit(capacity, max(open_bins, whole.num_rows), AGAIN + (TaskContext.get().partitionId() << 40))
        placed = [bins.place(n) for n in whole["length"].to_pylist()]
        for name, at in (("sequence_id", 0), ("offset", 1)):
            whole = whole.set_column(whole.schema.get_field_index(name), name, pa.array([p[at] for p in placed], pa.int64()))
        yield from whole.to_batches(max_chunksize=10_000)

    first = common.cut(df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, shape))
    left = first.where("open")
    tokens = left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    merged = left.repartition(max(1, -(-tokens // MERGED))).mapInArrow(again, shape)
    return first.where("not open").union(merged).select(F.col("key").alias(key), *[f.name for f in shape if f.name not in ("key", "open")])


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.documents(spark, sf_dir))
