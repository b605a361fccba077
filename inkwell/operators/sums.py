"""Sums of arrays over all rows: one array for each task, added up on the executors in a tree."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """[row, component] of a column of lists of one length."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1) if len(whole) else np.zeros((0, 0))


def _plus(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
    return b if a is None else a if b is None else a + b


def _added(arrays: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    total = None
    for a in arrays:
        total = _plus(total, a)
    if total is not None:
        yield total


#: Rows that are worked on at a time.
STEP = 1024


def batch_sums(rows: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray | None:
    """The sum over all rows, in batches of ``STEP`` at most, of ``of(batch)``, a flat array of one length; none without rows.

    Only one array a task leaves it, and only the sum reaches the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for k in range(0, batch.num_rows, STEP):
                total = _plus(total, np.asarray(of(batch.slice(k, STEP)), dtype=np.float64))
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    arrays = rows.mapInArrow(run, "s binary").rdd.map(lambda r: np.frombuffer(r[0], dtype=np.float64))
    return arrays.mapPartitions(_added).treeAggregate(None, _plus, _plus, 2)
