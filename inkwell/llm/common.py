"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, for Java's and Python's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that one step of an Arrow operator works on at a time.
SLICE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all of the cluster shares, from ``spark.checkpoint.dir``.

    Only a local session without one gets a folder of its own; on a cluster,
    whose executors would not share it, its absence is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="inkwell-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut: written once as a table in the shared folder, and read again.

    Unlike ``checkpoint()``, which runs its last stage twice, this computes
    ``df`` once; the files are compressed and any executor reads them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/inkwell-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._inkwell_path = path
    return out


def drop(df: DataFrame | None) -> None:
    """Delete the files of a table that ``cut`` made, when nothing reads it any more."""
    if path := getattr(df, "_inkwell_path", None):
        jvm = df.sparkSession.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Pieces of the batches with about ``most`` bytes of text each, and their texts with null as empty."""
    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        first = held = 0
        for i, n in enumerate(sizes):
            held += int(n) + 64
            if held >= most or i + 1 == len(sizes):
                piece = batch.slice(first, i + 1 - first)
                yield piece, [t or "" for t in piece.column(column).to_pylist()]
                first, held = i + 1, 0


def uniform(*columns: Column, seed: int) -> Column:
    """A number in (0, 1) from a hash of the columns."""
    bits = F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 12)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
