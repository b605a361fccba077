"""Weighted rendezvous hashing of records over shards.

Law ``key``: a record's shard depends on its key and the shards alone. Each
shard draws a uniform number from a hash of (key, shard) and scores
``-weight / ln(u)``; the highest score wins. A shard that is added takes only
the rows that it wins, from all others alike, and no row moves between old
shards; with equal weights that is 1/(n+1) of the rows.

Slots number a shard's rows from 0 without gaps. Ranks are taken within
(shard, bucket), where a bucket is a hash of key and text, and shifted by
the sizes of the shard's earlier buckets, so that no task ever holds a shard.

Defined results: a null text counts one byte and has the checksum of no bytes;
a null key is a key of its own (all such rows share a shard, spread over
buckets by their text); repeated rows get slots of their own; an empty table
gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkwell.llm import common

SHARDS = 16
BUCKETS = 256


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (from 0) with the highest score for the key."""
    scores = [F.struct((F.lit(-float(w)) / F.ln(common.uniform(key, seed=1_000_003 + i))).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]
    return (F.greatest(*scores) if len(scores) > 1 else scores[0])["shard"]


def with_slots(df: DataFrame, shard: str, order: list[str], spread: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` with ``slot``: gapless numbers from 0 within each ``shard``."""
    placed = df.withColumn("__bucket", F.pmod(F.xxhash64(*spread, F.lit(77)), F.lit(buckets)).cast("int"))
    sizes = placed.groupBy(shard, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(shard).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(shard, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    # At most shards x buckets rows, whatever the input: a bounded broadcast.
    rank = F.row_number().over(Window.partitionBy(shard, "__bucket").orderBy(*order)) - 1
    ranked = placed.withColumn("__rank", rank)
    return ranked.join(F.broadcast(bases), [shard, "__bucket"]).withColumn("slot", F.col("__base") + F.col("__rank")).drop("__bucket", "__base", "__rank")


def shard_rows(df: DataFrame, key: str = "doc_id", text: str = "text", *, weights: list[float] | None = None, grown_weight: float = 1.0, buckets: int = BUCKETS) -> DataFrame:
    """key, size, text_crc32, law, shard, slot and the shard with one more (``grown_shard``)."""
    weights = weights or [1.0] * SHARDS
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    slim = df.select(
        key,
        (F.octet_length(data).cast("long") + 1).alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, grown_weight]).alias("grown_shard"),
    )
    return with_slots(slim, "shard", [key, "text_crc32", "size"], [key, "text_crc32"], buckets).select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(common.documents(spark, sf_dir))
