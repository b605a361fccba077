"""Vectors: pooling, concept buckets, bags of words, gates."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the concept buckets.
LSH_BITS, LSH_TABLES, LSH_SEED = 12, 4, 6132
#: Buckets of the hashed bag of words.
BOW_BUCKETS = 1 << 18


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def unit(v: Column) -> Column:
    """L2-normalised; a zero vector stays as it is."""
    size = norm(v)
    return F.transform(v, lambda x: F.when(size > 0, x.cast("double") / size).otherwise(x.cast("double")))


def pooled(rows: DataFrame, keys: list[str], vector: str, how: str = "avg", weight: str | None = None) -> DataFrame:
    """keys, ``vector``: the mean (weighted by ``weight``) or maximum by position.

    Positions are aggregated apart, with partial sums, so a key's vectors
    never have to meet in memory.
    """
    each = rows.where(F.col(vector).isNotNull()).select(*keys, *([weight] if weight else []), F.posexplode(vector).alias("__i", "__x"))
    x = F.col("__x").cast("double")
    value = F.max(x) if how == "max" else F.sum(x * F.col(weight)) / F.sum(weight) if weight else F.avg(x)
    by = each.groupBy(*keys, "__i").agg(value.alias("__v"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("__i", "__v"))), lambda s: s["__v"])
    return by.groupBy(*keys).agg(listed.alias(vector))


def pooled_chunks(chunks: DataFrame, key: str, vector: str = "embedding", level: str = "is_document_level", text: str = "content", order: str = "seq") -> DataFrame:
    """key, vector, content: unit chunks averaged and made unit again, texts joined; null vector without any chunk.

    Document-level rows are left out; a chunk without a vector keeps its text.
    """
    own = chunks.where(~F.col(level))
    units = own.where(F.col(vector).isNotNull()).withColumn(vector, unit(F.col(vector)))
    mean = pooled(units, [key], vector)
    mean = mean.select(key, "*").select(key, unit(F.col(vector)).alias(vector))
    part = F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct(order, text))))
    texts = own.groupBy(key).agg(F.array_join(F.transform(part, lambda s: s[text]), " ").alias(text))
    return chunks.select(key).distinct().join(mean, key, "left").join(texts, key, "left")


@lru_cache
def projection(dim: int, bits: int = LSH_BITS, tables: int = LSH_TABLES, seed: int = LSH_SEED) -> np.ndarray:
    """[table, bit, dimension] normals of the hyperplanes, the same in every process."""
    return np.random.default_rng(seed).standard_normal((tables, bits, dim))


def concept_buckets(vector: Column, dim: int, bits: int = LSH_BITS, tables: int = LSH_TABLES, seed: int = LSH_SEED) -> Column:
    """A bucket for each table: the signs of the projections as a number, low bit first, plus the table's offset."""
    planes = projection(dim, bits, tables, seed)

    def bucket(table: int) -> Column:
        signs = F.array(*[F.array(*map(F.lit, planes[table, b].tolist())) for b in range(bits)])
        dot = lambda plane: F.aggregate(F.zip_with(vector, plane, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, p: s + p)
        code = F.aggregate(F.transform(signs, lambda p, i: F.when(dot(p) > 0, F.pow(F.lit(2), i).cast("int")).otherwise(0)), F.lit(0), lambda s, c: s + c)
        return code + table * (1 << bits)

    return F.array(*map(bucket, range(tables)))


def concept_histogram(rows: DataFrame, key: str, vector: str, dim: int, **config: int) -> DataFrame:
    """key, bucket, n over all of a key's vectors."""
    each = rows.select(key, F.explode(concept_buckets(F.col(vector), dim, **config)).alias("bucket"))
    return each.groupBy(key, "bucket").agg(F.count("*").alias("n"))


def is_valid(vector: Column) -> Column:
    return F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def standardised(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Each vector's positions as z-scores within its key (0 where a position doesn't vary)."""
    from pyspark.sql import Window

    each = rows.withColumn("__r", F.monotonically_increasing_id()).select(key, "__r", F.posexplode(vector).alias("__i", "__x"))
    w = Window.partitionBy(key, "__i")
    sd = F.stddev_pop(F.col("__x").cast("double")).over(w)
    z = each.withColumn("__z", F.when(sd > 0, (F.col("__x") - F.avg("__x").over(w)) / sd).otherwise(F.lit(0.0)))
    return z.groupBy(key, "__r").agg(F.transform(F.array_sort(F.collect_list(F.struct("__i", "__z"))), lambda s: s["__z"]).alias(vector)).drop("__r")


def row_unit(v: Column, epsilon: float = 1e-10) -> Column:
    size = norm(v) + epsilon
    return F.transform(v, lambda x: x.cast("double") / size)


def bag_of_words(docs: DataFrame, text: str, out: str = "bow", buckets: int = BOW_BUCKETS) -> DataFrame:
    """``docs`` with the unit sparse counts of hashed lower-case tokens of two word characters or more."""
    from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer

    tokens = RegexTokenizer(inputCol=text, outputCol="__t", gaps=False, pattern=r"(?U)\b[\w-]{2,}\b", toLowercase=True).transform(docs)
    counted = HashingTF(inputCol="__t", outputCol="__tf", numFeatures=buckets).transform(tokens)
    return Normalizer(inputCol="__tf", outputCol=out, p=2.0).transform(counted).drop("__t", "__tf")


def with_missing_as_zero(wanted: DataFrame, vectors: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """Every wanted key with its vector, or a zero one and ``valid`` false."""
    joined = wanted.join(vectors.select(key, vector), key, "left")
    zero = F.array_repeat(F.lit(0.0), dim)
    own = F.transform(vector, lambda x: x.cast("double"))
    return joined.withColumn(vector, F.coalesce(own, zero)).withColumn("valid", is_valid(F.col(vector)))
