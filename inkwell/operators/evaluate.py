"""Comparing extracted with expected sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_statistics(found: DataFrame, expected: DataFrame, key: str, entities: str = "entities") -> DataFrame:
    """One row of totals and percentages over the keys of both; zero where undefined."""
    both = found.select(key, F.col(entities).alias("a")).join(expected.select(key, F.col(entities).alias("b")), key)
    sized = both.select(
        F.size(F.array_intersect("a", "b")).alias("common"), F.size(F.array_except("a", "b")).alias("only_a"), F.size(F.array_except("b", "a")).alias("only_b"),
    )
    exact = F.count_if((F.col("only_a") == 0) & (F.col("only_b") == 0))
    sums = sized.agg(F.sum("common").alias("common"), F.sum("only_a").alias("only_found"), F.sum("only_b").alias("only_expected"), F.count("*").alias("compared"), exact.alias("exact"))
    total = F.col("common") + F.col("only_found") + F.col("only_expected")
    share = lambda c: F.coalesce(F.try_divide(100.0 * F.col(c), total), F.lit(0.0))
    return sums.select("*", share("common").alias("pct_common"), share("only_found").alias("pct_found"), share("only_expected").alias("pct_expected"), F.coalesce(F.try_divide(F.col("exact").cast("double"), F.col("compared")), F.lit(0.0)).alias("exact_rate"))


def differences(found: DataFrame, expected: DataFrame, key: str, entities: str = "entities") -> DataFrame:
    """key, n_common, only_found, only_expected, n of the keys whose sets differ."""
    both = found.select(key, F.col(entities).alias("a")).join(expected.select(key, F.col(entities).alias("b")), key)
    text = lambda x, y: F.array_join(F.array_sort(F.array_except(x, y)), " | ")
    n = F.size(F.array_except("a", "b")) + F.size(F.array_except("b", "a"))
    return both.select(key, F.size(F.array_intersect("a", "b")).alias("n_common"), text("a", "b").alias("only_found"), text("b", "a").alias("only_expected"), n.alias("n")).where("n > 0")


def threshold_sweep(scored: DataFrame, gold: DataFrame, key: str, thresholds: list[float]) -> DataFrame:
    """threshold, similarity: the mean Jaccard similarity of names scored at least so, and of gold names.

    Keys with neither are left out. ``scored`` has (key, name, score), ``gold`` (key, name).
    """
    grid = scored.sparkSession.createDataFrame([(float(t),) for t in thresholds], "threshold double")
    own = scored.select(key, F.lower("name").alias("name"), "score").groupBy(key, "name").agg(F.max("score").alias("score"))
    marked = own.join(gold.select(key, F.lower("name").alias("name"), F.lit(1).alias("gold")).distinct(), [key, "name"], "full")
    # The grid is a short list: each row meets each threshold once, without a shuffle.
    each = marked.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    kept, is_gold = F.coalesce(F.col("score") >= F.col("threshold"), F.lit(False)), F.col("gold").isNotNull()
    by = each.groupBy(key, "threshold").agg(F.count_if(kept & is_gold).alias("common"), F.count_if(kept | is_gold).alias("any"))
    mean = by.where("any > 0").groupBy("threshold").agg(F.avg(F.col("common") / F.col("any")).alias("similarity"))
    return grid.join(mean, "threshold", "left").select("threshold", F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The first threshold of the highest similarity."""
    return sweep.orderBy(F.desc("similarity"), "threshold").limit(1)
