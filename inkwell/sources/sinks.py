"""Writers. Writes are idempotent: rows that are already there count as done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators.picks import append_new
from inkwell.sources.storage import shared_folder


def append_tags(spark: SparkSession, path: str, tags: DataFrame, keys: list[str]) -> DataFrame:
    """Append the tags whose key isn't in the table at ``path`` yet; what is written comes back."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    new = append_new(spark.read.parquet(path), tags, keys) if there else append_new(tags.limit(0), tags, keys)
    staged = f"{shared_folder(spark, 'tags')}"
    new.write.parquet(staged)  # decided once, before the table changes
    fresh = spark.read.schema(tags.schema).parquet(staged)
    fresh.write.mode("append").parquet(path)
    return fresh


def test_lines(rows: DataFrame, curie: str, names: str) -> DataFrame:
    """curie, entities: lists joined by " | "."""
    return rows.select(curie, F.array_join(F.array_sort(names), " | ").alias("entities"))


def write_tsv(rows: DataFrame, path: str, header: bool = True) -> None:
    rows.write.mode("overwrite").csv(path, sep="\t", header=header, emptyValue="", nullValue="")


def write_csv(rows: DataFrame, path: str, digits: int = 4, scores: tuple[str, ...] = ("score",)) -> None:
    rows.withColumns({c: F.round(c, digits) for c in scores if c in rows.columns}).write.mode("overwrite").csv(path, header=True)


def wide_vectors(rows: DataFrame, keys: list[str], vector: str, dim: int) -> DataFrame:
    """A column for each dimension."""
    return rows.select(*keys, *[F.get(vector, F.lit(i)).alias(f"d{i}") for i in range(dim)])


def write_text(rows: DataFrame, path: str, key: str, text: str) -> None:
    """A folder of text for each key."""
    rows.select(key, F.col(text).alias("value")).write.mode("overwrite").partitionBy(key).text(path)


def on_top(new: DataFrame, old: DataFrame, line: str = "value") -> DataFrame:
    """New lines before old ones, as (part, line); the order is that of the parts."""
    return new.select(F.lit(0).alias("part"), line).unionByName(old.select(F.lit(1).alias("part"), line))


# topics' flags and departments.
FLAGS = {"ATP:0000152": "disease", "ATP:0000013": "new_transg", "ATP:0000006": "new_al", "ATP:0000069": "phys_int", "ATP:0000207": "nocur", "ATP:0000005": "gene"}
DEPARTMENTS = {"ATP:0000152": "dis", "ATP:0000013": "cam", "ATP:0000006": "cam", "ATP:0000069": "harv", "ATP:0000207": "cam", "ATP:0000005": "cam"}


def chosen(topic: Column, names: dict[str, str], unknown: str) -> Column:
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.get(F.array(known[topic]), F.lit(0)), F.concat(F.lit(unknown), topic))


def export_line(created: Column, curie: Column, topic: Column, level: Column) -> Column:
    """A curation record of a tag: day, paper, flag and level, department."""
    flag = F.concat(chosen(topic, FLAGS, "UNKNOWN_FLAG_"), F.lit(":"), level)
    return F.concat_ws("\t", F.date_format(created, "yyMMdd"), F.lit(""), F.substring(curie, 6, 1000), flag, chosen(topic, DEPARTMENTS, "UNKNOWN_ATP_"))
