"""Jobs as a stream: drained once, without repeats, appended idempotently."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators.picks import append_new
from inkwell.sources.storage import shared_folder


def job_stream(spark: SparkSession, path: str, schema, pattern: str = "*.parquet", files: int = 4) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", pattern).parquet(path)


def distinct_jobs(jobs: DataFrame, keys: list[str], time: str = "ts", late: str = "1 hour") -> DataFrame:
    """First arrivals of each key within the watermark; later ones are dropped, and state is bounded by it."""
    return jobs.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(jobs: DataFrame, by: str, time: str = "ts", width: str = "1 day", late: str = "1 hour") -> DataFrame:
    return jobs.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def drain(stream: DataFrame, target: str, keys: list[str]) -> None:
    """Run over all that is there, then stop; batches append only keys that are new, so a repeated batch changes nothing."""
    spark = stream.sparkSession

    def write(batch: DataFrame, _: int) -> None:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            batch = append_new(spark.read.parquet(target), batch, keys)
        batch.write.mode("append").parquet(target)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", shared_folder(spark, "stream")).trigger(availableNow=True).start()
    query.awaitTermination()


def drained(stream: DataFrame, mode: str = "append") -> DataFrame:
    """All that the stream gives for what is there now, as a table."""
    spark = stream.sparkSession
    target, state = shared_folder(spark, "drained"), shared_folder(spark, "stream")
    query = stream.writeStream.format("parquet").outputMode(mode).option("path", target).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)
