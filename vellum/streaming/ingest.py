"""Incremental ingest: file streams of events into windows and into last states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.sources.storage import shared_path


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1).parquet(sf_dir)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(start, event_type, n, total): counts and sums of events by hour (its first second) and type; windows that the
    watermark has passed are written once. Sums are of whole ten-thousandths, so the order of events cannot move them."""
    windows = _events(spark, sf_dir).withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), (F.sum(F.round(F.col("value") * 10_000).cast("long")) / 10_000).alias("total"))
    out = shared_path(spark, "windows")
    flat = windows.select(F.unix_seconds("window.start").alias("start"), "event_type", "n", "total")
    q = flat.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", shared_path(spark, "windows-log")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("start long, event_type string, n long, total double").parquet(out)


def last_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user and how many there were: each batch is merged with the state so far, and written as
    the next state under its batch's number, so that a batch that runs again writes the same state."""
    root = shared_path(spark, "states")
    names = ["user_id", "event_id", "event_type", "n"]

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        new = batch.groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max_by("event_type", "event_id").alias("event_type"), F.count("*").alias("n"))
        if number:
            both = session.read.parquet(f"{root}/{number - 1}").select(names).unionByName(new)
            new = both.groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max_by("event_type", "event_id").alias("event_type"), F.sum("n").alias("n"))
        new.select(names).write.mode("overwrite").parquet(f"{root}/{number}")
        last[0] = number

    last = [-1]
    q = _events(spark, sf_dir).writeStream.foreachBatch(merge).option("checkpointLocation", shared_path(spark, "states-log")).trigger(availableNow=True).start()
    q.awaitTermination()
    if last[0] < 0:
        return spark.createDataFrame([], "user_id long, event_id long, event_type string, n long")
    return spark.read.parquet(f"{root}/{last[0]}")
