"""Change-log sources: one raw JSON message per row, one topic per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_cdc(spark: SparkSession, options: dict[str, str], topic: str) -> DataFrame:
    """Topic as a stream of raw messages; a new checkpoint starts at the earliest offset.

    Needs the Kafka connector on the classpath. ``seq`` orders messages within a partition.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("startingOffsets", "earliest")
        .options(**options)
        .option("subscribe", topic)
        .load()
    )
    return raw.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("seq"))


def read_cdc_files(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Folder of message files (one JSON message per line) as the same stream."""
    return (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
        .select("value")
    )
