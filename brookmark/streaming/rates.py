"""Message rates and consumer lag."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OFFSETS = "map<string,map<string,bigint>>"


def message_rate(df: DataFrame, ts: str, topic: str, window: str = "5 minutes",
                 watermark: str | None = None) -> DataFrame:
    """Messages per second and topic in tumbling windows; give a watermark on streams."""
    timed = df.withWatermark(ts, watermark) if watermark else df
    counted = timed.groupBy(F.window(ts, window).alias("w"), topic).agg(
        F.count(F.lit(1)).alias("messages")
    )
    seconds = F.unix_seconds(F.col("w.end")) - F.unix_seconds(F.col("w.start"))
    return counted.select(
        F.col("w.start").alias("window_start"),
        topic,
        "messages",
        (F.col("messages") / seconds).alias("per_second"),
    )


def consumer_lag(spark: SparkSession, progress: Iterable[str]) -> DataFrame:
    """Messages not yet consumed per topic and trigger, from streaming progress reports.

    ``progress`` holds the JSON text of ``query.recentProgress`` entries, a bounded history that
    the query object keeps on the driver anyway.
    """
    source = "struct<description:string,endOffset:string,latestOffset:string>"
    schema = f"struct<timestamp:string,sources:array<{source}>>"
    reports = spark.createDataFrame([(p,) for p in progress], "report string")
    parsed = reports.select(F.from_json("report", schema).alias("p"))
    sources = parsed.select(
        F.to_timestamp("p.timestamp").alias("ts"), F.explode("p.sources").alias("s")
    )
    offsets = sources.select(
        "ts",
        F.from_json("s.endOffset", _OFFSETS).alias("read"),
        F.explode(F.from_json("s.latestOffset", _OFFSETS)).alias("topic", "latest"),
    )
    per_partition = offsets.select(
        "ts", "topic", F.explode("latest").alias("partition", "newest"),
        F.col("read").alias("read"),
    )
    behind = F.col("newest") - F.coalesce(F.col("read")[F.col("topic")][F.col("partition")], F.lit(0))
    return per_partition.groupBy("ts", "topic").agg(F.sum(behind).alias("lag"))
