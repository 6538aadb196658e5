"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "brookmark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job here assumes; a submit flag still wins over them.

    Joins carry no broadcast hints: Spark broadcasts a side only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits skewed partitions.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a skewed join even where that costs the next operator a shuffle of its own
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        # recording the Python call site of every column expression doubles the time to build a plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stored(df: DataFrame, folder: str) -> DataFrame:
    """Write a frame that several later jobs read, and read it back from the shared folder."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for streaming checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is made only where
    that is unset and the session itself is local.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="brookmark-")
