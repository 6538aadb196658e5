"""Row counts and bounds from file footers."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_READERS = "spark.sql.sources.useV1SourceList"
_PUSHED = "spark.sql.parquet.aggregatePushdown"


@contextmanager
def _set(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    try:
        spark.conf.set(key, value)
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def bounds(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """One row: ``row_count``, and ``<column>_low`` and ``<column>_high`` of whole-number, float or date columns.

    The aggregation is pushed into the scan, which answers it from the statistics of the files' footers and
    reads no row; Spark itself falls back to reading where a file lacks them. The session's setting for such
    scans stays on, since plans that hold this one are made later; no other reader looks at it.
    """
    spark.conf.set(_PUSHED, "true")
    with _set(spark, _READERS, ""):
        rows = spark.read.parquet(path)
    wanted = [F.count(F.lit(1)).alias("row_count")]
    for name in columns:
        wanted += [F.min(name).alias(f"{name}_low"), F.max(name).alias(f"{name}_high")]
    return rows.agg(*wanted)
