"""Registered queries over the test tables, each with the ANSI SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

_GROUPS = ("models", "keyed", "changes", "quality", "signals", "upkeep", "asking", "layout")


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the test tables have them."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in zoned}) if zoned else df


def _runner(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        return _plain(build(spark, sf_dir))

    return run


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for group in _GROUPS:
        module = import_module(f"{__name__}.{group}")
        found.update({name: _runner(build) for name, build in module.QUERIES.items()})
    return found


def all_oracles() -> dict[str, str]:
    found: dict[str, str] = {}
    for group in _GROUPS:
        found.update(import_module(f"{__name__}.{group}").ORACLE)
    return found
