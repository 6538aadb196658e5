"""Replica and additive-measure reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmark.operators.unions import union_all


def compare_rows(src: DataFrame, dst: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Every key of either side with ``verdict``: matching, differing, missing or extra.

    Values are compared one by one and NULL-safe; a row hash would treat shifted NULLs as equal.
    """
    both = src.select(key, *cols).alias("s").join(
        dst.select(key, *cols).alias("d"), F.col(f"s.{key}") == F.col(f"d.{key}"), "full_outer"
    )
    same = F.lit(True)
    for name in cols:
        same = same & F.col(f"s.{name}").eqNullSafe(F.col(f"d.{name}"))
    verdict = (
        F.when(F.col(f"d.{key}").isNull(), "missing")
        .when(F.col(f"s.{key}").isNull(), "extra")
        .when(same, "matching")
        .otherwise("differing")
    )
    return both.select(F.coalesce(f"s.{key}", f"d.{key}").alias(key), verdict.alias("verdict"))


def reconcile(src: DataFrame, dst: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """One row of counts over compare_rows."""
    verdict = F.col("verdict")
    return compare_rows(src, dst, key, cols).agg(
        F.count_if(verdict != "extra").alias("source_rows"),
        F.count_if(verdict != "missing").alias("replica_rows"),
        F.count_if(verdict == "matching").alias("matching_rows"),
        F.count_if(verdict == "missing").alias("missing_rows"),
        F.count_if(verdict == "extra").alias("extra_rows"),
        F.count_if(verdict == "differing").alias("differing_rows"),
    )


def replica_lag(sources: Mapping[str, DataFrame], replicas: Mapping[str, DataFrame]) -> DataFrame:
    """Rows each replica is behind its source."""
    parts = []
    for name, src in sources.items():
        counted = src.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(1).alias("side"), "rows")
        mirrored = replicas[name].agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(0).alias("side"), "rows"
        )
        part = counted.unionByName(mirrored).agg(
            F.lit(name).alias("table_name"),
            F.sum(F.when(F.col("side") == 1, F.col("rows"))).alias("source_rows"),
            F.sum(F.when(F.col("side") == 0, F.col("rows"))).alias("replica_rows"),
        )
        parts.append(part.withColumn("lag_rows", F.col("source_rows") - F.col("replica_rows")))
    return union_all(parts)


def select_keys(df: DataFrame, key: str, wanted: DataFrame | Sequence) -> DataFrame:
    """Rows whose key is in a set: a literal list as IN, a frame of keys as a semi join."""
    if isinstance(wanted, DataFrame):
        return df.join(wanted.select(key), key, "left_semi")
    return df.where(F.col(key).isin(list(wanted)))


def reconcile_totals(fact_or_lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders whose stored total is not the sum of their lines.

    Lines are summed per order first, so both join sides are unique on the key.
    """
    sums = fact_or_lines.groupBy("order_id").agg(
        F.sum("line_amount").cast("decimal(38,2)").alias("lines_total")
    )
    heads = orders.select("order_id", "total_amount")
    gap = (F.col("total_amount") - F.col("lines_total")).cast("decimal(38,2)")
    return (
        sums.join(heads, "order_id")
        .withColumn("difference", gap)
        .where(F.col("difference") != 0)
        .select("order_id", "total_amount", "lines_total", "difference")
    )
