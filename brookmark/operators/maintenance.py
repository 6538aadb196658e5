"""Retention, expiry, orphan detection, compaction, clustering and storage reports."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brookmark.functions.scalars import day_from_parts
from brookmark.operators.unions import union_all
from brookmark.sources.files import list_files

TARGET_BYTES = 128 * 1024 * 1024


def dated_folder(path: Column) -> Column:
    """Day of a ``<table>_source/yyyy/mm/dd/<file>`` path; NULL for anything else."""
    parts = F.split(path, "/")
    day = day_from_parts(F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(3)))
    return F.when(F.size(parts) >= 4, day)


def ingest_folder(path: Column) -> Column:
    """Day of a path under an ``ingest_date=<day>`` folder; NULL for anything else."""
    return F.regexp_extract(path, "/ingest_date=([0-9]{4}-[0-9]{2}-[0-9]{2})/", 1).try_cast("date")


def prune_partitions(listing: DataFrame, now: datetime, days: int = 7, path: str = "path",
                     day_of: Callable[[Column], Column] = dated_folder) -> DataFrame:
    """Landed objects whose day folder began more than ``days`` days ago.

    Anything without a valid day is left alone, and zero days switches retention off. Nothing is
    deleted here.
    """
    if days <= 0:
        return listing.limit(0)
    cutoff = F.lit(now - timedelta(days=days)).cast("timestamp")
    dated = listing.withColumn("partition_day", day_of(F.col(path)))
    return dated.where(F.col("partition_day").cast("timestamp") < cutoff)


def expire_versions(listing: DataFrame, now: datetime, days: int = 7, keep: int = 5) -> DataFrame:
    """Versions older than ``days`` days that are not among a table's last ``keep``.

    Only the newest ``keep`` of each table are ranked (a group limit before the shuffle); the
    oldest of them is the line below which versions may go.
    """
    newest = Window.partitionBy("table_name").orderBy(
        F.col("committed_at").desc(), F.col("version").desc()
    )
    place = F.struct("committed_at", "version")
    line = (
        listing.withColumn("place", F.row_number().over(newest))
        .where(F.col("place") <= keep)
        .groupBy("table_name")
        .agg(F.min(place).alias("line"))
    )
    cutoff = F.lit(now - timedelta(days=days)).cast("timestamp")
    return (
        listing.where(F.col("committed_at") < cutoff)
        .join(line, "table_name")
        .where(place < F.col("line"))
        .drop("line")
    )


def orphan_files(listing: DataFrame, referenced: DataFrame, now: datetime,
                 min_age_days: int = 3) -> DataFrame:
    """Files no live version refers to and that are old enough not to be in flight."""
    cutoff = F.lit(now - timedelta(days=min_age_days)).cast("timestamp")
    return listing.where(F.col("modified_at") < cutoff).join(
        referenced.select("path"), "path", "left_anti"
    )


def cluster_by(df: DataFrame, cols: list[str], partitions: int, spread: list[str]) -> DataFrame:
    """Rows ordered on ``cols`` over range partitions, so file statistics skip well.

    Ordering on one column is what a one-column Z-order amounts to. ``spread`` (a key) ends the
    range order, so a value that holds a large share of the rows is cut into several partitions.
    """
    order = [F.col(c) for c in (*cols, *spread)]
    return df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)


def _rank(x: Column, bounds: list, low: int, high: int) -> Column:
    """How many of ``bounds`` lie under a value, by halving; NULL has rank 0."""
    if low == high:
        return F.lit(low).cast("long")
    middle = (low + high) // 2
    return F.when(x > F.lit(bounds[middle]), _rank(x, bounds, middle + 1, high)).otherwise(_rank(x, bounds, low, middle))


def _sortable(df: DataFrame, name: str) -> Column:
    """A column as something that has quantiles; a text stands for its first seven bytes."""
    if df.schema[name].dataType.simpleString() != "string":
        return F.col(name)
    head = F.rpad(F.hex(F.substring(F.encode(name, "UTF-8"), 1, 7)), 14, "0")
    return F.conv(head, 16, 10).cast("long")


def zorder_by(df: DataFrame, cols: list[str], partitions: int, spread: list[str], bits: int = 6) -> DataFrame:
    """Rows in Z-order of several columns over range partitions, so that a filter on any of them skips files.

    Each column is cut at its ``2 ** bits - 1`` approximate quantiles, found in one scan and the only thing that reaches the
    driver; the bits of the ranks are interleaved. A value that many rows share covers several ranks, of
    which its rows take the lowest; ``spread`` (a key) ends the order, so that a full cell is cut into
    several partitions. Numbers, dates, timestamps and texts may be given; NULL comes first.
    """
    if len(cols) * bits > 62:
        raise ValueError("too many bits for a long")
    held = {f"_x{i}": _sortable(df, c) for i, c in enumerate(cols)}
    steps = [i / 2**bits for i in range(1, 2**bits)]
    marks = df.select(*[x.alias(n) for n, x in held.items()]).agg(*[F.percentile_approx(n, steps).alias(n) for n in held]).first()
    code = F.lit(0).cast("long")
    for i, (name, x) in enumerate(held.items()):
        bounds = marks[name] or []
        rank = _rank(x, bounds, 0, len(bounds))
        for bit in range(bits):
            code = code.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * len(cols) + i))
    order = [F.col("_z"), *[F.col(c) for c in spread]]
    return df.withColumn("_z", code).repartitionByRange(partitions, *order).sortWithinPartitions(*order).drop("_z")


def storage_report(df: DataFrame, table: str, day: Column, top: int = 20) -> DataFrame:
    """Bytes, rows, files and day range of a parquet-backed frame (only ``day`` is read)."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.first("_metadata.file_size").alias("bytes"),
        F.count(F.lit(1)).alias("n"),
        F.min(day).alias("low"),
        F.max(day).alias("high"),
    )
    return per_file.agg(
        F.lit(table).alias("table_name"),
        F.sum("bytes").alias("total_bytes"),
        F.sum("n").alias("row_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.min("low").alias("oldest"),
        F.max("high").alias("newest"),
    ).limit(top)


def largest_tables(reports: list[DataFrame], top: int = 20) -> DataFrame:
    return union_all(reports).orderBy(F.col("total_bytes").desc(), F.col("table_name")).limit(top)


def folder_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per data folder of a parquet table."""
    folder = F.regexp_replace("path", "/[^/]+$", "")
    return (
        list_files(spark, path)
        .groupBy(folder.alias("folder"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    )


def _decoded(text: Column) -> Column:
    # '+' is a plain character in paths
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _folder_columns(folder: str, root: str) -> list[str]:
    tail = folder.split(root.rstrip("/").split(":")[-1].lstrip("/"), 1)[-1]
    return [part.split("=", 1)[0] for part in tail.split("/") if "=" in part]


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES,
            out: str | None = None, order_by: str | None = None) -> int:
    """Rewrite the folders that hold more files than their size needs; returns how many.

    Folders of a partitioned table are replaced in place through dynamic partition overwrite.
    An unpartitioned table cannot be replaced while it is read and is written to ``out``. Rows
    are dealt to files by their position in the old files, so equal rows never pile up, and may
    be ordered within each file.
    """
    need = F.greatest(F.ceil(F.col("bytes") / F.lit(target_bytes)), F.lit(1)).cast("int")
    todo = [
        (r.folder, r.need)
        for r in folder_sizes(spark, path).withColumn("need", need).where("files > need").collect()
    ]
    if not todo:
        return 0
    columns = _folder_columns(todo[0][0], path)
    if not columns and out is None:
        raise ValueError("compacting an unpartitioned table needs an output path")
    plan = spark.createDataFrame(todo, "folder string, need int")
    file_path = F.col("_metadata.file_path")
    rows = (
        spark.read.parquet(*[folder for folder, _ in todo])
        .select(
            "*",
            _decoded(F.regexp_replace(file_path, "/[^/]+$", "")).alias("_folder"),
            F.xxhash64(file_path, F.col("_metadata.row_index")).alias("_deal"),
        )
        .join(plan, F.col("_folder") == F.col("folder"), "left")
        .withColumn("_need", F.coalesce("need", F.raise_error(F.concat(F.lit("no plan for folder "), F.col("_folder"))).cast("int")))
        .withColumn("_file", F.pmod(F.col("_deal"), F.col("_need")))
    )
    for name in columns:
        value = _decoded(F.regexp_extract("_folder", f"/{name}=([^/]*)", 1))
        rows = rows.withColumn(name, F.when(value != "__HIVE_DEFAULT_PARTITION__", value))
    total = sum(n for _, n in todo)
    rows = rows.repartition(total, "_folder", "_file").drop("_folder", "folder", "_deal", "need", "_need", "_file")
    if order_by:
        rows = rows.sortWithinPartitions(*columns, order_by)
    writer = rows.write.mode("overwrite")
    if columns:
        writer.partitionBy(*columns).option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.parquet(out)
    return len(todo)
