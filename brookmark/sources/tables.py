"""Stored tables: namespaces, first-run creation, keyed upserts, materialized models."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmark.operators.merge import merge_upsert


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def materialize(df: DataFrame, layer: str, name: str, view: bool = False) -> None:
    """Store a model under ``layer.name``; tables are rebuilt, views only registered."""
    spark = df.sparkSession
    if view:
        df.createOrReplaceTempView(f"{layer}_{name}")
        return
    ensure_namespace(spark, layer)
    df.write.mode("overwrite").format("parquet").saveAsTable(f"{layer}.{name}")


def create_table(df: DataFrame, table: str, partition_by: str | None = None) -> None:
    """First-run creation from a frame, partitioned by one low-cardinality attribute or not at all.

    The rebalance hint gathers each value into few files and lets adaptive execution split a
    value that dominates, instead of leaving it to one task.
    """
    if partition_by:
        df.hint("rebalance", partition_by).write.format("parquet").partitionBy(
            partition_by
        ).saveAsTable(table)
    else:
        df.write.format("parquet").saveAsTable(table)


def silver_upsert(
    updates: DataFrame,
    table: str,
    key: str,
    update_columns: tuple[str, ...],
    partition_by: str | None = None,
    skip_empty: bool = True,
) -> bool:
    """Create the table on its first batch, merge into it after that; False if nothing was done.

    Needs a catalog with row-level operations for the merge. Plain parquet tables use SlotTable.
    """
    spark = updates.sparkSession
    ensure_namespace(spark, table.rsplit(".", 1)[0])
    if skip_empty and updates.isEmpty():
        return False
    if not spark.catalog.tableExists(table):
        create_table(updates, table, partition_by)
        return True
    merge_into_catalog(updates, table, key, update_columns)
    return True


def merge_into_catalog(
    updates: DataFrame, table: str, key: str, update_columns: tuple[str, ...]
) -> None:
    """Row-level MERGE: overwrite the named columns on a match, insert the rest, delete nothing."""
    (
        updates.alias("u")
        .mergeInto(table, F.col(f"{table}.{key}") == F.col(f"u.{key}"))
        .whenMatched()
        .update({c: F.col(f"u.{c}") for c in update_columns})
        .whenNotMatched()
        .insertAll()
        .merge()
    )


class SlotTable:
    """Parquet table cut into key slots, so that a merge rewrites only the slots it touches.

    The slot is a function of the immutable key: ``floor(key / width)`` for dense integer keys (new
    and recently changed keys are neighbours, and a slot can never hold more than ``width`` rows),
    one of ``slots`` hashes for text keys or with ``width=None``. Rewrites use dynamic partition
    overwrite: tasks write aside and the driver swaps folders when all are done, so lost executors
    and failed jobs leave the table as it was, and a repeated merge gives the same rows. Only a
    driver that dies in the middle of the swap can leave a folder behind in the staging area; use
    SnapshotTable where even that must not happen.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, width: int | None = 1_000_000,
                 slots: int = 4096, order_by: str | None = None):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.width, self.slots, self.order_by = width, slots, order_by or key

    def _slot(self, df: DataFrame):
        key = F.col(self.key)
        if self.width and isinstance(df.schema[self.key].dataType, T.IntegralType):
            return F.floor(key / F.lit(self.width)).cast("long")
        return F.pmod(F.xxhash64(key), F.lit(self.slots))

    def _open(self) -> DataFrame | None:
        """The stored rows with their slot, or None before the first write; lists files once."""
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def read_or_none(self) -> DataFrame | None:
        rows = self._open()
        return None if rows is None else rows.drop("slot")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("slot")

    def write(self, df: DataFrame) -> None:
        """Write whole slots: the ones present in ``df`` are replaced, all others stay.

        Rows of a file are ordered by ``order_by``, so its statistics let readers skip.
        """
        (
            df.withColumn("slot", self._slot(df))
            .hint("rebalance", "slot")
            .sortWithinPartitions("slot", self.order_by)
            .write.partitionBy("slot")
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(self.path)
        )

    def touched(self, updates: DataFrame) -> DataFrame | None:
        """Stored rows of the slots an update batch falls into (a pruned scan); None if no table.

        The collected list is a set of folder names, never longer than the table has folders
        plus the new ones of this batch.
        """
        rows = self._open()
        if rows is None:
            return None
        slots = [r[0] for r in updates.select(self._slot(updates).alias("s")).distinct().collect()]
        return rows.where(F.col("slot").isin(slots)).drop("slot")

    def merge(self, updates: DataFrame, update_columns: tuple[str, ...],
              version: str | None = "updated_at", keys: DataFrame | None = None) -> None:
        """Keyed upsert of a batch that holds each key once.

        ``keys`` may name a cheaper frame with at least the batch's keys, such as the landed rows
        it was made from, to find the touched slots without working the batch out twice.
        """
        stored = self.touched(updates if keys is None else keys)
        if stored is None:
            self.write(updates)
            return
        self.write(merge_upsert(stored, updates, self.key, update_columns, version=version))


class SnapshotTable:
    """Whole-table versions with a commit list; readers always see one complete version.

    ``versions/v=<n>`` holds the rows and ``commits`` gets one row after the data is in place, so a
    job that dies in between leaves an unreferenced folder and no visible change.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commits(self) -> DataFrame:
        schema = "version long, committed_at timestamp, folder string"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def current(self) -> int | None:
        return self.commits().agg(F.max("version")).first()[0]

    def read(self, version: int | None = None) -> DataFrame | None:
        """Rows of a version, the newest by default; None before the first commit."""
        wanted = self.current() if version is None else version
        if wanted is None:
            return None
        return self.spark.read.parquet(self.folder(wanted))

    def folder(self, version: int) -> str:
        return f"{self.path}/versions/v={version}"

    def commit(self, df: DataFrame, at: datetime | None = None) -> int:
        last = self.current()
        version = 0 if last is None else last + 1
        df.write.mode("overwrite").parquet(self.folder(version))
        stamp = at or datetime.now(timezone.utc)
        (
            self.spark.createDataFrame(
                [(version, stamp, self.folder(version))],
                "version long, committed_at timestamp, folder string",
            )
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{self.path}/commits")
        )
        return version

    def merge(self, updates: DataFrame, key: str, update_columns: tuple[str, ...],
              version: str | None = "updated_at") -> int:
        """Keyed upsert as a new version of the whole table: all or nothing, at the cost of a full
        rewrite."""
        stored = self.read()
        if stored is None:
            return self.commit(updates)
        return self.commit(merge_upsert(stored, updates, key, update_columns, version=version))
