"""Maintenance runs: retention and expiry every time, rewriting only when asked."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmark.operators.maintenance import (
    TARGET_BYTES,
    compact,
    expire_versions,
    ingest_folder,
    orphan_files,
    prune_partitions,
)
from brookmark.plans.lakehouse import silver_table
from brookmark.sources.bronze import bronze_root
from brookmark.sources.files import delete_listed, list_files
from brookmark.sources.tables import SnapshotTable
from brookmark.specs import CATALOG, CLUSTER_COLUMNS, TableSpec
from brookmark.streaming.mirror import Mirror

RETENTION_DAYS = 7
KEEP_VERSIONS = 5


def stale_bronze(spark: SparkSession, root: str, spec: TableSpec, now: datetime,
                 days: int = RETENTION_DAYS) -> DataFrame:
    """Landed files past their retention, from the folder they lie in."""
    return prune_partitions(
        list_files(spark, bronze_root(root, spec)), now, days, day_of=ingest_folder
    )


def expired_snapshots(table: SnapshotTable, now: datetime, days: int = RETENTION_DAYS,
                      keep: int = KEEP_VERSIONS) -> DataFrame:
    """Committed versions that may go, with their folders."""
    commits = table.commits().withColumn("table_name", F.lit(table.path))
    return expire_versions(commits, now, days, keep).select("version", "committed_at", "folder")


def orphaned_snapshot_files(table: SnapshotTable, now: datetime, min_age_days: int = 3) -> DataFrame:
    """Files under version folders that were never committed."""
    files = list_files(table.spark, f"{table.path}/versions").withColumn(
        "v", F.regexp_extract("path", "/v=([0-9]+)/", 1)
    )
    committed = table.commits().select(F.col("version").cast("string").alias("v"))
    referenced = files.join(committed, "v", "left_semi").select("path")
    return orphan_files(files.drop("v"), referenced, now, min_age_days)


def run_maintenance(spark: SparkSession, root: str, now: datetime, rewrite: bool = False,
                    days: int = RETENTION_DAYS, target_bytes: int = TARGET_BYTES,
                    snapshots: Sequence[SnapshotTable] = (), mirrors: Sequence[Mirror] = ()) -> dict[str, int]:
    """Delete landed files past retention; with ``rewrite`` also compact the silver tables.

    Of ``snapshots`` old versions and orphaned files go as well, of ``mirrors`` the log folders their
    base holds; each adds its counts. Tables that do not exist yet are passed over. Returns how many
    files and folders went and folders were rewritten.
    """
    done = {"bronze_files_deleted": 0, "silver_folders_rewritten": 0}
    for spec in CATALOG.values():
        try:
            stale = stale_bronze(spark, f"{root}/bronze", spec, now, days)
            done["bronze_files_deleted"] += delete_listed(spark, stale)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        table = silver_table(spark, root, spec)
        if rewrite and table.read_or_none() is not None:
            done["silver_folders_rewritten"] += compact(
                spark, table.path, target_bytes, order_by=CLUSTER_COLUMNS[spec.name]
            )
    if snapshots:
        written = [t for t in snapshots if t.current() is not None]
        done["versions_expired"] = sum(delete_listed(spark, expired_snapshots(t, now, days), "folder") for t in written)
        done["orphan_files_deleted"] = sum(delete_listed(spark, orphaned_snapshot_files(t, now)) for t in written)
    if mirrors:
        done["log_folders_retired"] = sum(delete_listed(spark, m.compacted_batches()) for m in mirrors)
    return done
