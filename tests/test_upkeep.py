from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from brookmark.__main__ import _parser, main
from brookmark.plans.lakehouse import silver_table, transform_day
from brookmark.plans.upkeep import expired_snapshots, orphaned_snapshot_files, run_maintenance, stale_bronze
from brookmark.sources.bronze import read_bronze_history, write_bronze
from brookmark.sources.files import delete_listed, list_files
from brookmark.sources.tables import SnapshotTable
from brookmark.specs import CATALOG
from brookmark.streaming.mirror import Mirror

SPEC = CATALOG["orders"]
NOW = datetime(2024, 3, 10, 9)


def batch(spark, *keys, at=NOW):
    rows = [(k, 1, NOW - timedelta(days=k), Decimal(k + 1), "pending", NOW, at) for k in keys]
    return spark.createDataFrame(rows, SPEC.schema)


def test_retention_and_rewrite(spark, tmp_path):
    root = str(tmp_path)
    for days in (8, 7, 6):
        write_bronze(batch(spark, days), f"{root}/bronze", SPEC, NOW - timedelta(days=days))
    assert stale_bronze(spark, f"{root}/bronze", SPEC, NOW).count() == 2
    assert stale_bronze(spark, f"{root}/bronze", SPEC, NOW, days=0).count() == 0
    for hour in range(3):  # several files in one folder of the silver table
        stamp = NOW + timedelta(hours=hour)
        silver_table(spark, root, SPEC).merge(
            batch(spark, *range(hour, 50), at=stamp).withColumn("processed_at", F.current_timestamp()), ("status", "updated_at")
        )
    table = silver_table(spark, root, SPEC)
    table.read().repartition(4).withColumn("slot", F.lit(0)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("status", "slot").parquet(table.path)
    assert list_files(spark, table.path).count() == 4
    assert run_maintenance(spark, root, NOW) == {"bronze_files_deleted": 2, "silver_folders_rewritten": 0}
    assert read_bronze_history(spark, f"{root}/bronze", SPEC).count() == 1
    done = run_maintenance(spark, root, NOW, rewrite=True)
    assert done == {"bronze_files_deleted": 0, "silver_folders_rewritten": 1}
    assert list_files(spark, table.path).count() == 1
    days = [r.order_date for r in table.read().collect()]
    assert len(days) == 50 and days == sorted(days)  # clustered on the order date
    assert not transform_day(spark, root, SPEC, "20240301")


def test_snapshot_expiry_and_orphans(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    for days in range(20, 12, -1):
        table.commit(spark.range(days), at=NOW - timedelta(days=days))
    gone = expired_snapshots(table, NOW)
    assert sorted(r.version for r in gone.collect()) == [0, 1, 2]
    assert delete_listed(spark, gone, "folder") == 3
    assert table.read().count() == 13
    spark.range(3).write.parquet(table.folder(99))
    later = datetime.now() + timedelta(days=5)
    assert {r.path.split("/v=")[1][:2] for r in orphaned_snapshot_files(table, later).collect()} == {"99"}
    assert orphaned_snapshot_files(table, NOW).count() == 0


def test_the_run_expires_versions_orphans_and_folded_batches(spark, tmp_path):
    table, unwritten = (SnapshotTable(spark, str(tmp_path / n)) for n in ("t", "u"))
    later = datetime.now() + timedelta(days=30)
    for days in range(20, 12, -1):
        table.commit(spark.range(days), at=later - timedelta(days=days))
    spark.range(3).coalesce(1).write.parquet(table.folder(99))
    mirror = Mirror(spark, str(tmp_path / "m"), SPEC)
    mirror.append(batch(spark, 1, 2).withColumns({"ver": F.lit(1).cast("long"), "is_deleted": F.lit(False)}), 0)
    mirror.compact()
    done = run_maintenance(spark, str(tmp_path), later, snapshots=[table, unwritten], mirrors=[mirror])
    assert (done["versions_expired"], done["orphan_files_deleted"], done["log_folders_retired"]) == (3, 1, 1)
    again = run_maintenance(spark, str(tmp_path), later, snapshots=[table, unwritten], mirrors=[mirror])
    assert not any(again.values())
    assert table.read().count() == 13 and mirror.current().count() == 2


def test_command_line():
    args = _parser().parse_args(["transform", "orders", "20240301", "--root", "/data"])
    assert (args.job, args.table, args.day, args.root) == ("transform", "orders", "20240301", "/data")
    assert _parser().parse_args(["maintain", "--root", "/d", "--rewrite"]).rewrite


def test_the_maintain_job_reaches_mirrors_and_snapshots(spark, tmp_path, capsys):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    for days in range(40, 32, -1):
        table.commit(spark.range(days), at=datetime.now() - timedelta(days=days))
    mirror = Mirror(spark, f"{tmp_path}/mirror/orders", SPEC)
    mirror.append(batch(spark, 1, 2).withColumns({"ver": F.lit(1).cast("long"), "is_deleted": F.lit(False)}), 0)
    mirror.compact()
    mirror.append(batch(spark, 3).withColumns({"ver": F.lit(2).cast("long"), "is_deleted": F.lit(False)}), 1)
    main(["maintain", "--root", str(tmp_path), "--snapshots", table.path])
    said = capsys.readouterr().out
    assert "'versions_expired': 3" in said and "'log_folders_retired': 1" in said
    assert table.read().count() == 33 and mirror.current().count() == 3
