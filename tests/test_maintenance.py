from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brookmark.operators import maintenance as K
from brookmark.sources.files import list_files

NOW = datetime(2024, 3, 10, 9)


def test_retention_counts_from_midnight(spark):
    keys = [f"orders_source/{NOW - timedelta(days=d):%Y/%m/%d}/part-1-0.parquet" for d in (6, 7, 8)]
    odd = ["orders_source/part-1.parquet", "orders_source/2024/13/01/part.parquet", "orders_source/2020/01",
           "orders_source/2020/02/30/p.parquet", "orders_source/x/01/01/p.parquet"]
    listing = spark.createDataFrame([(k,) for k in keys + odd], "path string")
    assert sorted(r.path for r in K.prune_partitions(listing, NOW).collect()) == sorted(keys[1:])
    assert K.prune_partitions(listing, NOW, days=0).count() == 0
    midnight = datetime(2024, 3, 10)
    assert [r.path for r in K.prune_partitions(listing, midnight).collect()] == [keys[2]]


def test_expiry_keeps_the_last_versions(spark):
    rows = [("t", v, NOW - timedelta(hours=20 * (12 - v))) for v in range(1, 13)]
    rows += [("old", v, NOW - timedelta(days=100 - v)) for v in range(1, 8)] + [("few", 1, NOW - timedelta(days=90))]
    listing = spark.createDataFrame(rows, "table_name string, version long, committed_at timestamp")
    gone = sorted((r.table_name, r.version) for r in K.expire_versions(listing, NOW).collect())
    assert gone == [("old", 1), ("old", 2), ("t", 1), ("t", 2), ("t", 3)]


def test_orphans_are_old_and_unreferenced(spark):
    listing = spark.createDataFrame(
        [("a", NOW - timedelta(days=4)), ("b", NOW - timedelta(days=4)), ("c", NOW - timedelta(days=2))],
        "path string, modified_at timestamp",
    )
    used = spark.createDataFrame([("a",)], "path string")
    assert [r.path for r in K.orphan_files(listing, used, NOW).collect()] == ["b"]


def test_compaction_keeps_rows_and_partition_values(spark, tmp_path):
    path = str(tmp_path / "t")
    names = ["007", "a b", "x=y/z", "50%+", None]
    df = spark.range(500).select(
        "id", F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("id") % 5 + 1).cast("int")).alias("kind")
    )
    df.repartition(10, "id").write.partitionBy("kind").parquet(path)
    df.where("kind = 'a b'").coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("kind").parquet(path)
    before = {r.folder: r.files for r in K.folder_sizes(spark, path).collect()}
    assert K.compact(spark, path) == 4  # one folder is already in one file
    after = {r.folder: r.files for r in K.folder_sizes(spark, path).collect()}
    assert set(after.values()) == {1} and after.keys() == before.keys()
    got = sorted((r.id, r.kind) for r in spark.read.schema("id long, kind string").parquet(path).collect())
    assert got == sorted((r.id, r.kind) for r in df.collect())
    assert K.compact(spark, path) == 0


def test_compaction_of_one_big_folder_spreads_it(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "u")
    spark.range(20_000).withColumn("x", F.rand(1)).repartition(20).write.parquet(path)
    with pytest.raises(ValueError):
        K.compact(spark, path)
    size = list_files(spark, path).agg(F.sum("bytes")).first()[0]
    assert K.compact(spark, path, target_bytes=size // 4, out=out) == 1
    assert 2 <= list_files(spark, out).count() <= 5
    assert spark.read.parquet(out).agg(F.sum("id")).first()[0] == sum(range(20_000))


def test_clustering_cuts_a_hot_value(spark):
    df = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("c"))
    sizes = (
        K.cluster_by(df, ["c"], 12, ["id"]).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    )
    assert sizes < 12_000  # the hot value alone has 20,000 rows


def test_storage_report(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("d", F.expr("date_add(date'2024-01-01', cast(id as int))")).repartition(4).write.parquet(path)
    report = K.storage_report(spark.read.parquet(path), "t", F.col("d"))
    row = K.largest_tables([report]).first()
    total = list_files(spark, path).agg(F.sum("bytes")).first()[0]
    assert (row.row_count, row.file_count, row.total_bytes) == (100, 4, total)
    assert str(row.oldest) == "2024-01-01" and str(row.newest) == "2024-04-09"


def _files_with(spark, path, name, value):
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min(name).alias("a"), F.max(name).alias("b"))
    return per_file.where(F.lit(value).between(F.col("a"), F.col("b"))).count()


def test_zorder_skips_files_on_either_column(spark, tmp_path):
    rows = spark.range(20_000).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("x"), F.concat(F.lit("t"), F.lpad(F.pmod(F.hash("id"), F.lit(1000)).cast("string"), 3, "0")).alias("y"),
    )
    rows = rows.withColumn("x", F.when(F.col("id") % 50 != 0, F.col("x")))
    K.cluster_by(rows, ["x", "y"], 16, ["id"]).write.parquet(f"{tmp_path}/sorted")
    K.zorder_by(rows, ["x", "y"], 16, ["id"]).write.parquet(f"{tmp_path}/z")
    assert spark.read.parquet(f"{tmp_path}/z").exceptAll(rows).count() == 0 == rows.exceptAll(spark.read.parquet(f"{tmp_path}/z")).count()
    assert _files_with(spark, f"{tmp_path}/sorted", "y", "t500") >= 14
    assert _files_with(spark, f"{tmp_path}/z", "y", "t500") <= 8 and _files_with(spark, f"{tmp_path}/z", "x", 500) <= 8


def test_zorder_of_hot_and_missing_values(spark):
    hot = spark.range(9000).select("id", F.when(F.col("id") % 3 > 0, F.lit(7.5)).otherwise(F.col("id").cast("double")).alias("x"), F.lit(None).cast("date").alias("y"))
    cut = K.zorder_by(hot, ["x", "y"], 8, ["id"])
    sizes = [r["n"] for r in cut.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 9000 and max(sizes) < 2500  # the hot value is cut by the key
    assert K.zorder_by(hot.limit(0), ["x", "y"], 8, ["id"]).count() == 0
