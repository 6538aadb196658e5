"""Retention, expiry, orphans, compaction, clustering, storage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from brookmark.functions.scalars import day_path
from brookmark.operators import maintenance as K
from brookmark.sources import fixture
from brookmark.workload.keyed import work_folder
from brookmark.workload.shapes import with_stages

_NOW = datetime(1998, 6, 15, 12)
_LATE = datetime(2001, 7, 30, 12)


def landed_keys(spark, d):
    """One landed object per order; urgent ones are undated and high ones have a month 13."""
    o = fixture.base(spark, d, "orders")
    file = F.concat(F.lit("/part-"), F.col("o_orderkey").cast("string"), F.lit("-00000.parquet"))
    folder = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("incoming"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy/'13'/dd"))
        .otherwise(day_path(F.col("o_orderdate")))
    )
    return o.select(F.concat(F.lit("orders_source/"), folder, file).alias("path"))


def versions(spark, d):
    return fixture.base(spark, d, "orders").select(
        F.col("o_orderpriority").alias("table_name"),
        F.col("o_orderkey").alias("version"),
        F.col("o_orderdate").cast("timestamp").alias("committed_at"),
    )


def _file(key):
    return F.concat(F.lit("data/part-"), F.col(key).cast("string"), F.lit(".parquet")).alias("path")


def orphans(spark, d):
    """Files of orders that no line refers to."""
    stored = fixture.base(spark, d, "orders").select(
        _file("o_orderkey"), F.col("o_orderdate").cast("timestamp").alias("modified_at")
    )
    used = fixture.base(spark, d, "lineitem").select(_file("l_orderkey"))
    return K.orphan_files(stored, used, _LATE)


def compacted(spark, d):
    """Orders written by status in many small files, then compacted; the rows stay the same."""
    path = f"{work_folder(spark)}/orders"
    orders = fixture.orders(spark, d)
    orders.repartition(16, "order_id").write.partitionBy("status").parquet(path)
    K.compact(spark, path)
    return spark.read.parquet(path).select(*orders.columns)


def clustered(spark, d):
    path = f"{work_folder(spark)}/orders"
    K.cluster_by(fixture.orders(spark, d), ["order_date"], 8, ["order_id"]).write.parquet(path)
    return spark.read.parquet(path)


def zordered(spark, d):
    """Orders in Z-order of day and customer; the rows stay the same."""
    path = f"{work_folder(spark)}/orders"
    K.zorder_by(fixture.orders(spark, d), ["order_date", "customer_id"], 16, ["order_id"]).write.parquet(path)
    return spark.read.parquet(path)


def storage(spark, d):
    reports = [
        K.storage_report(fixture.base(spark, d, "orders"), "orders", F.to_date("o_orderdate")),
        K.storage_report(fixture.base(spark, d, "lineitem"), "lineitem", F.to_date("l_shipdate")),
        K.storage_report(fixture.base(spark, d, "events"), "events", F.to_date("ts")),
    ]
    report = K.largest_tables(reports)
    return report.withColumn("has_bytes", F.col("total_bytes") > 0).drop("total_bytes")


QUERIES = {
    "prune_partitions": lambda spark, d: K.prune_partitions(landed_keys(spark, d), _NOW),
    "expire_versions": lambda spark, d: K.expire_versions(versions(spark, d), _LATE),
    "orphan_files": orphans,
    "compact_table": compacted,
    "cluster_table": clustered,
    "zorder_table": zordered,
    "storage_report": storage,
}

ORACLE = {
    "prune_partitions": """
        select 'orders_source/' || strftime(o_orderdate, '%Y/%m/%d') || '/part-' || cast(o_orderkey as varchar)
               || '-00000.parquet' as path, cast(o_orderdate as date) as partition_day
        from orders where o_orderpriority not in ('1-URGENT', '2-HIGH')
        and cast(cast(o_orderdate as date) as timestamp) < timestamp '1998-06-08 12:00:00'""",
    "expire_versions": """
        select table_name, version, committed_at from (
            select o_orderpriority as table_name, o_orderkey as version, cast(o_orderdate as timestamp) as committed_at,
                   row_number() over (partition by o_orderpriority order by o_orderdate desc, o_orderkey desc) as rn
            from orders) v
        where rn > 5 and committed_at < timestamp '2001-07-23 12:00:00'""",
    "orphan_files": """
        select 'data/part-' || cast(o_orderkey as varchar) || '.parquet' as path,
               cast(o_orderdate as timestamp) as modified_at
        from orders where o_orderkey not in (select l_orderkey from lineitem)
        and o_orderdate < timestamp '2001-07-27 12:00:00'""",
    "compact_table": with_stages("select * from raw_orders"),
    "cluster_table": with_stages("select * from raw_orders"),
    "zorder_table": with_stages("select * from raw_orders"),
    "storage_report": """
        select 'orders' as table_name, count(*) as row_count, cast(1 as bigint) as file_count,
               cast(min(o_orderdate) as date) as oldest, cast(max(o_orderdate) as date) as newest, true as has_bytes
        from orders
        union all select 'lineitem', count(*), 1, cast(min(l_shipdate) as date), cast(max(l_shipdate) as date), true
        from lineitem
        union all select 'events', count(*), 1, cast(min(ts) as date), cast(max(ts) as date), true from events""",
}
