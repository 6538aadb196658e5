"""Tables by attribute and month, rejects, loads by ledger and index, merges by bucket, digests, footers, upkeep."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from brookmark.operators.catalog import column_catalog, filter_catalog
from brookmark.operators.digests import reconcile_by_digest
from brookmark.operators.unions import union_all
from brookmark.plans.lakehouse import read_rejects, silver_table, transform_day
from brookmark.plans.layers import mirror_path, publish
from brookmark.plans.upkeep import run_maintenance
from brookmark.plans.warehouse import ingest, raw_table
from brookmark.sources import fixture
from brookmark.sources.bronze import write_bronze
from brookmark.sources.buckets import BucketTable
from brookmark.sources.footers import bounds
from brookmark.sources.tables import SlotTable, SnapshotTable
from brookmark.sources.unique import UniqueIndex
from brookmark.specs import CATALOG
from brookmark.streaming.cdc import parse_cdc
from brookmark.streaming.counts import FollowedCounts
from brookmark.streaming.mirror import MonthMirror
from brookmark.workload import keyed
from brookmark.workload.shapes import MARK, with_stages

ORDERS = CATALOG["orders"]
_DAY_1, _DAY_2 = datetime(2024, 3, 1, 6), datetime(2024, 3, 2, 6)
_COMPARED = ["customer_id", "order_date", "total_amount", "status", "created_at", "updated_at"]


def lake_shipped_orders(spark, d):
    """Shipped orders after a day that moved most orders into that folder; no other folder is opened."""
    root = keyed.work_folder(spark)
    write_bronze(keyed._loaded_orders(spark, d), f"{root}/bronze", ORDERS, _DAY_1)
    write_bronze(keyed.order_updates(spark, d), f"{root}/bronze", ORDERS, _DAY_2)
    for day in ("20240301", "20240302"):
        transform_day(spark, root, ORDERS, day)
    return silver_table(spark, root, ORDERS).read().where(F.col("status") == "shipped").drop("processed_at")


def silver_null_keys(spark, d):
    """Two days whose orders without an amount come without a key: what was landed, rejected and merged, a day."""
    root = keyed.work_folder(spark)
    rows = fixture.orders(spark, d).withColumn("order_id", F.when(F.col("total_amount").isNotNull(), F.col("order_id")))
    early = F.col("updated_at") <= F.lit(datetime.fromisoformat(MARK))
    for part, run in ((rows.where(early), _DAY_1), (rows.where(~early), _DAY_2)):
        write_bronze(part, f"{root}/bronze", ORDERS, run)
        transform_day(spark, root, ORDERS, f"{run:%Y%m%d}")
    transform_day(spark, root, ORDERS, "20240302")  # a rerun keeps the rejects of both days
    rejected = read_rejects(spark, root, ORDERS).groupBy("ingest_date").agg(F.count(F.lit(1)).alias("row_count"))
    merged = silver_table(spark, root, ORDERS).read().agg(F.count(F.lit(1)).alias("row_count"))
    return union_all([
        rejected.select(F.concat(F.lit("rejected "), F.col("ingest_date").cast("string")).alias("what"), "row_count"),
        merged.select(F.lit("merged").alias("what"), "row_count"),
    ])


def _month_mirror(spark, d, root):
    """The life of every order in three batches; deletes come with the key alone, the last ones unfolded."""
    mirror = MonthMirror(spark, mirror_path(root, ORDERS), ORDERS)
    versions = parse_cdc(fixture.orders_log(spark, d), ORDERS, nulls="keep")
    for step in (0, 1, 2):
        mirror.append(versions.where(F.col("seq") == step), step)
        if step == 1:
            mirror.compact()
    return mirror


def mirror_month(spark, d):
    return _month_mirror(spark, d, keyed.work_folder(spark)).month("1998-03")


def mirror_view_after_maintenance(spark, d):
    """``mirror.orders_current`` as published before everything was folded and the log retired."""
    root = keyed.work_folder(spark)
    mirror = _month_mirror(spark, d, root)
    publish(spark, root)
    mirror.compact()
    run_maintenance(spark, root, datetime.now(timezone.utc), mirrors=[mirror])
    return spark.table("mirror.orders_current")


def current_columns(spark, d):
    """Columns of the current view of orders, as the catalog of published layers lists them."""
    root = keyed.work_folder(spark)
    _month_mirror(spark, d, root)
    publish(spark, root)
    return filter_catalog(column_catalog(spark), ["mirror"], "%_current").where(F.col("table_name") == "orders_current")


def mirror_status_followed(spark, d):
    """Live orders per status from the change feed; a batch is repeated and old versions come late."""
    mirror = MonthMirror(spark, f"{keyed.work_folder(spark)}/mirror", ORDERS)
    versions = parse_cdc(fixture.orders_log(spark, d), ORDERS, nulls="keep")
    counts = FollowedCounts(mirror, "status")
    for number, step in enumerate((1, 0, 2, 2)):
        counts.append(versions.where(F.col("seq") == step), min(number, 2))
        if number == 1:
            mirror.compact()
    return counts.counts().select("status", F.col("rows").alias("order_count"))


def warehouse_no_cursor(spark, d):
    """A table without a cursor: two full loads, the second with restated orders."""
    root, spec = keyed.work_folder(spark), replace(ORDERS, cursor_column=None)
    ingest(spark, keyed._loaded_orders(spark, d), root, spec, _DAY_1)
    ingest(spark, keyed.order_updates(spark, d), root, spec, _DAY_2)
    return raw_table(spark, root, spec).read()


def warehouse_overlap(spark, d):
    """Late commits: the second load reaches a year back behind the mark."""
    root = keyed.work_folder(spark)
    ingest(spark, keyed._loaded_orders(spark, d), root, ORDERS, _DAY_1)
    ingest(spark, keyed.order_updates(spark, d), root, ORDERS, _DAY_2, overlap=timedelta(days=365))
    return raw_table(spark, root, ORDERS).read()


def email_index_conflicts(spark, d):
    """Mailboxes that customers of one region would share with stored ones, found by the index."""
    people = fixture.customers(spark, d).withColumn("email", F.lower(F.concat(F.trim("first_name"), F.lit("@"), F.substring("zip_code", 4, 2))))
    path = f"{keyed.work_folder(spark)}/customers"
    table = SlotTable(spark, path, "customer_id")
    arriving = F.col("state") == "ASIA"
    table.write(people.where(~arriving))
    index = UniqueIndex(table, "email")
    index.build()
    return index.conflicts(people.where(arriving))


def merge_bucketed_orders(spark, d):
    name = f"bucketed.orders_{uuid.uuid4().hex[:12]}"
    table = BucketTable(spark, name, f"{keyed.work_folder(spark)}/orders", "order_id", 16)
    table.write(keyed._loaded_orders(spark, d))
    table.merge(keyed.order_updates(spark, d), ORDERS.update_columns, version=None)
    return table.read()


def reconcile_digests(spark, d):
    """A replica without the pending orders of one customer range and with other totals in one key range."""
    orders = fixture.orders(spark, d)
    top = orders.agg(F.max("order_id")).scalar()
    changed = F.when(F.col("order_id") > top - 500, F.col("total_amount") + 1).otherwise(F.col("total_amount"))
    replica = orders.withColumn("total_amount", changed.cast("decimal(18,2)")).where((F.col("order_id") >= 300) | (F.col("status").eqNullSafe("pending") == F.lit(False)))
    return reconcile_by_digest(orders, replica, "order_id", _COMPARED, (1 << 14, 1 << 8))


def footer_bounds(spark, d):
    parts = [
        bounds(spark, f"{d}/{table}.parquet", key).select(
            F.lit(table).alias("table_name"), "row_count", F.col(f"{key}_low").cast("long").alias("low"), F.col(f"{key}_high").cast("long").alias("high")
        )
        for table, key in (("orders", "o_orderkey"), ("lineitem", "l_partkey"), ("events", "event_id"))
    ]
    return union_all(parts)


def maintenance_run(spark, d):
    """Eight versions of the orders of a status, one file never committed: what a run removes and what stays."""
    root, now = keyed.work_folder(spark), datetime.now(timezone.utc)
    table = SnapshotTable(spark, f"{root}/snapshots")
    kept = fixture.orders(spark, d).where("status is not null")
    for days in range(20, 12, -1):
        table.commit(kept.where(F.col("status") == ("shipped" if days > 13 else "pending")), at=now - timedelta(days=days))
    mirror = _month_mirror(spark, d, root)
    mirror.compact()
    done = run_maintenance(spark, root, now, snapshots=[table], mirrors=[mirror])
    removed = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("what"), F.lit(v).cast("long").alias("n")) for k, v in sorted(done.items())
    ])))
    left = table.read().agg(F.lit("current_rows").alias("what"), F.count(F.lit(1)).alias("n"))
    return removed.unionByName(left)


QUERIES = {
    "lake_shipped_orders": lake_shipped_orders,
    "silver_null_keys": silver_null_keys,
    "mirror_month": mirror_month,
    "mirror_view_after_maintenance": mirror_view_after_maintenance,
    "current_columns": current_columns,
    "mirror_status_followed": mirror_status_followed,
    "warehouse_no_cursor": warehouse_no_cursor,
    "warehouse_overlap": warehouse_overlap,
    "email_index_conflicts": email_index_conflicts,
    "merge_bucketed_orders": merge_bucketed_orders,
    "reconcile_digests": reconcile_digests,
    "footer_bounds": footer_bounds,
    "maintenance_run": maintenance_run,
}

_LIVE = "status is null or status <> 'cancelled'"
_MERGED = """
    select coalesce(t.order_id, u.order_id) as order_id, coalesce(t.customer_id, u.customer_id) as customer_id,
           coalesce(t.order_date, u.order_date) as order_date,
           case when u.order_id is not null then u.total_amount else t.total_amount end as total_amount,
           case when u.order_id is not null then u.status else t.status end as status,
           coalesce(t.created_at, u.created_at) as created_at,
           case when u.order_id is not null then u.updated_at else t.updated_at end as updated_at
    from (select * from raw_orders where updated_at <= timestamp '{mark}') t
    full outer join (select * from order_updates {newer}) u on t.order_id = u.order_id"""


def _merged(newer: str = "") -> str:
    return with_stages(_MERGED.format(mark=MARK, newer=newer))


ORACLE = {
    "lake_shipped_orders": f"select * from ({keyed.ORACLE['lakehouse_orders']}) l where status = 'shipped'",
    "silver_null_keys": with_stages(f"""
        select 'rejected ' || case when updated_at <= timestamp '{MARK}' then '2024-03-01' else '2024-03-02' end as what,
               count(*) as row_count
        from raw_orders where total_amount is null group by 1
        union all select 'merged', count(*) from raw_orders
        where total_amount > 0 and status is not null and customer_id is not null"""),
    "mirror_month": with_stages(f"select * from raw_orders where ({_LIVE}) and strftime(created_at, '%Y-%m') = '1998-03'"),
    "mirror_view_after_maintenance": with_stages(f"select * from raw_orders where {_LIVE}"),
    "current_columns": """
        select 'mirror' as layer, 'orders_current' as table_name, column_name, cast(position as int) as position,
               case column_name when 'total_amount' then 'decimal(18,2)' when 'status' then 'string'
                    when 'order_id' then 'bigint' when 'customer_id' then 'bigint' else 'timestamp' end as data_type
        from (select unnest(names) as column_name, unnest(generate_series(1, len(names))) as position
              from (select ['order_id', 'customer_id', 'order_date', 'total_amount', 'status', 'created_at', 'updated_at'] as names) n) c""",
    "mirror_status_followed": with_stages(f"select status, count(*) as order_count from raw_orders where {_LIVE} group by 1"),
    "warehouse_no_cursor": _merged(),
    "warehouse_overlap": _merged(f"""where updated_at > (select max(updated_at) - interval '365' day from raw_orders
                                    where updated_at <= timestamp '{MARK}')"""),
    "email_index_conflicts": with_stages("""
        select email, count(distinct customer_id) as keys
        from (select *, lower(trim(first_name) || '@' || substr(zip_code, 4, 2)) as email from
              (select customer_id, first_name, zip_code, state from raw_customers)) c
        group by 1 having count(distinct customer_id) > 1 and count(case when state = 'ASIA' then 1 end) > 0"""),
    "merge_bucketed_orders": _merged(),
    "reconcile_digests": with_stages("""
        select count(*) as source_rows, count(case when not gone then 1 end) as replica_rows,
               count(case when not gone and not other then 1 end) as matching_rows,
               count(case when gone then 1 end) as missing_rows, cast(0 as bigint) as extra_rows,
               count(case when not gone and other then 1 end) as differing_rows
        from (select order_id < 300 and coalesce(status = 'pending', false) as gone,
                     order_id > (select max(order_id) from raw_orders) - 500 and total_amount is not null as other
              from raw_orders) r"""),
    "footer_bounds": """
        select 'orders' as table_name, count(*) as row_count, cast(min(o_orderkey) as bigint) as low, cast(max(o_orderkey) as bigint) as high from orders
        union all select 'lineitem', count(*), min(l_partkey), max(l_partkey) from lineitem
        union all select 'events', count(*), min(event_id), max(event_id) from events""",
    "maintenance_run": with_stages("""
        select 'bronze_files_deleted' as what, cast(0 as bigint) as n union all select 'silver_folders_rewritten', 0
        union all select 'versions_expired', 3 union all select 'orphan_files_deleted', 0
        union all select 'log_folders_retired', 3
        union all select 'current_rows', count(*) from raw_orders where status = 'pending'"""),
}
