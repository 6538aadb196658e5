"""Change-log parsing, current state, streaming mirror."""

from __future__ import annotations

from pyspark.sql import functions as F

from brookmark.operators import star
from brookmark.operators.reconcile import reconcile, replica_lag
from brookmark.operators.quality import replica_checks
from brookmark.sources import fixture
from brookmark.sources.changelog import read_cdc_files
from brookmark.sources.files import list_files
from brookmark.specs import CATALOG
from brookmark.streaming.cdc import current, merge_latest, parse_cdc, tombstones
from brookmark.streaming.mirror import Mirror, run_mirror
from brookmark.workload.keyed import work_folder
from brookmark.workload.shapes import with_stages

ACTIVITY = fixture.ACTIVITY


def _versions(spark, d):
    return parse_cdc(fixture.activity_log(spark, d), ACTIVITY)


def _orders_current(spark, d):
    spec = CATALOG["orders"]
    return current(parse_cdc(fixture.orders_log(spark, d), spec, nulls="keep"), spec)


def stream_current(spark, d):
    """The whole log as message files, worked off by the stream, then the current view."""
    root = work_folder(spark)
    fixture.activity_log(spark, d).select("value").write.text(f"{root}/messages")
    # a handful of micro-batches, however many files the log has
    files = list_files(spark, f"{root}/messages", "*.txt").count()
    stream = read_cdc_files(spark, f"{root}/messages", files_per_trigger=-(-files // 4))
    query = run_mirror(stream, ACTIVITY, f"{root}/mirror", f"{root}/checkpoint", once=True)
    query.awaitTermination()
    return Mirror(spark, f"{root}/mirror", ACTIVITY).current()


def compacted_current(spark, d):
    """Three batches appended and compacted on the way; late and repeated ones included."""
    root = work_folder(spark)
    mirror = Mirror(spark, f"{root}/mirror", ACTIVITY, width=100)
    versions = _versions(spark, d)
    middle = F.lit(1_705_276_800_000)
    early, late = versions.where(F.col("ver") < middle), versions.where(F.col("ver") >= middle)
    mirror.append(late, 0)
    mirror.compact()
    mirror.append(early, 1)
    mirror.append(late, 2)
    mirror.append(late, 2)
    mirror.compact(upto=1)
    return mirror.current()


def merged_state(spark, d):
    """Live and deleted users after folding the second half of the log into the first."""
    versions = _versions(spark, d)
    middle = F.lit(1_705_276_800_000)
    state = merge_latest(
        versions.where(F.col("ver") >= middle), versions.where(F.col("ver") < middle), ACTIVITY
    )
    return state.select("user_id", "ver", "is_deleted")


def reconcile_replica(spark, d):
    """Source orders against their mirror: cancelled ones are deleted there, by design."""
    return reconcile(
        fixture.orders(spark, d), _orders_current(spark, d), "order_id",
        ["customer_id", "order_date", "total_amount", "status", "created_at", "updated_at"],
    )


def mirror_checks(spark, d):
    source = fixture.orders(spark, d)
    gone = source.where(F.col("status") == "cancelled")
    kept = source.where(star.not_cancelled())
    return replica_checks(kept, _orders_current(spark, d), "order_id", gone, kept)


QUERIES = {
    "cdc_parse": lambda spark, d: _versions(spark, d),
    "cdc_parse_keep_nulls": lambda spark, d: parse_cdc(
        fixture.activity_log(spark, d), ACTIVITY, nulls="keep"
    ),
    "cdc_current": lambda spark, d: current(_versions(spark, d), ACTIVITY),
    "cdc_tombstones": lambda spark, d: tombstones(_versions(spark, d), ACTIVITY),
    "cdc_merge_latest": merged_state,
    "cdc_stream_current": stream_current,
    "cdc_compacted_current": compacted_current,
    "orders_mirror_current": _orders_current,
    "mirror_status_counts": lambda spark, d: star.status_counts(_orders_current(spark, d)),
    "mirror_lag": lambda spark, d: replica_lag(
        {"orders": fixture.orders(spark, d)}, {"orders": _orders_current(spark, d)}
    ),
    "reconcile_replica": reconcile_replica,
    "mirror_checks": mirror_checks,
}

_CURRENT = """
    select user_id, event_id, event_type, cast(value as decimal(18,2)) as value, cast(ts as date) as seen_on,
           cast(ts as timestamp) as seen_at
    from activity_latest where event_type <> 'error'"""

ORACLE = {
    "cdc_parse": """
        select user_id, case when event_type = 'error' then 0 else event_id end as event_id,
               case when event_type = 'error' then '' else event_type end as event_type,
               cast(case when event_type = 'error' then 0 else value end as decimal(18,2)) as value,
               case when event_type = 'error' then date '1970-01-01' else cast(ts as date) end as seen_on,
               case when event_type = 'error' then timestamp '1970-01-01 00:00:00' else ts end as seen_at,
               epoch_us(ts) // 1000 as ver, event_type = 'error' as is_deleted, event_id as seq
        from events""",
    "cdc_parse_keep_nulls": """
        select user_id, case when event_type <> 'error' then event_id end as event_id,
               case when event_type <> 'error' then event_type end as event_type,
               cast(case when event_type <> 'error' then value end as decimal(18,2)) as value,
               case when event_type <> 'error' then cast(ts as date) end as seen_on,
               case when event_type <> 'error' then ts end as seen_at,
               epoch_us(ts) // 1000 as ver, event_type = 'error' as is_deleted, event_id as seq
        from events""",
    "cdc_current": with_stages(_CURRENT),
    "cdc_tombstones": with_stages(
        "select user_id, epoch_us(ts) // 1000 as ver from activity_latest where event_type = 'error'"
    ),
    "cdc_merge_latest": with_stages(
        "select user_id, epoch_us(ts) // 1000 as ver, event_type = 'error' as is_deleted from activity_latest"
    ),
    "cdc_stream_current": with_stages(_CURRENT),
    "cdc_compacted_current": with_stages(_CURRENT),
    "orders_mirror_current": with_stages(
        "select * from raw_orders where status is null or status <> 'cancelled'"
    ),
    "mirror_status_counts": with_stages("""
        select status, count(*) as order_count from raw_orders
        where status is null or status <> 'cancelled' group by 1"""),
    "mirror_lag": with_stages("""
        select 'orders' as table_name, count(*) as source_rows,
               count(*) - count(case when status = 'cancelled' then 1 end) as replica_rows,
               count(case when status = 'cancelled' then 1 end) as lag_rows from raw_orders"""),
    "reconcile_replica": with_stages("""
        select count(*) as source_rows,
               count(case when status is null or status <> 'cancelled' then 1 end) as replica_rows,
               count(case when status is null or status <> 'cancelled' then 1 end) as matching_rows,
               count(case when status = 'cancelled' then 1 end) as missing_rows,
               cast(0 as bigint) as extra_rows, cast(0 as bigint) as differing_rows from raw_orders"""),
    "mirror_checks": with_stages("""
        select 'row_count' as check_name, count(*) as failures,
               case when count(*) = 0 then 'PASS' else 'FAIL' end as status from raw_orders where status is null
        union all select 'not_empty', 0, 'PASS' from (select count(*) from raw_orders) x
        union all select 'deletes_applied', 0, 'PASS' from (select count(*) from raw_orders) x
        union all select 'statuses_applied', 0, 'PASS' from (select count(*) from raw_orders) x"""),
}
