"""Extracts, landing area, latest-per-key and keyed merges."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from brookmark.operators import clean
from brookmark.operators.merge import latest_by_key, merge_upsert, unique_violations
from brookmark.plans.lakehouse import silver_table, transform_day
from brookmark.plans.warehouse import ingest, raw_table
from brookmark.session import shared_dir
from brookmark.sources import fixture
from brookmark.sources.bronze import read_bronze_day, read_bronze_history, write_bronze
from brookmark.sources.extract import conform, extract, extract_incremental
from brookmark.specs import CATALOG, SILVER_UPDATE_COLUMNS
from brookmark.workload.shapes import MARK, with_stages

_MARK = datetime.fromisoformat(MARK)


def work_folder(spark) -> str:
    """A new folder under the shared one for what a query writes on its way."""
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def _loaded_orders(spark, d):
    return fixture.orders(spark, d).where(F.col("updated_at") <= F.lit(_MARK))


def order_updates(spark, d):
    """Orders restated from their lines: shipped, with the sum of the lines as total."""
    amount = F.sum(F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")
    sent = (
        fixture.order_items(spark, d)
        .groupBy("order_id")
        .agg(amount.alias("total_amount"), F.max("updated_at").alias("updated_at"))
    )
    kept = fixture.orders(spark, d).select("order_id", "customer_id", "order_date", "created_at")
    return kept.join(sent, "order_id").select(
        "order_id", "customer_id", "order_date", "total_amount", F.lit("shipped").alias("status"),
        "created_at", "updated_at",
    )


def extract_full(spark, d):
    return extract(spark, CATALOG["orders"], lambda s, spec: fixture.orders(s, d))


def extract_new(spark, d):
    return extract_incremental(fixture.orders(spark, d), _loaded_orders(spark, d), CATALOG["orders"])


def merge_raw_orders(spark, d):
    spec = CATALOG["orders"]
    return merge_upsert(_loaded_orders(spark, d), order_updates(spark, d), "order_id", spec.update_columns)


def merge_silver_orders(spark, d):
    target = clean.silver_orders(_loaded_orders(spark, d), F.lit(0))
    updates = clean.silver_orders(order_updates(spark, d), F.lit(1))
    return merge_upsert(
        target, updates, "order_id", SILVER_UPDATE_COLUMNS["orders"], version="updated_at"
    )


def merge_silver_customers(spark, d):
    """Customers of four regions are loaded; the batch holds everyone who ordered, at a new address."""
    people = fixture.customers(spark, d)
    active = (
        fixture.orders(spark, d)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("order_date").alias("last_order"))
    )
    moved = people.join(active, "customer_id").select(
        "customer_id", "first_name", "last_name", "email",
        F.concat(F.lit("moved "), F.col("n").cast("string")).alias("address"),
        "city", "state", "zip_code", F.col("last_order").alias("created_at"),
        (F.col("updated_at") + F.expr("interval 1 day")).alias("updated_at"),
    )
    loaded = people.where(F.col("state") != "ASIA")
    return merge_upsert(
        clean.silver_customers(loaded, F.lit(0)), clean.silver_customers(moved, F.lit(1)),
        "customer_id", SILVER_UPDATE_COLUMNS["customers"], version="updated_at",
    )


def merge_silver_products(spark, d):
    """Accepted products are loaded; the batch holds every product sold, with its stock reduced."""
    goods = fixture.products(spark, d)
    sold = fixture.order_item_versions(spark, d).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("updated_at").alias("last_sale")
    )
    restocked = goods.join(sold, "product_id").select(
        "product_id", "name", "description", "price", "category",
        (F.col("stock_quantity") - F.col("n")).cast("int").alias("stock_quantity"),
        F.col("last_sale").alias("created_at"),
        (F.col("updated_at") + F.expr("interval 1 day")).alias("updated_at"),
    )
    return merge_upsert(
        clean.silver_products(clean.products_clean(goods), F.lit(0)),
        clean.silver_products(restocked, F.lit(1)),
        "product_id", SILVER_UPDATE_COLUMNS["products"], version="updated_at",
    )


def _newest(versions):
    return latest_by_key(versions, "item_id", "updated_at", fixture.ITEM_TIEBREAK)


def _item_halves(spark, d):
    versions = fixture.order_item_versions(spark, d)
    loaded = versions.where(F.col("updated_at") <= F.lit(_MARK))
    fresh = versions.where(F.col("updated_at") > F.lit(_MARK))
    return _newest(loaded), _newest(fresh)


def merge_silver_order_items(spark, d):
    target, updates = _item_halves(spark, d)
    return merge_upsert(
        clean.silver_order_items(target, F.lit(0)), clean.silver_order_items(updates, F.lit(1)),
        "item_id", SILVER_UPDATE_COLUMNS["order_items"], version="updated_at",
    )


def merge_raw_order_items(spark, d):
    spec = CATALOG["order_items"]
    target, updates = _item_halves(spark, d)
    return merge_upsert(
        conform(target, spec), conform(updates, spec), "item_id", spec.update_columns
    )


def stale_merge_ignored(spark, d):
    """The guarded merge with its sides swapped: older rows arrive late and change nothing."""
    older, newer = _item_halves(spark, d)
    return merge_upsert(
        clean.silver_order_items(newer, F.lit(1)), clean.silver_order_items(older, F.lit(0)),
        "item_id", SILVER_UPDATE_COLUMNS["order_items"], version="updated_at",
    )


def email_conflicts(spark, d):
    """Customers who share an e-mail once it is cut to its segment's mailbox."""
    shared = fixture.customers(spark, d).withColumn(
        "email", F.lower(F.concat(F.trim("first_name"), F.lit("@"), F.col("city")))
    )
    return unique_violations(shared, "email", "customer_id")


_RUN_1, _RUN_2 = datetime(2024, 3, 1, 6), datetime(2024, 3, 1, 18)
_RUN_3 = datetime(2024, 3, 2, 6)


def bronze_day(spark, d):
    """Two runs on one day and one on the next; reading the first day gives both of its runs."""
    root, spec = work_folder(spark), CATALOG["orders"]
    rows = fixture.orders(spark, d)
    write_bronze(rows.where(F.col("updated_at") <= F.lit(_MARK)), root, spec, _RUN_1)
    write_bronze(rows.where(F.col("updated_at") > F.lit(_MARK)), root, spec, _RUN_2)
    write_bronze(order_updates(spark, d), root, spec, _RUN_3)
    return read_bronze_day(spark, root, spec, "20240301")


def bronze_history(spark, d):
    root, spec = work_folder(spark), CATALOG["customers"]
    rows = fixture.customers(spark, d)
    for run in (_RUN_1, _RUN_2, _RUN_3, _RUN_3):
        write_bronze(rows, root, spec, run)
    return read_bronze_history(spark, root, spec).groupBy("ingest_date", "run_id").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def lakehouse_orders(spark, d):
    """Two landed days through the silver job: create, merge, and the same merge once more."""
    root, spec = work_folder(spark), CATALOG["orders"]
    write_bronze(_loaded_orders(spark, d), f"{root}/bronze", spec, _RUN_1)
    write_bronze(order_updates(spark, d), f"{root}/bronze", spec, _RUN_3)
    for day in ("20240301", "20240302", "20240302"):
        transform_day(spark, root, spec, day)
    return silver_table(spark, root, spec).read().drop("processed_at")


def warehouse_orders(spark, d):
    """Two incremental loads of the raw layer: the history, then everything past its mark."""
    root, spec = work_folder(spark), CATALOG["orders"]
    ingest(spark, _loaded_orders(spark, d), root, spec, _RUN_1)
    ingest(spark, order_updates(spark, d), root, spec, _RUN_2)
    return raw_table(spark, root, spec).read()


QUERIES = {
    "extract_full": extract_full,
    "extract_incremental": extract_new,
    "latest_by_key": lambda spark, d: _newest(fixture.order_item_versions(spark, d)),
    "merge_raw_orders": merge_raw_orders,
    "merge_raw_order_items": merge_raw_order_items,
    "merge_silver_orders": merge_silver_orders,
    "merge_silver_customers": merge_silver_customers,
    "merge_silver_products": merge_silver_products,
    "merge_silver_order_items": merge_silver_order_items,
    "stale_merge_ignored": stale_merge_ignored,
    "email_conflicts": email_conflicts,
    "bronze_day": bronze_day,
    "bronze_history": bronze_history,
    "lakehouse_orders": lakehouse_orders,
    "warehouse_orders": warehouse_orders,
}


def _half(sign: str) -> str:
    return f"""(select * from (select *, row_number() over (partition by item_id order by updated_at desc,
        product_id desc, tiebreak desc, unit_price desc, quantity desc) as rn
        from item_versions where updated_at {sign} timestamp '{MARK}') x where rn = 1)"""


_SILVER_RULE = "total_amount > 0 and status is not null and customer_id is not null"

ORACLE = {
    "extract_full": with_stages("select * from raw_orders"),
    "extract_incremental": with_stages(f"""
        select * from raw_orders where updated_at >
        (select max(updated_at) from raw_orders where updated_at <= timestamp '{MARK}')"""),
    "latest_by_key": with_stages("""
        select item_id, order_id, product_id, quantity, unit_price, created_at, updated_at, tiebreak
        from (select *, row_number() over (partition by item_id order by updated_at desc, product_id desc,
              tiebreak desc, unit_price desc, quantity desc) as rn from item_versions) v where rn = 1"""),
    "merge_raw_orders": with_stages(f"""
        select coalesce(t.order_id, u.order_id) as order_id, coalesce(t.customer_id, u.customer_id) as customer_id,
               coalesce(t.order_date, u.order_date) as order_date,
               case when u.order_id is not null then u.total_amount else t.total_amount end as total_amount,
               case when u.order_id is not null then u.status else t.status end as status,
               coalesce(t.created_at, u.created_at) as created_at,
               case when u.order_id is not null then u.updated_at else t.updated_at end as updated_at
        from (select * from raw_orders where updated_at <= timestamp '{MARK}') t
        full outer join (select * from order_updates) u on t.order_id = u.order_id"""),
    "merge_raw_order_items": with_stages(f"""
        select coalesce(t.item_id, u.item_id) as item_id,
               case when t.item_id is null then u.order_id else t.order_id end as order_id,
               case when t.item_id is null then u.product_id else t.product_id end as product_id,
               coalesce(u.quantity, t.quantity) as quantity, coalesce(u.unit_price, t.unit_price) as unit_price,
               case when t.item_id is null then u.created_at else t.created_at end as created_at,
               coalesce(u.updated_at, t.updated_at) as updated_at
        from {_half("<=")} t full outer join {_half(">")} u on t.item_id = u.item_id"""),
    "merge_silver_orders": with_stages(f"""
        select coalesce(t.order_id, u.order_id) as order_id, coalesce(t.customer_id, u.customer_id) as customer_id,
               coalesce(t.order_date, u.order_date) as order_date,
               case when w then u.total_amount else t.total_amount end as total_amount,
               case when w then u.status else t.status end as status,
               coalesce(t.created_at, u.created_at) as created_at,
               case when w then u.updated_at else t.updated_at end as updated_at,
               case when w then 1 else 0 end as processed_at
        from (select t, u, t.order_id is null or (u.order_id is not null and u.updated_at >= t.updated_at) as w
              from (select * from raw_orders where updated_at <= timestamp '{MARK}' and {_SILVER_RULE}) t
              full outer join (select * from order_updates where {_SILVER_RULE}) u on t.order_id = u.order_id) m"""),
    "merge_silver_customers": with_stages("""
        select customer_id, first_name, last_name, email, coalesce(moved, address) as address, city, state,
               zip_code, case when state = 'ASIA' then last_order else created_at end as created_at,
               case when moved is null then updated_at else updated_at + interval '1' day end as updated_at,
               case when moved is null then 0 else 1 end as processed_at
        from (select c.customer_id, trim(c.first_name) as first_name, trim(c.last_name) as last_name,
                     lower(trim(c.email)) as email, c.address, c.city, c.state, c.zip_code, c.created_at,
                     c.updated_at, 'moved ' || cast(a.n as varchar) as moved, a.last_order
              from raw_customers c left join (select customer_id, count(*) as n, max(order_date) as last_order
                                              from raw_orders group by 1) a on c.customer_id = a.customer_id) x
        where state <> 'ASIA' or moved is not null"""),
    "merge_silver_products": with_stages("""
        select product_id, trim(name) as name, description, price, lower(trim(category)) as category,
               cast(stock_quantity - coalesce(n, 0) as int) as stock_quantity,
               case when price >= 0 then created_at else last_sale end as created_at,
               case when n is null then updated_at else updated_at + interval '1' day end as updated_at,
               case when n is null then 0 else 1 end as processed_at
        from (select p.*, s.n, s.last_sale from raw_products p
              left join (select product_id, count(*) as n, max(updated_at) as last_sale
                         from item_versions group by 1) s using (product_id)) x
        where price >= 0 or n is not null"""),
    "merge_silver_order_items": with_stages(f"""
        select coalesce(t.item_id, u.item_id) as item_id, coalesce(u.order_id, t.order_id) as order_id,
               coalesce(u.product_id, t.product_id) as product_id, coalesce(u.quantity, t.quantity) as quantity,
               coalesce(u.unit_price, t.unit_price) as unit_price,
               coalesce(t.created_at, u.created_at) as created_at,
               coalesce(u.updated_at, t.updated_at) as updated_at,
               case when u.item_id is null then 0 else 1 end as processed_at
        from {_half("<=")} t full outer join {_half(">")} u on t.item_id = u.item_id"""),
    "stale_merge_ignored": with_stages(f"""
        select coalesce(t.item_id, u.item_id) as item_id, coalesce(t.order_id, u.order_id) as order_id,
               coalesce(t.product_id, u.product_id) as product_id, coalesce(t.quantity, u.quantity) as quantity,
               coalesce(t.unit_price, u.unit_price) as unit_price,
               coalesce(t.created_at, u.created_at) as created_at,
               coalesce(t.updated_at, u.updated_at) as updated_at,
               case when t.item_id is null then 0 else 1 end as processed_at
        from {_half(">")} t full outer join {_half("<=")} u on t.item_id = u.item_id"""),
    "email_conflicts": with_stages("""
        select lower(trim(first_name) || '@' || city) as email, count(distinct customer_id) as keys
        from raw_customers group by 1 having count(distinct customer_id) > 1"""),
    "bronze_day": with_stages(f"""
        select *, date '2024-03-01' as ingest_date,
               case when updated_at <= timestamp '{MARK}' then '20240301T060000' else '20240301T180000' end as run_id
        from raw_orders"""),
    "bronze_history": with_stages("""
        select r.ingest_date, r.run_id, count(*) as row_count
        from raw_customers cross join (values (date '2024-03-01', '20240301T060000'),
             (date '2024-03-01', '20240301T180000'), (date '2024-03-02', '20240302T060000')) r(ingest_date, run_id)
        group by 1, 2"""),
    "lakehouse_orders": with_stages(f"""
        select coalesce(t.order_id, u.order_id) as order_id, coalesce(t.customer_id, u.customer_id) as customer_id,
               coalesce(t.order_date, u.order_date) as order_date,
               case when w then u.total_amount else t.total_amount end as total_amount,
               case when w then u.status else t.status end as status,
               coalesce(t.created_at, u.created_at) as created_at,
               case when w then u.updated_at else t.updated_at end as updated_at
        from (select t, u, t.order_id is null or (u.order_id is not null and u.updated_at >= t.updated_at) as w
              from (select * from raw_orders where updated_at <= timestamp '{MARK}' and {_SILVER_RULE}) t
              full outer join (select * from order_updates where {_SILVER_RULE}) u on t.order_id = u.order_id) m"""),
    "warehouse_orders": with_stages(f"""
        select coalesce(t.order_id, u.order_id) as order_id, coalesce(t.customer_id, u.customer_id) as customer_id,
               coalesce(t.order_date, u.order_date) as order_date,
               case when u.order_id is not null then u.total_amount else t.total_amount end as total_amount,
               case when u.order_id is not null then u.status else t.status end as status,
               coalesce(t.created_at, u.created_at) as created_at,
               case when u.order_id is not null then u.updated_at else t.updated_at end as updated_at
        from (select * from raw_orders where updated_at <= timestamp '{MARK}') t
        full outer join (select * from order_updates where updated_at >
             (select max(updated_at) from raw_orders where updated_at <= timestamp '{MARK}')) u
        on t.order_id = u.order_id"""),
}
