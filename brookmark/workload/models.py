"""Cleaning models, star schema, views and the reports over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from brookmark.functions import scalars as S
from brookmark.operators import clean, star
from brookmark.operators.reconcile import select_keys
from brookmark.plans.warehouse import build_models
from brookmark.sources import fixture
from brookmark.workload.shapes import AS_OF, with_stages

def _model(name):
    return lambda spark, d: build_models(fixture.operational(spark, d), F.lit(AS_OF).cast("timestamp"))[name]


def star_revenue(spark, d):
    models = build_models(fixture.operational(spark, d))
    return star.star_revenue(
        models["gold.fact_order_items"], models["gold.dim_date"], models["gold.dim_product"]
    )


def _silver(name):
    return lambda spark, d: clean.SILVER_MODELS[name](fixture.READERS[name](spark, d)).drop("processed_at")


def _clean_orders(spark, d):
    return clean.orders_clean(fixture.orders(spark, d))


def shipped_order_lines(spark, d):
    """Lines of shipped orders by a key set (too large for a literal list, so a semi join)."""
    shipped = _clean_orders(spark, d).where(F.col("status") == "shipped")
    return select_keys(fixture.order_items(spark, d), "order_id", shipped)


def scalar_functions(spark, d):
    """Every scalar function of the models on every order."""
    o = fixture.orders(spark, d)
    ts, day, amount = F.col("order_date"), F.to_date("order_date"), F.col("total_amount")
    status = F.col("status")
    return o.select(
        "order_id",
        S.tidy(F.concat(F.lit("  "), status, F.lit(" "))).alias("trimmed"),
        S.tidy_lower(F.concat(F.lit(" "), F.upper(status))).alias("lowered"),
        S.join_text(status, " ", F.col("order_id").cast("string")).alias("joined"),
        clean.quality_flag().alias("flag"),
        status.isNull().alias("no_status"),
        S.money(amount).alias("amount"),
        day.alias("day"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("dom"),
        S.iso_weekday(day).alias("isodow"),
        S.month_name(day).alias("month_name"),
        S.day_name(day).alias("day_name"),
        S.month_start(day).alias("month_start"),
        S.seconds_between(F.col("updated_at"), F.col("created_at")).alias("age_seconds"),
        (F.lit(3) * amount).cast("decimal(29,2)").alias("tripled"),
        F.abs(amount).alias("magnitude"),
        F.coalesce(status, F.lit("unknown")).alias("known_status"),
        F.length(status).cast("long").alias("status_length"),
        status.isin("shipped", "delivered").alias("sent"),
        status.like("%ed").alias("past"),
        S.month_bucket(ts).alias("month_bucket"),
        S.day_path(ts).alias("day_path"),
        S.day_from_parts(
            F.year(day).cast("string"), F.month(day).cast("string"), F.dayofmonth(day).cast("string")
        ).alias("from_parts"),
        F.regexp_replace(status, "[aeiou]", "").alias("consonants"),
        S.render(status).alias("rendered"),
        F.round(amount, 0).cast("decimal(18,0)").alias("rounded"),
        (ts - F.expr("interval 7 days")).alias("week_before"),
        S.epoch_micros_to_timestamp(F.unix_micros(ts)).alias("from_micros"),
        S.epoch_days_to_date(F.unix_date(day)).alias("from_days"),
        F.get_json_object(F.to_json(F.struct(F.struct("status").alias("after"))), "$.after.status").alias(
            "json_text"
        ),
        F.from_json(F.to_json(F.struct(F.col("order_id"), "total_amount")), "order_id long, total_amount decimal(18,2)")
        .getField("total_amount")
        .alias("json_money"),
        S.readable_size(F.coalesce(amount, F.lit(0)).cast("double") * 1024).alias("size_text"),
    )


QUERIES = {
    "star_revenue": star_revenue,
    "fact_order_items": _model("gold.fact_order_items"),
    "dim_date": _model("gold.dim_date"),
    "dim_customer": _model("gold.dim_customer"),
    "dim_product": _model("gold.dim_product"),
    "v_orders": _model("prs.v_orders"),
    "v_customers": _model("prs.v_customers"),
    "v_products": _model("prs.v_products"),
    "daily_revenue": _model("prs.v_daily_revenue"),
    "customers_clean": _model("int.customers_clean"),
    "products_clean": _model("int.products_clean"),
    "orders_clean": _model("int.orders_clean"),
    "order_items_clean": _model("int.order_items_clean"),
    "orders_rejects": lambda spark, d: clean.reject_profile(fixture.orders(spark, d)),
    "silver_orders": _silver("orders"),
    "silver_customers": _silver("customers"),
    "silver_products": _silver("products"),
    "silver_order_items": _silver("order_items"),
    "order_totals": lambda spark, d: star.accepted_order_totals(
        clean.order_items_clean(fixture.order_items(spark, d)), _clean_orders(spark, d)
    ),
    "status_rollup": lambda spark, d: star.status_rollup(
        clean.silver_orders(fixture.orders(spark, d))
    ),
    "status_counts": lambda spark, d: star.status_counts(fixture.orders(spark, d)),
    "table_counts": lambda spark, d: star.table_counts(fixture.operational(spark, d)),
    "order_date_bounds": lambda spark, d: star.order_date_bounds(_clean_orders(spark, d)),
    "latest_orders": lambda spark, d: star.latest_orders(
        clean.silver_orders(fixture.orders(spark, d))
    ),
    "latest_daily_31": lambda spark, d: star.newest_days(
        star.daily_net_revenue(fixture.orders(spark, d))
    ),
    "open_orders_sample": lambda spark, d: star.sample_rows(
        star.open_orders(fixture.orders(spark, d)), "order_id", 3, seed=42
    ),
    "random_open_order": lambda spark, d: star.random_row(
        fixture.orders(spark, d), star.not_cancelled(), "order_id", seed=7
    ),
    "shipped_order_lines": shipped_order_lines,
    "scalar_functions": scalar_functions,
}

_BYTES = "(cast(coalesce(total_amount, 0) as double) * 1024)"
_UNITS = [("PiB", 5), ("TiB", 4), ("GiB", 3), ("MiB", 2), ("KiB", 1)]
_SIZE = (
    "case "
    + " ".join(
        f"when {_BYTES} >= {1024**n} then format('{{:,.2f}} {unit}', {_BYTES} / {1024**n})"
        for unit, n in _UNITS
    )
    + f" else format('{{:,.2f}} B', {_BYTES}) end"
)

ORACLE = {
    "star_revenue": with_stages("""
        select d.calendar_year, d.month_name, p.category, cast(sum(f.line_amount) as decimal(38,2)) as revenue
        from fact f join dim_date d on f.order_date_day = d.date_day
                    join dim_product p on f.product_id = p.product_id
        where f.order_status <> 'cancelled' group by 1, 2, 3"""),
    "fact_order_items": with_stages("select * from fact"),
    "dim_date": with_stages("select * from dim_date"),
    "dim_customer": with_stages("select * from dim_customer"),
    "dim_product": with_stages("select * from dim_product"),
    "v_orders": with_stages("select * from v_orders"),
    "v_customers": with_stages(
        f"select *, timestamp '{AS_OF}' as dbt_updated_at from customers_clean"
    ),
    "v_products": with_stages(
        f"select *, timestamp '{AS_OF}' as dbt_updated_at from products_clean"
    ),
    "daily_revenue": with_stages("select * from daily_revenue"),
    "customers_clean": with_stages("select * from customers_clean"),
    "products_clean": with_stages("select * from products_clean"),
    "orders_clean": with_stages("select * from orders_clean"),
    "order_items_clean": with_stages("select * from items_clean"),
    "orders_rejects": with_stages(
        "select quality_flag, count(*) as order_count from orders_flagged group by 1"
    ),
    "silver_orders": with_stages("""
        select * from raw_orders where order_id is not null and customer_id is not null
        and total_amount > 0 and status is not null"""),
    "silver_customers": with_stages("""
        select customer_id, trim(first_name) as first_name, trim(last_name) as last_name,
               lower(trim(email)) as email, address, city, state, zip_code, created_at, updated_at
        from raw_customers"""),
    "silver_products": with_stages("""
        select product_id, trim(name) as name, description, price, lower(trim(category)) as category,
               stock_quantity, created_at, updated_at from raw_products"""),
    "silver_order_items": with_stages("select * from raw_items"),
    "order_totals": with_stages("""
        select order_id, cast(sum(line_amount) as decimal(38,2)) as order_total from fact group by 1"""),
    "status_rollup": with_stages("""
        select status, count(*) as order_count, cast(sum(total_amount) as decimal(28,2)) as total_amount
        from raw_orders where order_id is not null and customer_id is not null
        and total_amount > 0 and status is not null group by 1"""),
    "status_counts": with_stages("select status, count(*) as order_count from raw_orders group by 1"),
    "table_counts": with_stages("""
        select 'customers' as table_name, count(*) as row_count, cast(null as decimal(28,2)) as total_amount
        from raw_customers
        union all select 'products', count(*), null from raw_products
        union all select 'orders', count(*), cast(coalesce(sum(total_amount), 0) as decimal(28,2)) from raw_orders
        union all select 'order_items', count(*), null from raw_items"""),
    "order_date_bounds": with_stages("""
        select cast(min(order_date) as date) as first_day, cast(max(order_date) as date) as last_day
        from orders_clean"""),
    "latest_orders": with_stages("""
        select order_id, customer_id, status, total_amount, updated_at from raw_orders
        where customer_id is not null and total_amount > 0 and status is not null
        order by updated_at desc, order_id desc limit 5"""),
    "latest_daily_31": with_stages("select day, revenue from net_daily order by day desc limit 31"),
    "open_orders_sample": with_stages("""
        select * from (select * from raw_orders where status <> 'cancelled' order by order_id desc limit 200) o
        order by md5('42:' || cast(order_id as varchar)), order_id limit 3"""),
    "random_open_order": with_stages("""
        select * from raw_orders where status <> 'cancelled'
        order by md5('7:' || cast(order_id as varchar)), order_id limit 1"""),
    "shipped_order_lines": with_stages("""
        select * from raw_items where order_id in (select order_id from orders_clean where status = 'shipped')"""),
    "scalar_functions": with_stages(f"""
        select order_id, trim('  ' || status || ' ') as trimmed, lower(trim(' ' || upper(status))) as lowered,
               status || ' ' || cast(order_id as varchar) as joined,
               case when total_amount <= 0 then 'invalid_amount' when status is null then 'missing_status'
                    when order_date is null then 'missing_date' else 'valid' end as flag,
               status is null as no_status, total_amount as amount, cast(order_date as date) as day,
               cast(year(order_date) as int) as year, cast(quarter(order_date) as int) as quarter,
               cast(month(order_date) as int) as month, cast(day(order_date) as int) as dom,
               cast(isodow(order_date) as int) as isodow, monthname(order_date) as month_name,
               dayname(order_date) as day_name, cast(date_trunc('month', order_date) as date) as month_start,
               cast(epoch(updated_at) - epoch(created_at) as double) as age_seconds,
               cast(3 * total_amount as decimal(29,2)) as tripled, abs(total_amount) as magnitude,
               coalesce(status, 'unknown') as known_status, cast(length(status) as bigint) as status_length,
               status in ('shipped', 'delivered') as sent, status like '%ed' as past,
               cast(strftime(order_date, '%Y%m') as int) as month_bucket,
               strftime(order_date, '%Y/%m/%d') as day_path, cast(order_date as date) as from_parts,
               regexp_replace(status, '[aeiou]', '', 'g') as consonants, coalesce(status, '') as rendered,
               cast(round(total_amount, 0) as decimal(18,0)) as rounded,
               order_date - interval '7' day as week_before, order_date as from_micros,
               cast(order_date as date) as from_days, status as json_text, total_amount as json_money,
               {_SIZE} as size_text
        from raw_orders"""),
}
