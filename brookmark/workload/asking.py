"""Bounded ad-hoc queries and the column catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from brookmark.operators.catalog import frame_catalog, ordered_text, schema_overview
from brookmark.operators.star import table_counts
from brookmark.plans.adhoc import safe_sql
from brookmark.plans.warehouse import build_models
from brookmark.sources import fixture
from brookmark.workload.shapes import with_stages

_CANCELLED = """
-- how much of each state's line value is lost to cancellations, by weekday
WITH by_customer_day AS (
  SELECT customer_id, order_date_day, sum(line_amount) AS worth,
         sum(CASE order_status WHEN 'cancelled' THEN line_amount ELSE 0 END) AS lost
  FROM gold_fact_order_items GROUP BY customer_id, order_date_day
)
SELECT c.state, t.day_of_week, t.day_name, CAST(sum(lost) AS DECIMAL(38,2)) AS lost_value,
       round(CAST(sum(lost) AS DOUBLE) / CAST(sum(worth) AS DOUBLE), 6) AS lost_share
FROM by_customer_day b JOIN gold_dim_customer c USING (customer_id) JOIN gold_dim_date t ON t.date_day = b.order_date_day
GROUP BY c.state, t.day_of_week, t.day_name ORDER BY c.state, t.day_of_week;
"""


def adhoc_star(spark, d):
    """A star query as text through the bounded query surface (the row cap is the feature)."""
    models = build_models(fixture.operational(spark, d))
    for name in ("gold.fact_order_items", "gold.dim_date", "gold.dim_customer"):
        models[name].createOrReplaceTempView(name.replace(".", "_"))
    return safe_sql(spark, _CANCELLED)


def column_catalog(spark, d):
    """Columns of every operational table in order, with its number of rows."""
    frames = fixture.operational(spark, d)
    counts = table_counts(frames).select(
        F.concat(F.lit("raw."), "table_name").alias("table_name"), "row_count"
    )
    return schema_overview(frame_catalog(spark, "raw", frames)).join(counts, "table_name")


def brand_types(spark, d):
    kinds = fixture.base(spark, d, "part").select("p_brand", "p_type").distinct()
    return ordered_text(kinds, "p_brand", "p_type", "p_type")


QUERIES = {"adhoc_star": adhoc_star, "column_catalog": column_catalog, "brand_types": brand_types}

ORACLE = {
    "adhoc_star": with_stages("""
        select state, cast(isodow(order_date_day) as int) as day_of_week, dayname(order_date_day) as day_name,
               cast(sum(line_amount) filter (where order_status = 'cancelled') as decimal(38,2)) as lost_value,
               round(cast(sum(line_amount) filter (where order_status = 'cancelled') as double) / cast(sum(line_amount) as double), 6) as lost_share
        from fact join dim_customer on fact.customer_id = dim_customer.customer_id group by all"""),
    "column_catalog": with_stages("""
        select 'raw.customers' as table_name,
               'customer_id bigint, first_name string, last_name string, email string, address string,'
               || ' city string, state string, zip_code string, created_at timestamp, updated_at timestamp'
               as columns, (select count(*) from raw_customers) as row_count
        union all select 'raw.products',
               'product_id bigint, name string, description string, price decimal(18,2), category string,'
               || ' stock_quantity int, created_at timestamp, updated_at timestamp',
               (select count(*) from raw_products)
        union all select 'raw.orders',
               'order_id bigint, customer_id bigint, order_date timestamp, total_amount decimal(18,2),'
               || ' status string, created_at timestamp, updated_at timestamp', (select count(*) from raw_orders)
        union all select 'raw.order_items',
               'item_id bigint, order_id bigint, product_id bigint, quantity int, unit_price decimal(18,2),'
               || ' created_at timestamp, updated_at timestamp', (select count(*) from raw_items)"""),
    "brand_types": """
        select p_brand, string_agg(p_type, ', ' order by p_type) as p_type
        from (select distinct p_brand, p_type from part) t group by 1""",
}
