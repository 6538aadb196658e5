"""SQL building blocks shared by the oracles: the operational tables and models as named stages."""

from __future__ import annotations

import re

AS_OF = "2024-06-01 00:00:00"
NOW = "2024-02-03 12:00:00"
MARK = "1999-01-01 00:00:00"

_STAGES: dict[str, str] = {
    "raw_customers": """
        select c.c_custkey as customer_id, '  ' || c.c_mktsegment || ' ' as first_name,
               c.c_name as last_name, ' ' || c.c_name || '@Example.COM ' as email,
               'addr ' || cast(c.c_custkey as varchar) as address, n.n_name as city, r.r_name as state,
               lpad(cast(c.c_custkey % 100000 as varchar), 5, '0') as zip_code,
               timestamp '2024-01-01 00:00:00' as created_at,
               timestamp '2024-02-01 00:00:00' as updated_at
        from customer c join nation n on c.c_nationkey = n.n_nationkey
                        join region r on n.n_regionkey = r.r_regionkey""",
    "raw_products": """
        select p_partkey as product_id, ' ' || p_name || ' ' as name,
               p_brand || ' ' || p_type as description,
               cast(case when p_partkey % 61 = 0 then -1 else p_retailprice end as decimal(18,2)) as price,
               ' ' || p_type || ' ' as category, cast(p_size * 10 as int) as stock_quantity,
               timestamp '2024-01-01 00:00:00' as created_at,
               timestamp '2024-02-01 00:00:00' as updated_at
        from part""",
    "raw_orders": """
        select o_orderkey as order_id, o_custkey as customer_id, cast(o_orderdate as timestamp) as order_date,
               cast(case when o_orderkey % 97 = 0 then -5 when o_orderkey % 103 = 0 then null
                         else o_totalprice end as decimal(18,2)) as total_amount,
               case when o_orderkey % 101 = 0 then null
                    when o_orderstatus = 'O' then 'pending' when o_orderstatus = 'P' then 'processing'
                    when o_orderkey % 3 = 0 then 'shipped' when o_orderkey % 3 = 1 then 'delivered'
                    else 'cancelled' end as status,
               cast(o_orderdate as timestamp) as created_at,
               cast(o_orderdate as timestamp) + interval '1' day as updated_at
        from orders""",
    "item_versions": """
        select l_orderkey * 10 + l_linenumber as item_id, l_orderkey as order_id, l_partkey as product_id,
               cast(case when l_partkey % 50 = 0 then 0 else l_quantity end as int) as quantity,
               cast(l_extendedprice as decimal(18,2)) as unit_price,
               cast(l_shipdate as timestamp) as created_at, cast(l_shipdate as timestamp) as updated_at,
               l_suppkey as tiebreak
        from lineitem""",
    "raw_items": """
        select item_id, order_id, product_id, quantity, unit_price, created_at, updated_at
        from (select *, row_number() over (partition by item_id order by updated_at desc, product_id desc,
                        tiebreak desc, unit_price desc, quantity desc) as rn from item_versions) v
        where rn = 1""",
    "customers_clean": "select *, first_name || ' ' || last_name as full_name from raw_customers",
    "products_clean": "select * from raw_products where price >= 0",
    "orders_flagged": """
        select *, case when total_amount <= 0 then 'invalid_amount' when status is null then 'missing_status'
                       when order_date is null then 'missing_date' else 'valid' end as quality_flag
        from raw_orders""",
    "orders_clean": """
        select order_id, customer_id, order_date, total_amount, status, created_at, updated_at
        from orders_flagged where quality_flag = 'valid' and order_id is not null and total_amount > 0""",
    "items_clean": "select * from raw_items where quantity > 0 and unit_price >= 0",
    "dim_customer": f"""
        select customer_id, full_name, first_name, last_name, email, city, state, zip_code, created_at,
               updated_at, timestamp '{AS_OF}' as dbt_updated_at from customers_clean""",
    "dim_product": f"""
        select product_id, name as product_name, category, price as list_price, stock_quantity, created_at,
               updated_at, timestamp '{AS_OF}' as dbt_updated_at from products_clean""",
    "spine": """
        select cast(unnest(generate_series(cast(min(order_date) as date), cast(max(order_date) as date),
               interval '1' day)) as date) as date_day from orders_clean""",
    "dim_date": f"""
        select date_day, cast(year(date_day) as int) as calendar_year,
               cast(quarter(date_day) as int) as calendar_quarter,
               cast(month(date_day) as int) as calendar_month, monthname(date_day) as month_name,
               cast(day(date_day) as int) as day_of_month, cast(isodow(date_day) as int) as day_of_week,
               dayname(date_day) as day_name, isodow(date_day) >= 6 as is_weekend,
               cast(date_trunc('month', date_day) as date) as month_start_date,
               timestamp '{AS_OF}' as dbt_updated_at from spine""",
    "fact": f"""
        select i.item_id, i.order_id, o.customer_id, i.product_id, cast(o.order_date as date) as order_date_day,
               o.status as order_status, o.order_date, i.quantity, i.unit_price,
               cast(cast(i.quantity as decimal(10,0)) * i.unit_price as decimal(29,2)) as line_amount,
               timestamp '{AS_OF}' as dbt_updated_at
        from items_clean i join orders_clean o on i.order_id = o.order_id""",
    "v_orders": f"""
        select i.item_id, o.order_id, o.customer_id, i.product_id, o.order_date, i.quantity, i.unit_price,
               o.total_amount as order_total_amount, o.status as order_status, o.created_at as order_created_at,
               o.updated_at as order_updated_at,
               cast(cast(i.quantity as decimal(10,0)) * i.unit_price as decimal(29,2)) as item_total_price,
               timestamp '{AS_OF}' as dbt_updated_at
        from items_clean i join orders_clean o on i.order_id = o.order_id""",
    "daily_revenue": f"""
        select status, cast(order_date as date) as order_date, count(*) as order_count,
               cast(sum(total_amount) as decimal(28,2)) as total_revenue,
               cast(sum(total_amount) as double) / count(*) as avg_order_value,
               min(total_amount) as min_order_value, max(total_amount) as max_order_value,
               timestamp '{AS_OF}' as calculated_at
        from orders_clean group by 1, 2""",
    "net_daily": """
        select cast(order_date as date) as day, cast(sum(total_amount) as decimal(28,2)) as revenue
        from raw_orders where status <> 'cancelled' group by 1""",
    # the restated orders used as a merge batch: what their lines say
    "order_updates": """
        select o.order_id, o.customer_id, o.order_date, s.amount as total_amount, 'shipped' as status,
               o.created_at, s.shipped as updated_at
        from raw_orders o
        join (select order_id, cast(sum(cast(quantity as decimal(10,0)) * unit_price) as decimal(18,2)) as amount,
                     max(updated_at) as shipped from raw_items group by order_id) s
          on o.order_id = s.order_id""",
    # newest change-log message per user
    "activity_latest": """
        select * from (select *, row_number() over (partition by user_id order by epoch_us(ts) // 1000 desc,
                       event_id desc) as rn from events) e where rn = 1""",
}


def with_stages(body: str) -> str:
    """``body`` with every stage it mentions, directly or not, put in front in order."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        text = texts.pop()
        for name, stage in _STAGES.items():
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                needed.add(name)
                texts.append(stage)
    stages = [f"{name} as ({_STAGES[name].strip()})" for name in _STAGES if name in needed]
    return (f"with {', '.join(stages)} " if stages else "") + body.strip()
