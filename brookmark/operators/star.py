"""Star schema, presentation views and the reports over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmark.functions.scalars import (
    day_name,
    days_between,
    iso_weekday,
    month_name,
    month_start,
)
from brookmark.operators.unions import union_all
from brookmark.specs import CATALOG

# Fixed value: name of the load-time column on gold tables and presentation views.
LOADED_AT = "dbt_updated_at"


def _loaded(as_of: Column | None, name: str = LOADED_AT) -> Column:
    return (F.current_timestamp() if as_of is None else as_of).alias(name)


def dim_customer(customers: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Customer dimension over the cleaned customers."""
    return customers.select(
        "customer_id", "full_name", "first_name", "last_name", "email", "city", "state",
        "zip_code", "created_at", "updated_at", _loaded(as_of),
    )


def dim_product(products: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Product dimension over the cleaned products."""
    return products.select(
        "product_id",
        F.col("name").alias("product_name"),
        "category",
        F.col("price").alias("list_price"),
        "stock_quantity",
        "created_at",
        "updated_at",
        _loaded(as_of),
    )


def order_date_bounds(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.to_date(F.min("order_date")).alias("first_day"),
        F.to_date(F.max("order_date")).alias("last_day"),
    )


def dim_date(orders: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per calendar day between the first and last clean order, gaps included."""
    spine = order_date_bounds(orders).select(
        F.explode(days_between(F.col("first_day"), F.col("last_day"))).alias("date_day")
    )
    day = F.col("date_day")
    return spine.select(
        "date_day",
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"),
        F.month(day).alias("calendar_month"),
        month_name(day).alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_weekday(day).alias("day_of_week"),
        day_name(day).alias("day_name"),
        (iso_weekday(day) >= 6).alias("is_weekend"),
        month_start(day).alias("month_start_date"),
        _loaded(as_of),
    )


def _line_amount() -> Column:
    return (F.col("quantity") * F.col("unit_price")).cast("decimal(29,2)")


def fact_order_items(items: DataFrame, orders: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per order line of an accepted order; lines of rejected orders drop out.

    Orders are unique on the join key, so an order with very many lines is split by adaptive
    execution on the lines side only.
    """
    lines = items.select("item_id", "order_id", "product_id", "quantity", "unit_price")
    heads = orders.select("order_id", "customer_id", "order_date", "status")
    return with_line_amount(lines).join(heads, "order_id").select(
        "item_id",
        "order_id",
        "customer_id",
        "product_id",
        F.to_date("order_date").alias("order_date_day"),
        F.col("status").alias("order_status"),
        "order_date",
        "quantity",
        "unit_price",
        "line_amount",
        _loaded(as_of),
    )


def v_orders(items: DataFrame, orders: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Order lines with their order's total, status and timestamps."""
    lines = items.select("item_id", "order_id", "product_id", "quantity", "unit_price")
    heads = orders.select(
        "order_id",
        "customer_id",
        "order_date",
        F.col("total_amount").alias("order_total_amount"),
        F.col("status").alias("order_status"),
        F.col("created_at").alias("order_created_at"),
        F.col("updated_at").alias("order_updated_at"),
    )
    return lines.join(heads, "order_id").select(
        "item_id", "order_id", "customer_id", "product_id", "order_date", "quantity",
        "unit_price", "order_total_amount", "order_status", "order_created_at",
        "order_updated_at", _line_amount().alias("item_total_price"), _loaded(as_of),
    )


def v_customers(customers: DataFrame, as_of: Column | None = None) -> DataFrame:
    return customers.select(
        "customer_id", "first_name", "last_name", "full_name", "email", "address", "city",
        "state", "zip_code", "created_at", "updated_at", _loaded(as_of),
    )


def v_products(products: DataFrame, as_of: Column | None = None) -> DataFrame:
    return products.select(*CATALOG["products"].column_names, _loaded(as_of))


def v_daily_revenue(orders: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Orders per day and status, cancelled ones included; newest day first."""
    total = F.sum("total_amount")
    return (
        orders.groupBy("status", F.to_date("order_date").alias("order_date"))
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            total.cast("decimal(28,2)").alias("total_revenue"),
            (total.cast("double") / F.count("total_amount")).alias("avg_order_value"),
            F.min("total_amount").alias("min_order_value"),
            F.max("total_amount").alias("max_order_value"),
            _loaded(as_of, "calculated_at"),
        )
        .orderBy(F.col("order_date").desc(), F.col("status").asc())
    )


def not_cancelled(status: str = "status") -> Column:
    return F.col(status) != "cancelled"


def star_revenue(fact: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Non-cancelled revenue by year, month name and category, largest first.

    Lines are summed per day and product before the dimensions are joined, so what reaches the
    joins is bounded by days times products, however many lines one product has.
    """
    daily = (
        fact.where(not_cancelled("order_status"))
        .groupBy("order_date_day", "product_id")
        .agg(F.sum("line_amount").alias("amount"))
    )
    calendar = dates.select("date_day", "calendar_year", "month_name")
    catalog = products.select("product_id", "category")
    return (
        daily.join(calendar, daily.order_date_day == calendar.date_day)
        .join(catalog, "product_id")
        .groupBy("calendar_year", "month_name", "category")
        .agg(F.sum("amount").cast("decimal(38,2)").alias("revenue"))
        .orderBy(F.col("revenue").desc())
    )


def order_totals(fact: DataFrame) -> DataFrame:
    """Order totals recovered from their lines."""
    return fact.groupBy("order_id").agg(F.sum("line_amount").cast("decimal(38,2)").alias("order_total"))


def with_line_amount(items: DataFrame) -> DataFrame:
    return items.withColumn("line_amount", _line_amount())


def accepted_order_totals(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The same totals straight from the cleaned items: summed per order before orders are joined.

    An inner join on the unique order key: a semi join would be moved below the sum again.
    """
    return order_totals(with_line_amount(items)).join(orders.select("order_id"), "order_id")


def status_rollup(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_amount").cast("decimal(28,2)").alias("total_amount"),
    )


def status_counts(orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("status").agg(F.count(F.lit(1)).alias("order_count"))
    return counts.orderBy(F.col("order_count").desc(), F.col("status"))


def daily_net_revenue(orders: DataFrame) -> DataFrame:
    """Non-cancelled revenue per day."""
    return (
        orders.where(not_cancelled())
        .groupBy(F.to_date("order_date").alias("day"))
        .agg(F.sum("total_amount").cast("decimal(28,2)").alias("revenue"))
    )


def newest_days(daily: DataFrame, days: int = 31) -> DataFrame:
    return daily.orderBy(F.col("day").desc()).limit(days)


def latest_orders(orders: DataFrame, count: int = 5) -> DataFrame:
    """Most recently changed orders; the key breaks ties."""
    return (
        orders.select("order_id", "customer_id", "status", "total_amount", "updated_at")
        .orderBy(F.col("updated_at").desc(), F.col("order_id").desc())
        .limit(count)
    )


def open_orders(orders: DataFrame, window: int = 200) -> DataFrame:
    """The newest orders that are not cancelled, by key."""
    return orders.where(not_cancelled()).orderBy(F.col("order_id").desc()).limit(window)


def sample_rows(df: DataFrame, key: str, count: int, seed: int) -> DataFrame:
    """A uniform sample without replacement, the same on every run and partitioning.

    The order is a keyed digest rather than ``rand``: a task that is run again draws the same rows.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(digest, F.col(key)).limit(count)


def random_row(df: DataFrame, condition: Column, key: str, seed: int) -> DataFrame:
    return sample_rows(df.where(condition), key, 1, seed)


def table_counts(frames: Mapping[str, DataFrame], amount_table: str = "orders",
                 amount: str = "total_amount") -> DataFrame:
    """Rows of every table and the revenue total of one of them (zero when empty)."""
    parts = []
    for name, df in frames.items():
        if name == amount_table:
            total = F.coalesce(F.sum(amount), F.lit(0))
        else:
            total = F.lit(None)
        parts.append(
            df.agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                total.cast("decimal(28,2)").alias("total_amount"),
            )
        )
    return union_all(parts)
