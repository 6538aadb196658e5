"""Cleaning models: the warehouse layer filters, the lake layer normalizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmark.functions.scalars import join_text, money, tidy, tidy_lower
from brookmark.specs import CATALOG


def customers_clean(df: DataFrame) -> DataFrame:
    names = CATALOG["customers"].column_names
    full = join_text(F.col("first_name"), " ", F.col("last_name"))
    return df.select(*names, full.alias("full_name"))


def products_clean(df: DataFrame) -> DataFrame:
    return df.select(*CATALOG["products"].column_names).where(F.col("price") >= 0)


def quality_flag() -> Column:
    """First failing rule of an order, or ``valid``; a NULL amount does not fail the first rule."""
    return (
        F.when(F.col("total_amount") <= 0, "invalid_amount")
        .when(F.col("status").isNull(), "missing_status")
        .when(F.col("order_date").isNull(), "missing_date")
        .otherwise("valid")
    )


def orders_clean(df: DataFrame) -> DataFrame:
    keep = (quality_flag() == "valid") & F.col("order_id").isNotNull() & (F.col("total_amount") > 0)
    return df.select(*CATALOG["orders"].column_names).where(keep)


def reject_profile(df: DataFrame) -> DataFrame:
    """Orders per quality flag."""
    return df.groupBy(quality_flag().alias("quality_flag")).agg(F.count(F.lit(1)).alias("order_count"))


def order_items_clean(df: DataFrame) -> DataFrame:
    keep = (F.col("quantity") > 0) & (F.col("unit_price") >= 0)
    return df.select(*CATALOG["order_items"].column_names).where(keep)


def _stamped(df: DataFrame, columns: list[str], as_of: Column | None) -> DataFrame:
    load_time = F.current_timestamp() if as_of is None else as_of
    return df.select(*columns, load_time.alias("processed_at"))


def _with_timestamps(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp") for n in names})


def silver_orders(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    kept = df.where(
        F.col("order_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & (F.col("total_amount") > 0)
        & F.col("status").isNotNull()
    )
    typed = _with_timestamps(kept, ("order_date", "created_at", "updated_at")).withColumn(
        "total_amount", money(F.col("total_amount"))
    )
    return _stamped(typed, CATALOG["orders"].column_names, as_of)


def silver_customers(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    tidied = _with_timestamps(df, ("created_at", "updated_at")).withColumns(
        {
            "first_name": tidy(F.col("first_name")),
            "last_name": tidy(F.col("last_name")),
            "email": tidy_lower(F.col("email")),
        }
    )
    return _stamped(tidied, CATALOG["customers"].column_names, as_of)


def silver_products(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    tidied = _with_timestamps(df, ("created_at", "updated_at")).withColumns(
        {"name": tidy(F.col("name")), "category": tidy_lower(F.col("category"))}
    )
    return _stamped(tidied, CATALOG["products"].column_names, as_of)


def silver_order_items(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    typed = _with_timestamps(df, ("created_at", "updated_at"))
    return _stamped(typed, CATALOG["order_items"].column_names, as_of)


WAREHOUSE_MODELS = {
    "customers": customers_clean,
    "products": products_clean,
    "orders": orders_clean,
    "order_items": order_items_clean,
}
SILVER_MODELS = {
    "customers": silver_customers,
    "products": silver_products,
    "orders": silver_orders,
    "order_items": silver_order_items,
}
