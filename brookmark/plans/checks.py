"""The declared data-quality checks of the raw, int, prs and gold layers."""

from __future__ import annotations

from brookmark.operators.quality import Check
from brookmark.specs import ORDER_STATUSES


def _key(table: str, column: str) -> list[Check]:
    return [Check(table, column, "unique"), Check(table, column, "not_null")]


def _present(table: str, *columns: str) -> list[Check]:
    return [Check(table, c, "not_null") for c in columns]


def _at_least(table: str, column: str, minimum: int) -> Check:
    return Check(table, column, "range", minimum=minimum)


def _status(table: str, column: str) -> Check:
    return Check(table, column, "accepted_values", values=ORDER_STATUSES)


def _reference(table: str, column: str, parent: str, parent_column: str) -> list[Check]:
    return [
        Check(table, column, "not_null"),
        Check(table, column, "relationships", parent=parent, parent_column=parent_column),
    ]


# Which check each column carries.
RAW_CHECKS = [
    *_key("raw.orders", "order_id"),
    *_present("raw.orders", "customer_id", "total_amount", "status"),
    _status("raw.orders", "status"),
    *_key("raw.customers", "customer_id"),
    *_key("raw.customers", "email"),
    *_key("raw.products", "product_id"),
    *_present("raw.products", "price"),
    *_key("raw.order_items", "item_id"),
    *_present("raw.order_items", "order_id", "product_id"),
]
INT_CHECKS = [
    *_key("int.orders_clean", "order_id"),
    *_present("int.orders_clean", "total_amount"),
    _at_least("int.orders_clean", "total_amount", 0),
    *_present("int.orders_clean", "status"),
    _status("int.orders_clean", "status"),
    *_key("int.products_clean", "product_id"),
    *_present("int.products_clean", "price"),
    _at_least("int.products_clean", "price", 0),
    *_present("int.products_clean", "stock_quantity"),
    _at_least("int.products_clean", "stock_quantity", 0),
]
PRS_CHECKS = [
    *_present("prs.v_daily_revenue", "order_date"),
    _at_least("prs.v_daily_revenue", "order_count", 1),
    _at_least("prs.v_daily_revenue", "total_revenue", 0),
]
GOLD_CHECKS = [
    *_key("gold.fact_order_items", "item_id"),
    *_present("gold.fact_order_items", "order_id"),
    *_reference("gold.fact_order_items", "customer_id", "gold.dim_customer", "customer_id"),
    *_reference("gold.fact_order_items", "product_id", "gold.dim_product", "product_id"),
    *_reference("gold.fact_order_items", "order_date_day", "gold.dim_date", "date_day"),
    *_present("gold.fact_order_items", "quantity"),
    _at_least("gold.fact_order_items", "quantity", 1),
    *_present("gold.fact_order_items", "line_amount", "order_status"),
    _at_least("gold.fact_order_items", "line_amount", 0),
    _status("gold.fact_order_items", "order_status"),
    *_key("gold.dim_customer", "customer_id"),
    *_present("gold.dim_customer", "email"),
    *_key("gold.dim_product", "product_id"),
    *_present("gold.dim_product", "list_price"),
    _at_least("gold.dim_product", "list_price", 0),
    *_key("gold.dim_date", "date_day"),
    *_present("gold.dim_date", "calendar_year", "is_weekend"),
]
DECLARED_CHECKS = RAW_CHECKS + INT_CHECKS + PRS_CHECKS + GOLD_CHECKS

# Marts that must exist and hold rows after a warehouse run.
EXPECTED_MARTS = ("int.orders_clean", "gold.fact_order_items", "gold.dim_customer", "gold.dim_date")
MART_CHECKS = [Check(name, "*", "populated") for name in EXPECTED_MARTS]
