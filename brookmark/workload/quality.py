"""Data-quality reports, reconciliation and schema drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from brookmark.operators.catalog import catalog_diff, frame_catalog, spec_catalog
from brookmark.operators.quality import Check, failing_rows, orphans, run_checks, verdict
from brookmark.operators.reconcile import reconcile_totals
from brookmark.operators.clean import order_items_clean, orders_clean
from brookmark.operators.star import table_counts, with_line_amount
from brookmark.plans.checks import DECLARED_CHECKS, MART_CHECKS
from brookmark.plans.warehouse import with_raw
from brookmark.sources import fixture
from brookmark.sources.extract import valid_batch
from brookmark.specs import CATALOG, ORDER_STATUSES
from brookmark.workload.shapes import AS_OF, with_stages


def _models(raw):
    return with_raw(raw, F.lit(AS_OF).cast("timestamp"))


def _frames(spark, d):
    return _models(fixture.operational(spark, d))


def dq_report(spark, d):
    return run_checks(spark, _frames(spark, d), DECLARED_CHECKS)


def fk_orphans(spark, d):
    """Fact lines of rejected products, which the product dimension does not have."""
    frames = _frames(spark, d)
    return orphans(frames["gold.fact_order_items"], "product_id", frames["gold.dim_product"], "product_id")


def _old_customers(spark, d):
    """Customers as an older source had them: one name column and no change time."""
    return fixture.customers(spark, d).select(
        "customer_id", F.concat_ws(" ", "first_name", "last_name").alias("name"), "email", "address",
        "city", "state", "zip_code", "created_at",
    )


def schema_drift(spark, d):
    """Columns missing or unexpected in each source, with the rows they concern."""
    frames = fixture.operational(spark, d).replaced(customers=_old_customers(spark, d))
    drift = catalog_diff(spec_catalog(spark, "raw", CATALOG), frame_catalog(spark, "raw", frames))
    counts = table_counts(frames).select("table_name", F.col("row_count").alias("rows_affected"))
    return drift.join(counts, "table_name")


def unverified_report(spark, d):
    """The report when one layer was never built: its checks are skipped, so nothing is verified."""
    frames = _frames(spark, d).without("prs.")
    return verdict(run_checks(spark, frames, DECLARED_CHECKS))


QUERIES = {
    "dq_report": dq_report,
    "dq_verdict": lambda spark, d: verdict(dq_report(spark, d)),
    "dq_unverified": unverified_report,
    "marts_populated": lambda spark, d: run_checks(spark, _frames(spark, d), MART_CHECKS),
    "fk_orphans": fk_orphans,
    "unique_violations": lambda spark, d: failing_rows(
        {"items": fixture.order_item_versions(spark, d)}, Check("items", "item_id", "unique")
    ),
    "range_violations": lambda spark, d: failing_rows(
        {"products": fixture.products(spark, d)}, Check("products", "price", "range", minimum=0)
    ),
    "status_violations": lambda spark, d: failing_rows(
        {"orders": fixture.orders(spark, d)},
        Check("orders", "status", "accepted_values", values=ORDER_STATUSES[:4]),
    ),
    "batch_validity": lambda spark, d: valid_batch(
        fixture.orders(spark, d), "order_id", "total_amount"
    ),
    "reconcile_totals": lambda spark, d: reconcile_totals(
        with_line_amount(order_items_clean(fixture.order_items(spark, d))),
        orders_clean(fixture.orders(spark, d)),
    ),
    "schema_drift": schema_drift,
}

_STAGE_OF = {
    "raw.orders": "raw_orders", "raw.customers": "raw_customers", "raw.products": "raw_products",
    "raw.order_items": "raw_items", "int.orders_clean": "orders_clean",
    "int.products_clean": "products_clean", "prs.v_daily_revenue": "daily_revenue",
    "gold.fact_order_items": "fact", "gold.dim_customer": "dim_customer",
    "gold.dim_product": "dim_product", "gold.dim_date": "dim_date",
}


def _failures(check: Check) -> str:
    stage, c = _STAGE_OF[check.table], check.column
    if check.kind == "not_null":
        return f"(select count(*) from {stage} where {c} is null)"
    if check.kind == "unique":
        return (
            f"(select count(*) from (select {c} from {stage} where {c} is not null"
            f" group by {c} having count(*) > 1) u)"
        )
    if check.kind == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in check.values)
        return f"(select count(*) from {stage} where {c} not in ({listed}))"
    if check.kind == "range":
        return f"(select count(*) from {stage} where {c} < {check.minimum})"
    if check.kind == "populated":
        return f"(select case when count(*) = 0 then 1 else 0 end from {stage})"
    parent = _STAGE_OF[check.parent]
    return (
        f"(select count(*) from {stage} where {c} is not null and {c} not in"
        f" (select {check.parent_column} from {parent}))"
    )


def _report_sql(checks: list[Check]) -> str:
    lines = " union all ".join(
        f"select '{c.table}' as table_name, '{c.column}' as column_name, '{c.kind}' as check_name,"
        f" cast({_failures(c)} as bigint) as failures"
        for c in checks
    )
    return f"select *, case when failures = 0 then 'PASS' else 'FAIL' end as status from ({lines}) r"


def _verdict_sql(checks: list[Check], skipped: int) -> str:
    return f"""
        select count(case when status = 'PASS' then 1 end) as passed,
               count(case when status = 'FAIL' then 1 end) as failed, cast({skipped} as bigint) as skipped,
               count(case when status = 'FAIL' then 1 end) = 0 and {skipped} = 0 as verified
        from ({_report_sql(checks)}) v"""


_BUILT = [c for c in DECLARED_CHECKS if not c.table.startswith("prs.")]

ORACLE = {
    "dq_report": with_stages(_report_sql(DECLARED_CHECKS)),
    "dq_verdict": with_stages(_verdict_sql(DECLARED_CHECKS, 0)),
    "dq_unverified": with_stages(_verdict_sql(_BUILT, len(DECLARED_CHECKS) - len(_BUILT))),
    "marts_populated": with_stages(_report_sql(MART_CHECKS)),
    "fk_orphans": with_stages(
        "select * from fact where product_id not in (select product_id from dim_product)"
    ),
    "unique_violations": with_stages("""
        select item_id, count(*) as "rows" from item_versions group by 1 having count(*) > 1"""),
    "range_violations": with_stages("select * from raw_products where price < 0"),
    "status_violations": with_stages("select * from raw_orders where status = 'cancelled'"),
    "batch_validity": with_stages("""
        select count(case when order_id is null then 1 end) as null_keys,
               count(case when total_amount < 0 then 1 end) as negative_amounts, count(*) as batch_rows
        from raw_orders"""),
    "reconcile_totals": with_stages("""
        select o.order_id, o.total_amount, s.lines_total,
               cast(o.total_amount - s.lines_total as decimal(38,2)) as difference
        from orders_clean o join (select order_id, cast(sum(line_amount) as decimal(38,2)) as lines_total
                                  from fact group by 1) s on o.order_id = s.order_id
        where o.total_amount <> s.lines_total"""),
    "schema_drift": with_stages("""
        select 'customers' as table_name, column_name, drift, (select count(*) from raw_customers) as rows_affected
        from (values ('first_name', 'missing'), ('last_name', 'missing'), ('updated_at', 'missing'),
                     ('name', 'unexpected')) v(column_name, drift)"""),
}
