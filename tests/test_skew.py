"""One key with a third of all rows: results stay whole and the hot key is split."""

import contextlib

import pytest
from pyspark.sql import functions as F

from brookmark.operators import quality, star
from brookmark.operators.reconcile import reconcile_totals

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
}
LINES, ORDERS = 300_000, 2_000


@contextlib.contextmanager
def settings(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def lines(spark):
    hot = F.col("id") % 3 == 0
    return spark.range(0, LINES, 1, 16).select(
        F.col("id").alias("item_id"),
        F.when(hot, F.lit(7)).otherwise(F.col("id") % ORDERS).alias("order_id"),
        F.when(hot, F.lit(1)).otherwise(F.col("id") % 50).alias("product_id"),
        F.lit(2).alias("quantity"),
        F.lit("1.50").cast("decimal(18,2)").alias("unit_price"),
    )


@pytest.fixture(scope="module")
def orders(spark):
    day = F.timestamp_micros(F.lit(1_704_067_200_000_000) + (F.col("id") % 90) * F.lit(86_400_000_000))
    return spark.range(ORDERS).select(
        F.col("id").alias("order_id"), (F.col("id") % 100).alias("customer_id"), day.alias("order_date"),
        F.lit("3.00").cast("decimal(18,2)").alias("total_amount"), F.lit("shipped").alias("status"),
        day.alias("created_at"), day.alias("updated_at"),
    )


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_long_order_is_split_in_the_fact(spark, lines, orders):
    with settings(spark, SMALL):
        fact = star.fact_order_items(lines, orders)
        plan = executed(fact)
        assert "skew=true" in plan
        assert fact.count() == LINES and fact.where("order_id = 7").count() > LINES // 3


def test_totals_are_summed_before_the_join(spark, lines, orders):
    with settings(spark, SMALL):
        totals = star.accepted_order_totals(lines, orders)
        plan = executed(totals)
        # the lines reach no join: below it there are sums per order only
        below = plan[plan.index("SortMergeJoin") :]
        assert "HashAggregate" in below and "HashAggregate" not in plan[: plan.index("SortMergeJoin")]
        assert totals.agg(F.sum("order_total")).first()[0] == LINES * 3
        gaps = reconcile_totals(star.with_line_amount(lines), orders)
        assert gaps.where("order_id = 7").first().lines_total > LINES


def test_star_query_keeps_every_line(spark, lines, orders):
    with settings(spark, SMALL):
        goods = spark.range(50).select(F.col("id").alias("product_id"), (F.col("id") % 4).cast("string").alias("category"))
        rows = star.star_revenue(star.fact_order_items(lines, orders), star.dim_date(orders), goods).collect()
        assert sum(r.revenue for r in rows) == LINES * 3


def test_references_are_counted_before_the_parent_is_joined(spark, lines, orders):
    checks = [
        quality.Check("lines", "order_id", "relationships", parent="orders", parent_column="order_id"),
        quality.Check("lines", "order_id", "unique"),
    ]
    some = {"lines": lines, "orders": orders.where("order_id <> 7")}
    report = {r.check_name: r.failures for r in quality.run_checks(spark, some, checks).collect()}
    assert report["relationships"] == lines.where("order_id = 7").count()
    assert report["unique"] == lines.groupBy("order_id").count().where("count > 1").count()
