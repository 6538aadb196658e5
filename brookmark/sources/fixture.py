"""The four operational tables and their change logs, derived from the TPC-H-like test tables.

A few defects are planted in the values (negative price, missing status, ...) so that every
cleaning rule and check has something to find. No row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmark.frames import LazyFrames
from brookmark.functions.decode import encode_image
from brookmark.operators.merge import latest_by_key
from brookmark.specs import CATALOG, TableSpec

_FIRST_SEEN = "2024-01-01 00:00:00"
_LAST_SEEN = "2024-02-01 00:00:00"


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _stamp(text: str):
    return F.lit(text).cast("timestamp")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = base(spark, sf_dir, "nation"), base(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    people = base(spark, sf_dir, "customer")
    return people.join(places, people.c_nationkey == places.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lit(" "), "c_name", F.lit("@Example.COM ")).alias("email"),
        F.concat(F.lit("addr "), F.col("c_custkey").cast("string")).alias("address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("zip_code"),
        _stamp(_FIRST_SEEN).alias("created_at"),
        _stamp(_LAST_SEEN).alias("updated_at"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("p_partkey") % 61 == 0, F.lit(-1.0)).otherwise(F.col("p_retailprice"))
    return base(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("name"),
        F.concat_ws(" ", "p_brand", "p_type").alias("description"),
        price.cast("decimal(18,2)").alias("price"),
        F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("category"),
        (F.col("p_size") * 10).cast("int").alias("stock_quantity"),
        _stamp(_FIRST_SEEN).alias("created_at"),
        _stamp(_LAST_SEEN).alias("updated_at"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, flag = F.col("o_orderkey"), F.col("o_orderstatus")
    amount = (
        F.when(key % 97 == 0, F.lit(-5.0))
        .when(key % 103 == 0, F.lit(None))
        .otherwise(F.col("o_totalprice"))
    )
    status = (
        F.when(key % 101 == 0, F.lit(None))
        .when(flag == "O", "pending")
        .when(flag == "P", "processing")
        .when(key % 3 == 0, "shipped")
        .when(key % 3 == 1, "delivered")
        .otherwise("cancelled")
    )
    placed = F.col("o_orderdate").cast("timestamp")
    return base(spark, sf_dir, "orders").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        placed.alias("order_date"),
        amount.cast("decimal(18,2)").alias("total_amount"),
        status.alias("status"),
        placed.alias("created_at"),
        (placed + F.expr("interval 1 day")).alias("updated_at"),
    )


def order_item_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with repeated keys: several versions of one line."""
    shipped = F.col("l_shipdate").cast("timestamp")
    quantity = F.when(F.col("l_partkey") % 50 == 0, F.lit(0)).otherwise(F.col("l_quantity"))
    return base(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        quantity.cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("unit_price"),
        shipped.alias("created_at"),
        shipped.alias("updated_at"),
        F.col("l_suppkey").alias("tiebreak"),
    )


ITEM_TIEBREAK = ["product_id", "tiebreak", "unit_price", "quantity"]


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of every line."""
    versions = order_item_versions(spark, sf_dir)
    return latest_by_key(versions, "item_id", "updated_at", ITEM_TIEBREAK).drop("tiebreak")


READERS = {
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
}


def operational(spark: SparkSession, sf_dir: str) -> LazyFrames:
    return LazyFrames({name: (lambda name=name: READERS[name](spark, sf_dir)) for name in CATALOG})


# A user's latest activity as a fifth, manifest-only table.
ACTIVITY = TableSpec(
    name="activity",
    columns=(
        ("user_id", "BIGINT"),
        ("event_id", "BIGINT"),
        ("event_type", "TEXT"),
        ("value", "NUMERIC(18,2)"),
        ("seen_on", "DATE"),
        ("seen_at", "TIMESTAMP"),
    ),
    primary_key="user_id",
    cursor_column="seen_at",
    partition_column=None,
    update_columns=("event_id", "event_type", "value", "seen_on", "seen_at"),
    low_cardinality=("event_type",),
)


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one change-log message keyed by user.

    Errors are deletes carrying the key only, signups creates, everything else updates.
    """
    kind = F.col("event_type")
    rows = base(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.col("ts").cast("date").alias("seen_on"),
        F.col("ts").cast("timestamp").alias("seen_at"),
    )
    envelope = F.struct(
        F.when(kind == "error", "d").when(kind == "signup", "c").otherwise("u").alias("op"),
        F.when(kind == "error", encode_image(ACTIVITY, only=["user_id"])).alias("before"),
        F.when(kind != "error", encode_image(ACTIVITY)).alias("after"),
        F.unix_millis(F.col("seen_at")).alias("ts_ms"),
    )
    return rows.select(F.to_json(envelope).alias("value"), F.col("event_id").alias("seq"))


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Life of every order as messages: created pending, moved to its status, deleted if cancelled."""
    spec = CATALOG["orders"]
    final = orders(spark, sf_dir)
    steps = final.withColumn(
        "step",
        F.explode(
            F.when(F.col("status") == "cancelled", F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(
                F.array(F.lit(0), F.lit(1))
            )
        ),
    )
    images = steps.withColumn(
        "status", F.when(F.col("step") == 0, F.lit("pending")).otherwise(F.col("status"))
    ).withColumn("updated_at", F.when(F.col("step") == 0, F.col("created_at")).otherwise(F.col("updated_at")))
    envelope = F.struct(
        F.element_at(F.array(F.lit("c"), F.lit("u"), F.lit("d")), F.col("step") + 1).alias("op"),
        F.when(F.col("step") == 2, encode_image(spec, only=["order_id"])).alias("before"),
        F.when(F.col("step") < 2, encode_image(spec)).alias("after"),
        (F.unix_millis(F.col("created_at")) + F.col("step") * F.lit(86_400_000)).alias("ts_ms"),
    )
    return images.select(F.to_json(envelope).alias("value"), F.col("step").cast("long").alias("seq"))
