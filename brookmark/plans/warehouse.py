"""Batch warehouse: extract, land, upsert raw, build the int, gold and prs layers."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession

from brookmark.frames import LazyFrames
from brookmark.operators import clean, star
from brookmark.operators.merge import prepare_batch
from brookmark.sources.bronze import write_bronze
from brookmark.sources.extract import extract_incremental, guard_keys
from brookmark.sources.ledger import LoadLedger
from brookmark.sources.tables import SlotTable, materialize
from brookmark.sources.unique import UniqueIndex
from brookmark.specs import CATALOG, TableSpec


def build_models(raw: Mapping[str, DataFrame], as_of: Column | None = None) -> LazyFrames:
    """All warehouse models, keyed ``layer.name``; each is composed when it is first asked for."""
    models: LazyFrames

    def orders() -> DataFrame:
        return models["int.orders_clean"]

    def items() -> DataFrame:
        return models["int.order_items_clean"]

    def customers() -> DataFrame:
        return models["int.customers_clean"]

    def products() -> DataFrame:
        return models["int.products_clean"]

    models = LazyFrames(
        {
            "int.customers_clean": lambda: clean.customers_clean(raw["customers"]),
            "int.products_clean": lambda: clean.products_clean(raw["products"]),
            "int.orders_clean": lambda: clean.orders_clean(raw["orders"]),
            "int.order_items_clean": lambda: clean.order_items_clean(raw["order_items"]),
            "gold.dim_customer": lambda: star.dim_customer(customers(), as_of),
            "gold.dim_product": lambda: star.dim_product(products(), as_of),
            "gold.dim_date": lambda: star.dim_date(orders(), as_of),
            "gold.fact_order_items": lambda: star.fact_order_items(items(), orders(), as_of),
            "prs.v_customers": lambda: star.v_customers(customers(), as_of),
            "prs.v_products": lambda: star.v_products(products(), as_of),
            "prs.v_orders": lambda: star.v_orders(items(), orders(), as_of),
            "prs.v_daily_revenue": lambda: star.v_daily_revenue(orders(), as_of),
        }
    )
    return models


def with_raw(raw: Mapping[str, DataFrame], as_of: Column | None = None) -> LazyFrames:
    """Raw tables and models together, as the checks see them."""
    named = LazyFrames({f"raw.{n}": (lambda n=n: raw[n]) for n in raw})
    models = build_models(raw, as_of)
    return named.joined({n: (lambda n=n: models[n]) for n in models})


def raw_table(spark: SparkSession, root: str, spec: TableSpec, width: int | None = 1_000_000) -> SlotTable:
    return SlotTable(spark, f"{root.rstrip('/')}/raw/{spec.name}_source", spec.primary_key, width)


def ingest(spark: SparkSession, source: DataFrame, root: str, spec: TableSpec,
           logical_time: datetime, overlap: timedelta = timedelta(0)) -> int:
    """One incremental load of a table into the landing area and the raw layer; rows synced.

    The mark comes from the ledger of loads; the target is scanned for it only where the ledger has none.
    A table without a cursor is loaded in full. ``overlap`` reaches back behind the mark for late
    commits. Unique columns are checked against their index. Versions of a key with one cursor value are settled by all other columns. A row without a key fails the landing write before anything is committed. The landed files
    are read back for the merge, so the source is read once.
    """
    raw, ledger = raw_table(spark, root, spec), LoadLedger(spark, root)
    stored = raw.read_or_none()
    mark = ledger.mark(spec) if spec.cursor_column and stored is not None else None
    fresh = extract_incremental(source, stored, spec, overlap, mark)
    loaded = write_bronze(guard_keys(fresh, spec), f"{root}/bronze", spec, logical_time)
    synced = loaded.get["rows_synced"]
    if synced == 0:
        return 0
    landed = spark.read.schema(spec.schema).parquet(
        f"{root.rstrip('/')}/bronze/{spec.name}_source/ingest_date={logical_time:%Y-%m-%d}"
        f"/run_id={logical_time:%Y%m%dT%H%M%S}"
    )
    others = [c for c in spec.schema.names if c not in (spec.primary_key, spec.cursor_column)]
    batch = prepare_batch(landed, spec.primary_key, spec.cursor_column, others)
    for column in spec.unique_columns:
        index = UniqueIndex(raw, column)
        index.build()
        index.check(batch)
        index.add(batch)
    raw.merge(batch, spec.update_columns, version=None, keys=landed)
    ledger.record(spec, logical_time, synced, loaded.get["mark"])
    return synced


def ingest_all(spark: SparkSession, sources: dict[str, DataFrame], root: str,
               logical_time: datetime, threads: int = 4, overlap: timedelta = timedelta(0)) -> dict[str, int]:
    """Independent tables load side by side in one session."""
    with ThreadPoolExecutor(threads) as pool:
        jobs = {
            name: pool.submit(ingest, spark, df, root, CATALOG[name], logical_time, overlap)
            for name, df in sources.items()
        }
        return {name: job.result() for name, job in jobs.items()}


def materialize_models(spark: SparkSession, raw: dict[str, DataFrame]) -> None:
    """Rebuild the stored layers in dependency order; later models read the stored earlier ones."""
    models = {
        "customers": clean.customers_clean(raw["customers"]),
        "products": clean.products_clean(raw["products"]),
        "orders": clean.orders_clean(raw["orders"]),
        "order_items": clean.order_items_clean(raw["order_items"]),
    }
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: materialize(models[n], "int", f"{n}_clean"), models))
    stored = {n: spark.table(f"int.{n}_clean") for n in models}
    gold = {
        "dim_customer": star.dim_customer(stored["customers"]),
        "dim_product": star.dim_product(stored["products"]),
        "dim_date": star.dim_date(stored["orders"]),
        "fact_order_items": star.fact_order_items(stored["order_items"], stored["orders"]),
    }
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: materialize(gold[n], "gold", n), gold))
    create_views(spark)


# Presentation views as stored SQL over the int layer, for queries that name prs.<view>.
VIEW_SQL = {
    "v_customers": "SELECT customer_id, first_name, last_name, full_name, email, address, city,"
    " state, zip_code, created_at, updated_at, current_timestamp() AS dbt_updated_at"
    " FROM int.customers_clean",
    "v_products": "SELECT *, current_timestamp() AS dbt_updated_at FROM int.products_clean",
    "v_orders": "SELECT i.item_id, o.order_id, o.customer_id, i.product_id, o.order_date,"
    " i.quantity, i.unit_price, o.total_amount AS order_total_amount, o.status AS order_status,"
    " o.created_at AS order_created_at, o.updated_at AS order_updated_at,"
    " i.quantity * i.unit_price AS item_total_price, current_timestamp() AS dbt_updated_at"
    " FROM int.order_items_clean i JOIN int.orders_clean o ON i.order_id = o.order_id",
    "v_daily_revenue": "SELECT status, to_date(order_date) AS order_date, count(*) AS order_count,"
    " sum(total_amount) AS total_revenue,"
    " cast(sum(total_amount) AS double) / count(total_amount) AS avg_order_value,"
    " min(total_amount) AS min_order_value, max(total_amount) AS max_order_value,"
    " current_timestamp() AS calculated_at FROM int.orders_clean"
    " GROUP BY status, to_date(order_date) ORDER BY order_date DESC, status",
}


def create_views(spark: SparkSession) -> None:
    spark.sql("CREATE NAMESPACE IF NOT EXISTS prs")
    for name, text in VIEW_SQL.items():
        spark.sql(f"CREATE OR REPLACE VIEW prs.{name} AS {text}")
