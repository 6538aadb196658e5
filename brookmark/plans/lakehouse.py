"""Batch lakehouse: one landed day, cleaned and merged into the silver tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmark.operators.clean import SILVER_MODELS
from brookmark.operators.merge import prepare_batch
from brookmark.session import stored
from brookmark.sources.attribute import AttributeTable
from brookmark.sources.bronze import bronze_schema, read_bronze_day
from brookmark.sources.files import Folders
from brookmark.sources.tables import SlotTable
from brookmark.specs import CATALOG, CLUSTER_COLUMNS, SILVER_PARTITIONS, SILVER_UPDATE_COLUMNS, TableSpec


def silver_table(spark: SparkSession, root: str, spec: TableSpec,
                 width: int | None = 1_000_000) -> SlotTable | AttributeTable:
    """Silver table in the folders of its attribute, or of its key where it has none."""
    path, order = f"{root.rstrip('/')}/silver/{spec.name}", CLUSTER_COLUMNS.get(spec.name)
    attribute = SILVER_PARTITIONS.get(spec.name)
    if attribute is None:
        return SlotTable(spark, path, spec.primary_key, width, order_by=order)
    schema = T.StructType(spec.schema.fields).add("processed_at", T.TimestampType())
    return AttributeTable(spark, path, spec.primary_key, attribute, schema, width, order_by=order)


def silver_batch(landed: DataFrame, spec: TableSpec) -> DataFrame:
    """Cleaned rows of one landed day, each key once (the newest version, then the newest run); none without a key."""
    keyed = landed.where(F.col(spec.primary_key).isNotNull())
    newest = prepare_batch(keyed, spec.primary_key, spec.cursor_column, ["run_id"])
    return SILVER_MODELS[spec.name](newest)


def _rejects(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/rejects/{spec.name}_source"


def read_rejects(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """Landed rows without a key of all days, with their ``ingest_date`` and ``run_id``."""
    schema = bronze_schema(spec)
    if not Folders(spark, _rejects(root, spec)).exists():
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_rejects(root, spec))


def transform_day(spark: SparkSession, root: str, spec: TableSpec, day: str | None = None,
                  guard: bool = True) -> bool:
    """Merge one landed day (``yyyymmdd``, today by default) into its silver table; False if nothing landed.

    With the guard, a rerun of an older day cannot overwrite newer rows. Rows without a key are not merged but
    kept in ``rejects/<table>_source/ingest_date=<day>``; a rerun of the day replaces its rejects, also by none.
    """
    wanted = day or f"{date.today():%Y%m%d}"
    landed = read_bronze_day(spark, f"{root}/bronze", spec, wanted)
    if landed.isEmpty():
        return False
    kept, key = Observation(f"landed_{spec.name}"), F.col(spec.primary_key)
    batch = silver_batch(landed.observe(kept, F.count_if(key.isNull()).alias("keyless")), spec)
    table, columns, version = silver_table(spark, root, spec), SILVER_UPDATE_COLUMNS[spec.name], "updated_at" if guard else None
    if isinstance(table, AttributeTable):  # stores the batch itself
        table.merge(batch, columns, version)
    else:
        folder = f"{root.rstrip('/')}/staging/{spec.name}_{wanted}"
        once = stored(batch, folder)
        table.merge(once, columns, version, keys=once)
        Folders(spark, folder).delete("")
    rejects, own = Folders(spark, _rejects(root, spec)), f"ingest_date={datetime.strptime(wanted, '%Y%m%d'):%Y-%m-%d}"
    if kept.get["keyless"]:
        landed.where(key.isNull()).drop("ingest_date").write.mode("overwrite").partitionBy("run_id").parquet(f"{rejects.root}/{own}")
    else:
        rejects.delete(own)
    return True


def transform_all(spark: SparkSession, root: str, day: str | None = None) -> dict[str, bool]:
    with ThreadPoolExecutor(len(CATALOG)) as pool:
        jobs = {n: pool.submit(transform_day, spark, root, s, day) for n, s in CATALOG.items()}
        return {n: job.result() for n, job in jobs.items()}
