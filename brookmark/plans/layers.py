"""Named layers: stored tables published as views, so queries can say lake.orders."""

from __future__ import annotations

from pyspark.sql import SparkSession

from brookmark.plans.lakehouse import silver_table
from brookmark.plans.warehouse import raw_table
from brookmark.sources.files import Folders
from brookmark.sources.tables import ensure_namespace
from brookmark.specs import CATALOG, SILVER_PARTITIONS, TableSpec
from brookmark.streaming.cdc import tie_order
from brookmark.streaming.mirror import NO_BATCH, Mirror, mirror_of


def _view(spark: SparkSession, layer: str, name: str, text: str) -> None:
    ensure_namespace(spark, layer)
    spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS {text}")


def publish_raw(spark: SparkSession, root: str, spec: TableSpec) -> None:
    columns = ", ".join(spec.column_names)
    _view(spark, "raw", f"{spec.name}_source",
          f"SELECT {columns} FROM parquet.`{root}/raw/{spec.name}_source`")


def publish_lake(spark: SparkSession, root: str, spec: TableSpec) -> None:
    """``lake.<t>``; a filter on the table's attribute opens only its folders."""
    attribute = SILVER_PARTITIONS.get(spec.name)
    text = f"CAST({attribute} AS STRING)"  # a folder name that looks like a number is read as one
    value = f"CASE WHEN {text} LIKE '=%' THEN substring({text}, 2) ELSE {text} END AS {attribute}"
    columns = ", ".join(value if c == attribute else c for c in [*spec.column_names, "processed_at"])
    _view(spark, "lake", spec.name, f"SELECT {columns} FROM parquet.`{root}/silver/{spec.name}`")


def publish_mirror(spark: SparkSession, mirror: Mirror) -> None:
    """``mirror.<t>`` shows every version that counts, ``mirror.<t>_current`` the live rows.

    The views follow the log, compactions and the removal of folded batches without being made again: of the log
    only batches after the mark are read, as the mirror itself does, and each folder keeps a file
    with its columns.
    """
    mirror.prepare()
    spec, names = mirror.spec, ", ".join(f.name for f in mirror.schema.fields if f.name != "batch_id")
    number = "CAST(batch_id AS BIGINT) AS batch_id"  # a folder of the log, a column of the base
    mark = f"(SELECT coalesce(max(upto), {NO_BATCH}) FROM parquet.`{mirror.path}/folded`)"
    _view(
        spark, "mirror", spec.name,
        f"SELECT {names}, {number} FROM parquet.`{mirror.path}/base`"
        f" UNION ALL SELECT {names}, {number} FROM parquet.`{mirror.path}/log` WHERE batch_id > {mark}",
    )
    order = ", ".join(f"{c} DESC NULLS LAST" for c in tie_order(mirror.schema.fieldNames(), spec))
    _view(
        spark, "mirror", f"{spec.name}_current",
        f"SELECT {', '.join(spec.column_names)} FROM (SELECT *, row_number() OVER"
        f" (PARTITION BY {spec.primary_key} ORDER BY {order}) AS place"
        f" FROM mirror.{spec.name}) AS v WHERE place = 1 AND NOT is_deleted",
    )


def mirror_path(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/mirror/{spec.name}"


def publish(spark: SparkSession, root: str) -> None:
    """Raw, lake and mirror views of the operational tables stored under a root; absent ones are left out."""
    root = root.rstrip("/")
    for spec in CATALOG.values():
        if raw_table(spark, root, spec).read_or_none() is not None:
            publish_raw(spark, root, spec)
        if silver_table(spark, root, spec).read_or_none() is not None:
            publish_lake(spark, root, spec)
        if Folders(spark, mirror_path(root, spec)).exists("log"):
            publish_mirror(spark, mirror_of(spark, mirror_path(root, spec), spec))
