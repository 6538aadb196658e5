"""Column catalog of stored layers, its text overview and schema drift."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmark.specs import TableSpec

_CATALOG_SCHEMA = "layer string, table_name string, column_name string, data_type string, position int"

# Named layers a query may read.
LAYERS = ("raw", "int", "gold", "prs", "lake", "mirror")


def column_catalog(spark: SparkSession, layers: Iterable[str] = LAYERS) -> DataFrame:
    """Columns of every table in the named layers; layers that do not exist are left out."""
    rows = []
    for layer in layers:
        if not spark.catalog.databaseExists(layer):
            continue
        for table in spark.catalog.listTables(layer):
            if table.isTemporary:
                continue
            for place, column in enumerate(spark.catalog.listColumns(f"{layer}.{table.name}"), 1):
                rows.append((layer, table.name, column.name, column.dataType, place))
    return spark.createDataFrame(rows, _CATALOG_SCHEMA)


def frame_catalog(spark: SparkSession, layer: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """The same listing for frames that are not stored."""
    rows = [
        (layer, name, field.name, field.dataType.simpleString(), place)
        for name, df in frames.items()
        for place, field in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, _CATALOG_SCHEMA)


def spec_catalog(spark: SparkSession, layer: str, specs: dict[str, TableSpec]) -> DataFrame:
    """Listing of what specifications declare."""
    rows = [
        (layer, spec.name, field.name, field.dataType.simpleString(), place)
        for spec in specs.values()
        for place, field in enumerate(spec.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, _CATALOG_SCHEMA)


def filter_catalog(catalog: DataFrame, layers: Iterable[str], pattern: str = "%") -> DataFrame:
    """Columns in some layers whose table name matches a LIKE pattern."""
    return catalog.where(F.col("layer").isin(list(layers)) & F.col("table_name").like(pattern))


def schema_overview(catalog: DataFrame) -> DataFrame:
    """One line per table: its columns and types in order."""
    catalog = catalog.withColumn("item", F.concat_ws(" ", "column_name", "data_type"))
    in_order = F.array_sort(F.collect_list(F.struct("position", "item")))
    return (
        catalog.groupBy(F.concat_ws(".", "layer", "table_name").alias("table_name"))
        .agg(F.array_join(F.transform(in_order, lambda c: c["item"]), ", ").alias("columns"))
        .orderBy("table_name")
    )


def ordered_text(df: DataFrame, by: str, text: str, order: str, separator: str = ", ") -> DataFrame:
    """Text of a group joined in a given order (groups are column lists, so bounded in size)."""
    return df.groupBy(by).agg(
        F.expr(f"listagg({text}, '{separator}') within group (order by {order})").alias(text)
    )


def catalog_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Columns declared but absent, and present but undeclared."""
    names = ["table_name", "column_name"]
    missing = expected.join(actual, names, "left_anti").select(*names, F.lit("missing").alias("drift"))
    extra = actual.join(expected, names, "left_anti").select(*names, F.lit("unexpected").alias("drift"))
    return missing.unionByName(extra)
