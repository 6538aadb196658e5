"""Declared table specifications: the one description every generic operator works from."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# Declared type name -> (stored Spark type, type of the leaf in a change-log image).
# Timestamps travel as epoch microseconds and dates as epoch days.
_DECLARED: dict[str, tuple[T.DataType, T.DataType]] = {
    "BIGINT": (T.LongType(), T.LongType()),
    "INTEGER": (T.IntegerType(), T.IntegerType()),
    "SMALLINT": (T.ShortType(), T.ShortType()),
    "BOOLEAN": (T.BooleanType(), T.BooleanType()),
    "REAL": (T.FloatType(), T.FloatType()),
    "DOUBLE PRECISION": (T.DoubleType(), T.DoubleType()),
    "DATE": (T.DateType(), T.IntegerType()),
    "TIMESTAMP": (T.TimestampType(), T.LongType()),
    "TEXT": (T.StringType(), T.StringType()),
    "VARCHAR": (T.StringType(), T.StringType()),
    "CHAR": (T.StringType(), T.StringType()),
    "UUID": (T.StringType(), T.StringType()),
    "JSON": (T.StringType(), T.StringType()),
    "JSONB": (T.StringType(), T.StringType()),
}
NUMERIC_PRECISION = 18
DEFAULT_SCALE = 2

_TYPE_TEXT = re.compile(r"^\s*(?P<base>[A-Z ]+?)\s*(\(\s*(?P<args>[^)]*)\))?\s*$", re.IGNORECASE)


def _split_type(declared: str) -> tuple[str, list[str]]:
    found = _TYPE_TEXT.match(declared)
    if not found:
        return declared.upper(), []
    args = found["args"] or ""
    return found["base"].upper(), [a.strip() for a in args.split(",") if a.strip()]


def _resolve(declared: str) -> tuple[T.DataType, T.DataType]:
    base, args = _split_type(declared)
    if base == "NUMERIC":
        scale = int(args[1]) if len(args) == 2 else DEFAULT_SCALE
        money = T.DecimalType(NUMERIC_PRECISION, scale)
        return money, money
    if base not in _DECLARED:
        raise ValueError(f"unsupported type {declared}")
    return _DECLARED[base]


def spark_type(declared: str) -> T.DataType:
    """Spark type of a declared column type; unknown names are an error."""
    return _resolve(declared)[0]


def leaf_type(declared: str) -> T.DataType:
    """Type the column has inside a change-log row image."""
    return _resolve(declared)[1]


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, str], ...]
    primary_key: str
    cursor_column: str | None = None
    partition_column: str | None = None
    update_columns: tuple[str, ...] = ()
    unique_columns: tuple[str, ...] = ()
    low_cardinality: tuple[str, ...] = ()

    def __post_init__(self):
        declared = dict(self.columns)
        if self.primary_key not in declared:
            raise ValueError(f"{self.name}: primary key {self.primary_key} is not a column")
        for role in ("update_columns", "low_cardinality", "unique_columns"):
            unknown = [c for c in getattr(self, role) if c not in declared]
            if unknown:
                raise ValueError(f"{self.name}: {role} names unknown columns {unknown}")
        for column, text in self.columns:
            try:
                spark_type(text)
            except ValueError as error:
                raise ValueError(f"{self.name}.{column}: {error}") from None
        part = self.partition_column
        if part is None:
            return
        if part not in declared:
            raise ValueError(f"{self.name}: partition column {part} is not a column")
        if not isinstance(spark_type(declared[part]), (T.TimestampType, T.DateType)):
            raise ValueError(f"{self.name}: partition column {part} must be TIMESTAMP or DATE")
        if part in self.update_columns:
            # versions of one key would be spread over several months
            raise ValueError(f"{self.name}: partition column {part} may not be updated")

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c, spark_type(t), c != self.primary_key) for c, t in self.columns]
        )

    @property
    def image_schema(self) -> T.StructType:
        """Row image inside a change-log envelope."""
        return T.StructType([T.StructField(c, leaf_type(t)) for c, t in self.columns])

    @property
    def envelope_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField("op", T.StringType()),
                T.StructField("before", self.image_schema),
                T.StructField("after", self.image_schema),
                T.StructField("ts_ms", T.LongType()),
            ]
        )

    def ddl(self, layer: str = "raw") -> str:
        """CREATE TABLE text of the stored table; uniqueness is checked on load, not declared."""
        lines = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in self.schema.fields
        )
        return f"CREATE TABLE IF NOT EXISTS {layer}.{self.name}_source ({lines}) USING parquet"

    def topic(self, prefix: str = "cdc", source_schema: str = "public") -> str:
        return f"{prefix}.{source_schema}.{self.name}"


def load_specs(tables: Mapping[str, Mapping]) -> dict[str, TableSpec]:
    """Specs from a manifest mapping ``{table: {primary_key, columns, ...}}``, validated."""
    specs = {}
    for name, entry in tables.items():
        specs[name] = TableSpec(
            name=name,
            columns=tuple(entry["columns"].items()),
            primary_key=entry["primary_key"],
            cursor_column=entry.get("cursor_column"),
            partition_column=entry.get("partition_column"),
            update_columns=tuple(entry.get("update_columns", ())),
            unique_columns=tuple(entry.get("unique_columns", ())),
            low_cardinality=tuple(entry.get("low_cardinality", ())),
        )
    return specs


def load_manifest(path: str) -> dict[str, TableSpec]:
    """Specs from a manifest file, JSON or (where the parser is installed) YAML."""
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            manifest = json.load(handle)
        else:
            import yaml

            manifest = yaml.safe_load(handle)
    return load_specs(manifest["tables"])


# The four operational tables.
CATALOG: dict[str, TableSpec] = load_specs(
    {
        "customers": {
            "primary_key": "customer_id",
            "cursor_column": "updated_at",
            "partition_column": "created_at",
            "columns": {
                "customer_id": "BIGINT",
                "first_name": "TEXT",
                "last_name": "TEXT",
                "email": "TEXT",
                "address": "TEXT",
                "city": "TEXT",
                "state": "TEXT",
                "zip_code": "TEXT",
                "created_at": "TIMESTAMP",
                "updated_at": "TIMESTAMP",
            },
            "update_columns": [
                "first_name", "last_name", "email", "address", "city", "state", "zip_code",
                "updated_at",
            ],
            "unique_columns": ["email"],
        },
        "products": {
            "primary_key": "product_id",
            "cursor_column": "updated_at",
            "partition_column": "created_at",
            "columns": {
                "product_id": "BIGINT",
                "name": "TEXT",
                "description": "TEXT",
                "price": "NUMERIC(18,2)",
                "category": "TEXT",
                "stock_quantity": "INTEGER",
                "created_at": "TIMESTAMP",
                "updated_at": "TIMESTAMP",
            },
            "update_columns": [
                "name", "description", "price", "category", "stock_quantity", "updated_at",
            ],
            "low_cardinality": ["category"],
        },
        "orders": {
            "primary_key": "order_id",
            "cursor_column": "updated_at",
            "partition_column": "created_at",
            "columns": {
                "order_id": "BIGINT",
                "customer_id": "BIGINT",
                "order_date": "TIMESTAMP",
                "total_amount": "NUMERIC(18,2)",
                "status": "TEXT",
                "created_at": "TIMESTAMP",
                "updated_at": "TIMESTAMP",
            },
            "update_columns": ["total_amount", "status", "updated_at"],
            "low_cardinality": ["status"],
        },
        "order_items": {
            "primary_key": "item_id",
            "cursor_column": "updated_at",
            "partition_column": "created_at",
            "columns": {
                "item_id": "BIGINT",
                "order_id": "BIGINT",
                "product_id": "BIGINT",
                "quantity": "INTEGER",
                "unit_price": "NUMERIC(18,2)",
                "created_at": "TIMESTAMP",
                "updated_at": "TIMESTAMP",
            },
            "update_columns": ["quantity", "unit_price", "updated_at"],
        },
    }
)

# Status domain of an order, in lifecycle order.
ORDER_STATUSES = ("pending", "processing", "shipped", "delivered", "cancelled")

# Columns a silver merge overwrites on a match (raw merges use spec.update_columns).
SILVER_UPDATE_COLUMNS: dict[str, tuple[str, ...]] = {
    "orders": ("total_amount", "status", "updated_at", "processed_at"),
    "customers": (
        "first_name", "last_name", "email", "address", "city", "state", "zip_code",
        "updated_at", "processed_at",
    ),
    "products": (
        "name", "description", "price", "category", "stock_quantity", "updated_at",
        "processed_at",
    ),
    "order_items": (
        "order_id", "product_id", "quantity", "unit_price", "updated_at", "processed_at",
    ),
}

# Attribute whose folders a silver table lies in; order items have none.
SILVER_PARTITIONS: dict[str, str] = {"orders": "status", "customers": "state", "products": "category"}

# Column a silver table is clustered on by maintenance.
CLUSTER_COLUMNS: dict[str, str] = {
    "orders": "order_date",
    "customers": "customer_id",
    "order_items": "order_id",
    "products": "product_id",
}
