import json

import pytest
from pyspark.sql import types as T

from brookmark.specs import CATALOG, TableSpec, leaf_type, load_manifest, load_specs, spark_type

GOOD = {
    "primary_key": "id",
    "cursor_column": "changed",
    "partition_column": "made",
    "columns": {"id": "BIGINT", "label": "TEXT", "made": "TIMESTAMP", "changed": "TIMESTAMP"},
    "update_columns": ["label", "changed"],
}


def broken(**change):
    return {"t": {**GOOD, **change}}


@pytest.mark.parametrize(
    "declared, stored, leaf",
    [
        ("BIGINT", T.LongType(), T.LongType()),
        ("integer", T.IntegerType(), T.IntegerType()),
        ("SMALLINT", T.ShortType(), T.ShortType()),
        ("BOOLEAN", T.BooleanType(), T.BooleanType()),
        ("REAL", T.FloatType(), T.FloatType()),
        ("DOUBLE PRECISION", T.DoubleType(), T.DoubleType()),
        ("NUMERIC(18,4)", T.DecimalType(18, 4), T.DecimalType(18, 4)),
        ("NUMERIC", T.DecimalType(18, 2), T.DecimalType(18, 2)),
        ("DATE", T.DateType(), T.IntegerType()),
        ("TIMESTAMP", T.TimestampType(), T.LongType()),
        ("TIMESTAMP(6)", T.TimestampType(), T.LongType()),
        ("VARCHAR(20)", T.StringType(), T.StringType()),
        ("UUID", T.StringType(), T.StringType()),
        ("JSONB", T.StringType(), T.StringType()),
    ],
)
def test_types(declared, stored, leaf):
    assert spark_type(declared) == stored
    assert leaf_type(declared) == leaf


@pytest.mark.parametrize(
    "change, part",
    [
        ({"primary_key": "nope"}, "primary key"),
        ({"update_columns": ["nope"]}, "update_columns"),
        ({"low_cardinality": ["nope"]}, "low_cardinality"),
        ({"partition_column": "nope"}, "not a column"),
        ({"partition_column": "label"}, "must be TIMESTAMP or DATE"),
        ({"update_columns": ["made"]}, "may not be updated"),
        ({"columns": {**GOOD["columns"], "shape": "GEOMETRY"}}, "unsupported type GEOMETRY"),
    ],
)
def test_manifest_rules(change, part):
    with pytest.raises(ValueError, match=part):
        load_specs(broken(**change))


def test_manifest_files(tmp_path):
    as_json, as_yaml = tmp_path / "m.json", tmp_path / "m.yml"
    as_json.write_text(json.dumps({"tables": {"t": GOOD}}))
    yaml = pytest.importorskip("yaml")
    as_yaml.write_text(yaml.safe_dump({"tables": {"t": GOOD}}, sort_keys=False))
    assert load_manifest(str(as_json)) == load_manifest(str(as_yaml))


def test_catalog():
    assert list(CATALOG) == ["customers", "products", "orders", "order_items"]
    orders = CATALOG["orders"]
    assert orders.topic() == "cdc.public.orders"
    assert not orders.schema["order_id"].nullable and orders.schema["status"].nullable
    assert isinstance(orders, TableSpec) and orders.update_columns == ("total_amount", "status", "updated_at")
