import json
from datetime import datetime

import pytest

from brookmark.plans.adhoc import bounded_query
from brookmark.plans.lakehouse import transform_all
from brookmark.plans.layers import publish, publish_mirror
from brookmark.plans.warehouse import ingest_all
from brookmark.operators.catalog import column_catalog, filter_catalog, schema_overview
from brookmark.sources.fixture import operational
from brookmark.specs import CATALOG
from brookmark.streaming.cdc import parse_cdc
from brookmark.streaming.mirror import Mirror

SPEC = CATALOG["orders"]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("layers"))
    ingest_all(spark, operational(spark, "/root/testdata/sf0.001"), folder, datetime(2024, 1, 1))
    transform_all(spark, folder, "20240101")
    publish(spark, folder)
    return folder


def test_lake_and_raw_answer_sql(spark, root):
    answer = bounded_query(spark, "SELECT status, count(*) AS n, sum(total_amount) FROM lake.orders GROUP BY status;")
    assert answer.rows.count() == 5
    assert spark.table("raw.orders_source").count() == 1500
    latest = "SELECT order_id, status, updated_at FROM lake.orders ORDER BY updated_at DESC, order_id DESC LIMIT 5"
    assert bounded_query(spark, latest).rows.count() == 5


def test_mirror_views_follow_the_log(spark, root):
    mirror = Mirror(spark, f"{root}/mirror", SPEC)

    def send(number, *messages):
        raw = spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")
        mirror.append(parse_cdc(raw, SPEC), number)

    send(0, *[{"op": "c", "after": {"order_id": k, "status": "pending"}, "ts_ms": 1} for k in range(4)])
    publish_mirror(spark, mirror)
    query = "SELECT status, count(*) AS n FROM mirror.orders_current GROUP BY status ORDER BY n DESC, status"
    assert [tuple(r) for r in bounded_query(spark, query).rows.collect()] == [("pending", 4)]
    send(1, {"op": "u", "after": {"order_id": 1, "status": "shipped"}, "ts_ms": 2},
         {"op": "d", "before": {"order_id": 2}, "ts_ms": 2})
    assert [tuple(r) for r in bounded_query(spark, query).rows.collect()] == [("pending", 2), ("shipped", 1)]
    mirror.compact()
    publish_mirror(spark, mirror)
    assert [tuple(r) for r in bounded_query(spark, query).rows.collect()] == [("pending", 2), ("shipped", 1)]
    same = sorted(map(tuple, mirror.current().collect()))
    assert sorted(map(tuple, spark.table("mirror.orders_current").collect())) == same
    assert "ver" not in spark.table("mirror.orders_current").columns


def test_catalog_covers_the_layers(spark, root):
    listed = column_catalog(spark, ["raw", "lake", "nowhere"])
    names = {r.table_name for r in schema_overview(listed).collect()}
    assert {"raw.orders_source", "lake.orders", "lake.customers"} <= names
    assert filter_catalog(listed, ["lake"], "order%").select("table_name").distinct().count() >= 2


def test_ddl(spark):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS staging")
    spark.sql(SPEC.ddl("staging"))
    assert spark.table("staging.orders_source").columns == SPEC.column_names
    assert "order_id bigint NOT NULL" in SPEC.ddl()
