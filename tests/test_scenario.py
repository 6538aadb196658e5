"""A batch of changes end to end: 200 orders, 40 moved on, 10 cancelled, 5 deleted."""

import json
from datetime import datetime, timedelta
from decimal import Decimal

from brookmark.operators.quality import replica_checks
from brookmark.plans.lakehouse import silver_table, transform_all, transform_day
from brookmark.plans.warehouse import ingest, ingest_all, raw_table
from brookmark.specs import CATALOG
from brookmark.streaming.cdc import parse_cdc
from brookmark.streaming.mirror import Mirror

SPEC = CATALOG["orders"]
T0 = datetime(2024, 4, 1)
MICROS = 1_711_929_600_000_000


def row(key, status, at):
    return (key, key % 7 + 1, T0, Decimal(key) + 1, status, T0, at)


def image(key, status, hours):
    return {"order_id": key, "customer_id": key % 7 + 1, "order_date": MICROS, "total_amount": float(key + 1),
            "status": status, "created_at": MICROS, "updated_at": MICROS + hours * 3_600_000_000}


def test_transactions(spark, tmp_path):
    root, later = str(tmp_path), T0 + timedelta(hours=1)
    seed = {k: "pending" for k in range(200)}
    moved = {k: ("shipped" if k % 2 else "delivered") for k in range(40)}
    cancelled = {k: "cancelled" for k in range(40, 50)}
    deleted = range(50, 55)
    final = {k: v for k, v in {**seed, **moved, **cancelled}.items() if k not in deleted}

    before = spark.createDataFrame([row(k, s, T0) for k, s in seed.items()], SPEC.schema)
    changed = {**moved, **cancelled}
    after = spark.createDataFrame([row(k, s, later if k in changed else T0) for k, s in final.items()], SPEC.schema)

    # warehouse and lake: two incremental runs; deletes are never applied there
    assert ingest(spark, before, root, SPEC, T0) == 200
    assert ingest(spark, after, root, SPEC, later) == 50
    merge_only = {**seed, **changed}
    assert {r.order_id: r.status for r in raw_table(spark, root, SPEC).read().collect()} == merge_only
    assert transform_day(spark, root, SPEC, "20240401")
    lake = silver_table(spark, root, SPEC)
    assert {r.order_id: r.status for r in lake.read().collect()} == merge_only
    assert transform_day(spark, root, SPEC, "20240401")  # a rerun changes nothing
    assert {r.order_id: r.status for r in lake.read().collect()} == merge_only
    assert not transform_day(spark, root, SPEC, "20240402")  # nothing landed

    # mirror: the same changes as a log, with deletes
    mirror = Mirror(spark, f"{root}/mirror", SPEC)
    logs = [
        [{"op": "r", "after": image(k, s, 0), "ts_ms": 1} for k, s in seed.items()],
        [{"op": "u", "after": image(k, s, 1), "ts_ms": 2} for k, s in changed.items()]
        + [{"op": "d", "before": {"order_id": k}, "ts_ms": 3} for k in deleted],
    ]
    for number, messages in enumerate(logs):
        raw = spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")
        mirror.append(parse_cdc(raw, SPEC), number)
    gone = spark.createDataFrame([(k,) for k in deleted], "order_id long")
    expected = after.where("status = 'cancelled'")
    report = replica_checks(after, mirror.current(), "order_id", gone, expected)
    assert {r.status for r in report.collect()} == {"PASS"}
    assert {r.order_id: r.status for r in mirror.current().collect()} == final


def test_tables_load_side_by_side(spark, tmp_path):
    from brookmark.sources.fixture import operational

    root = str(tmp_path)
    sources = operational(spark, "/root/testdata/sf0.001")
    synced = ingest_all(spark, sources, root, T0)
    assert synced["orders"] == 1500 and set(synced) == set(CATALOG)
    assert transform_all(spark, root, "20240401") == {n: True for n in CATALOG}
    for name in ("customers", "products", "order_items"):
        assert silver_table(spark, root, CATALOG[name]).read().count() == synced[name]
