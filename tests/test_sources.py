import contextlib
import io
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from brookmark.plans.warehouse import ingest, raw_table
from brookmark.operators.merge import UniqueViolation
from brookmark.sources import extract as X
from brookmark.sources.bronze import read_bronze_day, read_bronze_history, write_bronze
from brookmark.sources.files import delete_listed, list_files
from brookmark.sources.tables import SlotTable, SnapshotTable, create_table, merge_into_catalog, silver_upsert
from brookmark.specs import CATALOG

ORDERS, CUSTOMERS = CATALOG["orders"], CATALOG["customers"]
T0 = datetime(2024, 1, 1)


def order(key, status="pending", at=T0, amount="10.00"):
    from decimal import Decimal

    return (key, 1, T0, Decimal(amount), status, T0, at)


def orders(spark, *rows):
    nullable = ORDERS.schema
    for field in nullable.fields:
        field.nullable = True
    return spark.createDataFrame(list(rows), nullable)


def text_of(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_schema_guard_names_every_missing_column(spark):
    old = spark.createDataFrame([(1, "Ada L", "a@x")], "customer_id long, name string, email string")
    with pytest.raises(X.SchemaMismatch) as error:
        X.check_schema(old, CUSTOMERS)
    for column in ("first_name", "last_name", "address", "updated_at"):
        assert column in str(error.value)
    with pytest.raises(X.SchemaMismatch, match="does not exist"):
        X.extract(spark, CUSTOMERS, lambda s, spec: s.table("no_such_table"))


def test_null_keys_are_rejected(spark):
    bad = orders(spark, order(1), order(None))
    with pytest.raises(X.NullKey):
        X.assert_pk_not_null(bad, ORDERS)
    X.assert_pk_not_null(orders(spark, order(1)), ORDERS)
    with pytest.raises(PySparkException, match="null order_id"):
        X.guard_keys(bad, ORDERS).collect()


def test_incremental_is_strict_and_precise(spark):
    mark = T0 + timedelta(microseconds=5)
    target = orders(spark, order(1, at=T0), order(2, at=mark))
    source = orders(
        spark, order(2, at=mark), order(3, at=mark + timedelta(microseconds=1)), order(4, at=T0)
    )
    fresh = X.extract_incremental(source, target, ORDERS)
    assert [r.order_id for r in fresh.collect()] == [3]
    late = X.extract_incremental(source, target, ORDERS, overlap=timedelta(microseconds=1))
    assert {r.order_id for r in late.collect()} == {2, 3}


@pytest.mark.parametrize("target", ["none", "empty", "no cursor"])
def test_no_mark_means_full_extract(spark, target):
    frames = {"none": None, "empty": orders(spark), "no cursor": orders(spark, order(1)).drop("updated_at")}
    source = orders(spark, order(1), order(2))
    assert X.extract_incremental(source, frames[target], ORDERS).count() == 2


def test_mark_reaches_the_scan(spark, tmp_path):
    orders(spark, order(1), order(2, at=T0 + timedelta(days=1))).write.parquet(str(tmp_path / "o"))
    source = spark.read.schema(ORDERS.schema).parquet(str(tmp_path / "o"))
    plan = text_of(X.extract_incremental(source, orders(spark, order(1)), ORDERS))
    assert "GreaterThan(updated_at" in plan


def test_jdbc_reader_is_lazy_about_drivers(spark):
    reader = X.jdbc_reader("jdbc:none://host/db", 1, 100, 4, user="u")
    with pytest.raises(Exception):
        reader(spark, ORDERS)


def test_bronze_runs(spark, tmp_path):
    root = str(tmp_path)
    morning, noon = datetime(2024, 3, 1, 6), datetime(2024, 3, 1, 12)
    loaded = write_bronze(orders(spark, order(1), order(2)), root, ORDERS, morning)
    assert loaded.get["rows_synced"] == 2
    write_bronze(orders(spark, order(3)), root, ORDERS, noon)
    write_bronze(orders(spark, order(1)), root, ORDERS, morning)  # a retry replaces itself
    day = read_bronze_day(spark, root, ORDERS, "20240301")
    assert sorted(r.order_id for r in day.collect()) == [1, 3]
    assert read_bronze_day(spark, root, ORDERS, "20240302").isEmpty()
    assert "PartitionFilters: [isnotnull(ingest_date" in text_of(day)
    assert read_bronze_history(spark, root, ORDERS).count() == 2
    assert read_bronze_history(spark, root, CUSTOMERS).isEmpty()  # never written
    assert read_bronze_day(spark, root, CUSTOMERS).isEmpty()


def test_ingest_keeps_columns_that_may_not_change(spark, tmp_path):
    root = str(tmp_path)
    assert ingest(spark, orders(spark, order(1), order(2)), root, ORDERS, T0) == 2
    later = T0 + timedelta(days=1)
    changed = orders(spark, (1, 99, later, None, "shipped", later, later), order(2), order(3, at=later))
    assert ingest(spark, changed, root, ORDERS, later) == 2
    rows = {r.order_id: r for r in raw_table(spark, root, ORDERS).read().collect()}
    assert (rows[1].customer_id, rows[1].order_date, rows[1].created_at) == (1, T0, T0)
    assert (rows[1].status, rows[1].total_amount, rows[1].updated_at) == ("shipped", None, later)
    assert set(rows) == {1, 2, 3}
    assert ingest(spark, changed, root, ORDERS, later + timedelta(hours=1)) == 0


def customer(key, email, at=T0):
    return (key, "a", "b", email, "s", "c", "st", "z", T0, at)


def test_unique_email_fails_the_batch_before_it_is_merged(spark, tmp_path):
    root, schema = str(tmp_path), CUSTOMERS.schema
    ingest(spark, spark.createDataFrame([customer(1, "x"), customer(2, "y")], schema), root, CUSTOMERS, T0)
    later = T0 + timedelta(days=1)
    swapped = [customer(1, "y", later), customer(2, "x", later)]
    ingest(spark, spark.createDataFrame(swapped, schema), root, CUSTOMERS, later)  # fine: both move
    later += timedelta(days=1)
    clash = spark.createDataFrame([customer(3, "x", later)], schema)
    with pytest.raises(UniqueViolation):
        ingest(spark, clash, root, CUSTOMERS, later)
    assert raw_table(spark, root, CUSTOMERS).read().count() == 2


def test_slot_table_rewrites_only_touched_slots(spark, tmp_path):
    table = SlotTable(spark, str(tmp_path / "t"), "order_id", width=10)
    table.merge(orders(spark, *[order(k) for k in range(40)]), ORDERS.update_columns)
    before = {r.path: r.modified_at for r in list_files(spark, table.path).collect()}
    table.merge(
        orders(spark, order(12, "shipped", T0 + timedelta(days=1)), order(45, at=T0)), ORDERS.update_columns
    )
    after = {r.path: r.modified_at for r in list_files(spark, table.path).collect()}
    kept = before.keys() & after.keys()
    assert {p.split("slot=")[1][0] for p in kept} == {"0", "2", "3"}
    rows = {r.order_id: r.status for r in table.read().collect()}
    assert len(rows) == 41 and rows[12] == "shipped" and rows[13] == "pending"
    table.merge(orders(spark, order(12, "pending", T0)), ORDERS.update_columns)  # older: ignored
    assert {r.order_id: r.status for r in table.read().collect()}[12] == "shipped"
    table.merge(orders(spark, order(12, "pending", T0)), ORDERS.update_columns, version=None)
    assert {r.order_id: r.status for r in table.read().collect()}[12] == "pending"


def test_text_keys_use_hashed_slots(spark, tmp_path):
    table = SlotTable(spark, str(tmp_path / "t"), "k", slots=4)
    frame = spark.createDataFrame([(f"k{i}", i) for i in range(50)], "k string, v int")
    table.merge(frame, ("v",), version=None)
    table.merge(frame.withColumn("v", F.col("v") + 1), ("v",), version=None)
    assert table.read().agg(F.sum("v")).first()[0] == sum(range(1, 51))


def test_snapshot_table_versions(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    table.commit(spark.range(3))
    table.commit(table.read().where("id > 0"))  # reads one version while writing the next
    spark.range(9).write.parquet(table.folder(2))  # a job that died before its commit
    assert table.read().count() == 2 and table.read(0).count() == 3
    assert table.commits().count() == 2 and table.current() == 1
    assert table.commit(spark.range(5)) == 2 and table.read().count() == 5


def test_snapshot_merge_is_all_or_nothing(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    later = T0 + timedelta(days=1)
    assert table.merge(orders(spark, order(1), order(2)), "order_id", ORDERS.update_columns) == 0
    assert table.merge(orders(spark, order(2, "shipped", later), order(3)), "order_id", ORDERS.update_columns) == 1
    poisoned = orders(spark, order(4)).withColumn("status", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(PySparkException, match="lost"):
        table.merge(poisoned, "order_id", ORDERS.update_columns)
    assert {r.order_id: r.status for r in table.read().collect()} == {1: "pending", 2: "shipped", 3: "pending"}


def test_failed_slot_merge_leaves_the_table_as_it_was(spark, tmp_path):
    table = SlotTable(spark, str(tmp_path / "t"), "order_id", width=10)
    table.merge(orders(spark, *[order(k) for k in range(30)]), ORDERS.update_columns)
    before = sorted(map(tuple, table.read().collect()))
    status = F.when(F.col("order_id") == 25, F.raise_error(F.lit("lost")).cast("string")).otherwise("shipped")
    poisoned = orders(spark, *[order(k, at=T0 + timedelta(days=1)) for k in range(30)]).withColumn("status", status)
    with pytest.raises(PySparkException, match="lost"):
        table.merge(poisoned, ORDERS.update_columns)
    assert sorted(map(tuple, table.read().collect())) == before


def test_silver_upsert_creates_then_needs_row_level_operations(spark):
    rows = orders(spark, order(1), order(2, "shipped"))
    assert not silver_upsert(rows.limit(0), "silver.orders", "order_id", ("status",), "status")
    assert silver_upsert(rows, "silver.orders", "order_id", ("status",), "status")
    assert spark.table("silver.orders").count() == 2
    # plain parquet tables have no MERGE; SlotTable is the way there
    with pytest.raises(PySparkException, match="UNSUPPORTED_FEATURE.TABLE_OPERATION"):
        merge_into_catalog(rows, "silver.orders", "order_id", ("status",))
    create_table(rows, "silver.plain")
    assert spark.table("silver.plain").count() == 2


def test_explicit_deletion(spark, tmp_path):
    spark.range(4).repartition(2).write.parquet(str(tmp_path / "d"))
    files = list_files(spark, str(tmp_path / "d"))
    assert files.count() == 2 and delete_listed(spark, files.limit(1)) == 1
    assert list_files(spark, str(tmp_path / "d")).count() == 1
