"""Loads by their ledger, unique columns by their index."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brookmark.operators.merge import UniqueViolation, batch_conflicts
from brookmark.plans import warehouse
from brookmark.plans.warehouse import ingest, raw_table
from brookmark.sources import extract
from brookmark.sources.fixture import customers
from brookmark.sources.ledger import LoadLedger
from brookmark.sources.tables import SlotTable
from brookmark.sources.unique import UniqueIndex
from brookmark.specs import CATALOG

ORDERS = CATALOG["orders"]
T0 = datetime(2024, 4, 1)


def batch(spark, keys, hours, status="pending"):
    at = T0 + timedelta(hours=hours)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS.schema.fields)
    return spark.createDataFrame([(k, 1, T0, None, status, T0, at) for k in keys], ddl)


def test_the_target_is_not_scanned_for_its_mark(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert ingest(spark, batch(spark, range(5), 0), root, ORDERS, T0) == 5

    def scanned(*_):
        raise AssertionError("the target was scanned")

    monkeypatch.setattr(extract, "high_water_mark", scanned)
    source = batch(spark, range(5), 0).unionByName(batch(spark, range(3, 8), 2, "shipped"))
    assert ingest(spark, source, root, ORDERS, T0 + timedelta(hours=2)) == 5
    assert ingest(spark, source, root, ORDERS, T0 + timedelta(hours=3)) == 0
    assert ingest(spark, source, root, ORDERS, T0 + timedelta(hours=4), timedelta(hours=1)) == 5  # behind the mark
    runs = sorted((r.run, r.rows_synced) for r in LoadLedger(spark, root).runs().collect())
    assert runs == [(1, 5), (2, 5), (3, 5)]
    assert raw_table(spark, root, ORDERS).read().groupBy("status").count().count() == 2


def test_a_load_that_stops_before_its_entry_is_read_again(spark, tmp_path, monkeypatch):
    root, source = str(tmp_path), batch(spark, range(4), 0)
    with monkeypatch.context() as patch:
        patch.setattr(warehouse.LoadLedger, "record", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            ingest(spark, source, root, ORDERS, T0)
    # no entry: the mark comes from the target, as before there were ledgers
    assert ingest(spark, source.unionByName(batch(spark, [9], 1)), root, ORDERS, T0 + timedelta(hours=1)) == 1
    assert raw_table(spark, root, ORDERS).read().count() == 5


def test_marks_never_fall_and_cut_entries_do_not_count(spark, tmp_path):
    ledger = LoadLedger(spark, str(tmp_path), keep=3)
    assert ledger.mark(ORDERS) is None and ledger.runs().count() == 0
    for mark in (50, 20, None, 70):
        ledger.record(ORDERS, T0, 1, mark)
    assert ledger.mark(ORDERS) == 70
    ledger.folders.write_text("orders/000000000005.json", '{"run": 5, "ma')
    assert ledger.mark(ORDERS) == 70
    assert ledger.folders.files("orders")[0] == "000000000002.json"  # the oldest is gone


def people(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, email string")


def stored_people(spark, path, rows, slots=16):
    table = SlotTable(spark, f"{path}/t", "customer_id", width=10)
    table.write(people(spark, rows))
    index = UniqueIndex(table, "email", slots=slots)
    index.build()
    return table, index


def found(df):
    return sorted((r["email"], r["keys"]) for r in df.collect())


def test_index_finds_what_a_scan_finds(spark, tmp_path):
    table, index = stored_people(spark, tmp_path, [(i, f"m{i}") for i in range(50)] + [(98, None), (99, None)])
    arriving = people(spark, [(3, "m4"), (4, "free"), (5, "m6"), (60, "m7"), (61, "new"), (62, "new"), (63, None)])
    want = found(batch_conflicts(table.read(), arriving, "email", "customer_id"))
    assert found(index.conflicts(arriving)) == want == [("m6", 2), ("m7", 2), ("new", 2)]
    with pytest.raises(UniqueViolation):
        index.check(arriving)


def test_pairs_that_no_longer_hold_are_not_in_the_way(spark, tmp_path):
    table, index = stored_people(spark, tmp_path, [(1, "a"), (2, "b")])
    moved = people(spark, [(1, "c")])
    index.check(moved)
    index.add(moved)  # the job stops here: the table still says a
    assert found(index.conflicts(people(spark, [(7, "c")]))) == []
    assert found(index.conflicts(people(spark, [(7, "a")]))) == [("a", 2)]
    table.merge(moved, ("email",), version=None)
    assert found(index.conflicts(people(spark, [(7, "a")]))) == []
    assert found(index.conflicts(people(spark, [(7, "c")]))) == [("c", 2)]


def test_only_slots_of_the_values_are_opened(spark, tmp_path):
    _, index = stored_people(spark, tmp_path, [(i, f"m{i}") for i in range(400)], slots=64)
    held = index.pairs.touched(people(spark, [(1, "m7")]))
    assert len(set(held.inputFiles())) == 64 and "PartitionFilters: []" not in held._jdf.queryExecution().executedPlan().toString()
    assert held.select(F.input_file_name().alias("f")).distinct().count() == 1


def test_shared_mail_stops_a_load(spark, tmp_path):
    spec, root = CATALOG["customers"], str(tmp_path)
    rows = customers(spark, "/root/testdata/sf0.001")
    assert ingest(spark, rows, root, spec, T0) == rows.count()
    later = rows.withColumn("updated_at", F.col("updated_at") + F.expr("interval 1 day"))
    ingest(spark, later, root, spec, T0 + timedelta(days=1))
    one = later.orderBy("customer_id").limit(2).withColumn("updated_at", F.lit(datetime(2024, 9, 1)))
    with pytest.raises(UniqueViolation):
        ingest(spark, one.withColumn("customer_id", F.col("customer_id") + 1_000_000), root, spec, T0 + timedelta(days=2))
