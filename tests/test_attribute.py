"""Silver tables in attribute folders: moving rows, pruning, and merges that stop half way; rejected rows."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmark.operators.merge import merge_upsert
from brookmark.plans import lakehouse
from brookmark.plans.lakehouse import read_rejects, silver_table, transform_day
from brookmark.plans.layers import publish
from brookmark.sources.attribute import AttributeTable
from brookmark.sources.bronze import write_bronze
from brookmark.sources.files import Folders
from brookmark.specs import CATALOG

SCHEMA = "id long, kind string, n int, at int"
UPDATED = ("kind", "n", "at")
DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CATALOG["orders"].schema.fields)


def table(spark, path, **more):
    return AttributeTable(spark, str(path), "id", "kind", T.StructType.fromDDL(SCHEMA), width=10, **more)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


FIRST = [(i, ("a", "b", None, "", "=x", "c/d e")[i % 6], i, 1) for i in range(40)]
SECOND = [(i, "b", 100 + i, 2) for i in range(0, 40, 3)] + [(0x99, "new", 1, 2), (1, "", 5, 0), (2, None, 7, 2)]


def test_rows_move_with_their_attribute(spark, tmp_path):
    own, plain = table(spark, tmp_path), frame(spark, FIRST)
    assert own.read_or_none() is None
    own.merge(plain, UPDATED, "at")
    assert rows_of(own.read()) == rows_of(plain)
    own.merge(frame(spark, SECOND), UPDATED, "at")
    want = merge_upsert(plain, frame(spark, SECOND), "id", UPDATED, "at")
    assert rows_of(own.read()) == rows_of(want)
    # every key lies in one folder, and the map says in which
    assert own.read().count() == own.read().select("id").distinct().count()
    assert rows_of(own.places_of(frame(spark, SECOND))) == rows_of(want.join(frame(spark, SECOND), "id", "left_semi").select("id", "kind"))
    own.merge(frame(spark, SECOND), UPDATED, "at")  # again: nothing changes
    assert rows_of(own.read()) == rows_of(want)
    for kind in ("a", "", "=x", "c/d e"):
        assert rows_of(own.read().where(F.col("kind") == kind)) == rows_of(want.where(F.col("kind") == kind))
    assert own.read().where("kind is null").count() == want.where("kind is null").count()


def test_a_folder_that_loses_its_last_row_goes(spark, tmp_path):
    own = table(spark, tmp_path)
    own.merge(frame(spark, [(1, "a", 1, 1), (11, "a", 1, 1)]), UPDATED, "at")
    own.merge(frame(spark, [(1, "b", 1, 2)]), UPDATED, "at")
    assert Folders(spark, str(tmp_path)).listed("", 2) == ["kind=a/slot=1", "kind=b/slot=0"]
    own.merge(frame(spark, []), UPDATED, "at")
    assert rows_of(own.read()) == [(1, "b", 1, 2), (11, "a", 1, 1)]


def test_only_the_folders_of_the_batch_are_opened(spark, tmp_path):
    own = table(spark, tmp_path)
    own.merge(frame(spark, [(i, "abc"[i // 10 % 3], i, 1) for i in range(60)]), UPDATED, "at")
    before = {f: p.stat().st_mtime_ns for f in Folders(spark, str(tmp_path)).listed("", 2) for p in (tmp_path / f).iterdir() if p.suffix == ".parquet"}
    own.merge(frame(spark, [(3, "c", 0, 2)]), UPDATED, "at")
    after = {f: p.stat().st_mtime_ns for f in Folders(spark, str(tmp_path)).listed("", 2) for p in (tmp_path / f).iterdir() if p.suffix == ".parquet"}
    assert {f for f in after if after[f] != before.get(f)} == {"kind=a/slot=0", "kind=c/slot=0"}
    files = own.read().where("kind = 'a'").inputFiles()
    plan = own.read().where("kind = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert files and "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_the_map_changes_only_where_a_key_is_new_or_moves(spark, tmp_path):
    own = table(spark, tmp_path)
    own.merge(frame(spark, [(i, "ab"[i % 2], i, 1) for i in range(30)]), UPDATED, "at")
    files = lambda: {p.parent.name: p.name for p in (tmp_path / "_keys").rglob("*.parquet")}
    before = files()
    own.merge(frame(spark, [(i, "ab"[i % 2], 100 + i, 2) for i in range(30)]), UPDATED, "at")  # none moves
    assert files() == before and {r.n - r.id for r in own.read().collect()} == {100}
    own.merge(frame(spark, [(1, "a", 0, 3), (2, "a", 0, 3), (25, "b", 0, 3)]), UPDATED, "at")
    assert {s for s, name in files().items() if name != before[s]} == {"slot=0"}
    assert own.places_of(own.read()).count() == 30
    kinds = {r.id: r.kind for r in own.read().collect()}
    assert {r.id: r.value for r in own.places_of(own.read()).collect()} == kinds == {i: "a" if i == 1 else "ab"[i % 2] for i in range(30)}


@pytest.mark.parametrize("moved", [None, 0, 1, 3, 99])
def test_a_merge_that_stops_is_finished_or_dropped(spark, tmp_path, monkeypatch, moved):
    """The driver stops before the plan is written (None) or after so many moves."""
    own = table(spark, tmp_path)
    own.merge(frame(spark, FIRST), UPDATED, "at")
    want = merge_upsert(frame(spark, FIRST), frame(spark, SECOND), "id", UPDATED, "at")

    class Stop(Exception):
        pass

    done = [0]
    plain_move = Folders.move

    def move(self, name, to):
        if done[0] == moved:
            raise Stop
        done[0] += 1
        plain_move(self, name, to)

    def write_text(self, name, text):
        raise Stop

    with monkeypatch.context() as patch:
        patch.setattr(Folders, "move", move)
        if moved is None:
            patch.setattr(Folders, "write_text", write_text)
        try:
            own.merge(frame(spark, SECOND), UPDATED, "at")
        except Stop:
            pass
    found = rows_of(table(spark, tmp_path).read())
    assert found == rows_of(frame(spark, FIRST) if moved is None else want)
    own.merge(frame(spark, SECOND), UPDATED, "at")
    assert rows_of(own.read()) == rows_of(want)


def test_text_keys(spark, tmp_path):
    schema = "id string, kind string, n int, at int"
    own = AttributeTable(spark, str(tmp_path), "id", "kind", T.StructType.fromDDL(schema), slots=3)
    rows = [(f"k{i}", "ab"[i % 2], i, 1) for i in range(20)]
    own.merge(spark.createDataFrame(rows, schema), UPDATED, "at")
    own.merge(spark.createDataFrame([("k0", "b", 9, 2), ("k1", "b", 9, 0)], schema), UPDATED, "at")
    assert rows_of(own.read()) == sorted([("k0", "b", 9, 2), *rows[1:]], key=repr)


def test_published_lake_prunes_by_status(spark, tmp_path):
    spec, root = CATALOG["orders"], str(tmp_path)
    start = datetime(2024, 5, 1)
    rows = [(i, 1, start, None, "pending", start, start) for i in range(6)]
    batch = spark.createDataFrame(rows, spec.schema).withColumn("total_amount", F.lit("1.50").cast("decimal(18,2)"))
    write_bronze(batch, f"{root}/bronze", spec, start)
    write_bronze(batch.where("order_id < 2").withColumn("status", F.lit("shipped")).withColumn("updated_at", F.lit(start + timedelta(days=1))),
                 f"{root}/bronze", spec, start + timedelta(days=1))
    assert transform_day(spark, root, spec, "20240501") and transform_day(spark, root, spec, "20240502")
    publish(spark, root)
    shipped = spark.sql("SELECT order_id FROM lake.orders WHERE status = 'shipped'")
    assert sorted(r[0] for r in shipped.collect()) == [0, 1]
    assert "PartitionFilters: []" not in shipped._jdf.queryExecution().executedPlan().toString()
    assert spark.sql("SELECT status, count(*) FROM lake.orders GROUP BY status").count() == 2


def test_rejects_are_kept_by_day(spark, tmp_path, monkeypatch):
    """Two runs of the default day on two days keep the rejects of both; a rerun without any clears its day."""
    spec, root = CATALOG["orders"], str(tmp_path)

    def landed(day, rows):
        batch = spark.createDataFrame([(k, 1, day, None, "pending", day, day) for k in rows], DDL)
        write_bronze(batch.withColumn("total_amount", F.lit("1.50").cast("decimal(18,2)")), f"{root}/bronze", spec, day)

    class Clock(date):
        now = date(2024, 5, 1)

        @classmethod
        def today(cls):
            return cls.now

    monkeypatch.setattr(lakehouse, "date", Clock)
    landed(datetime(2024, 5, 1), [1, None, None])
    landed(datetime(2024, 5, 2), [2, None])
    assert transform_day(spark, root, spec)
    Clock.now = date(2024, 5, 2)
    assert transform_day(spark, root, spec)
    count = lambda: {str(r[0]): r[1] for r in read_rejects(spark, root, spec).groupBy("ingest_date").count().collect()}
    assert count() == {"2024-05-01": 2, "2024-05-02": 1}
    assert sorted(r.order_id for r in silver_table(spark, root, spec).read().collect()) == [1, 2]
    landed(datetime(2024, 5, 2), [2, 3])
    assert transform_day(spark, root, spec)
    assert count() == {"2024-05-01": 2}
    Clock.now = date(2024, 5, 3)
    assert not transform_day(spark, root, spec)
    assert json.dumps(count()) == '{"2024-05-01": 2}'
