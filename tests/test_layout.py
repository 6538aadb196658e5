"""Digests of key ranges, bucketed merges, followed counts and footer bounds; plans where the plan is the point."""

import json

import pytest
from pyspark.sql import functions as F

from brookmark.operators.digests import _within, compare_digests, range_digests, reconcile_by_digest
from brookmark.operators.merge import merge_upsert
from brookmark.operators.quality import Check, run_checks
from brookmark.operators.reconcile import reconcile
from brookmark.sources.buckets import BucketTable
from brookmark.sources.footers import bounds
from brookmark.specs import CATALOG
from brookmark.streaming.cdc import parse_cdc
from brookmark.streaming.counts import FollowedCounts
from brookmark.streaming.mirror import Mirror, MonthMirror

SPEC = CATALOG["orders"]
COLS = ["a", "b"]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "k long, a string, b string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("listed", [1000, 0])
def test_digests_find_every_planted_difference(spark, listed):
    rows = [(k, f"a{k}", None if k % 3 else f"b{k}") for k in range(-200, 2000)]
    other = dict((r[0], r) for r in rows)
    other[5] = (5, "a5", "changed")
    other[700] = (700, None, "a700")  # a value moved over a NULL
    del other[-200], other[1999]
    other[5000] = (5000, "x", "y")
    src, dst = pairs(spark, rows), pairs(spark, list(other.values()))
    want = reconcile(src, dst, "k", COLS).first()
    got = reconcile_by_digest(src, dst, "k", COLS, (512, 64, 8), listed).first()
    assert tuple(got) == tuple(want) == (2200, 2199, 2196, 2, 1, 2)


def test_equal_replicas_are_told_from_digests(spark):
    src = pairs(spark, [(k, "x", None) for k in range(1000)])
    digests = range_digests(src, "k", COLS, 256), range_digests(src.repartition(5), "k", COLS, 256)
    assert compare_digests(*digests).where("not same").count() == 0 and digests[0].count() == 4
    nothing = src.where("k < 0")
    found = reconcile_by_digest(nothing, nothing, "k", COLS, (256,), digests=digests)  # no row is asked for
    assert tuple(found.first()) == (1000, 1000, 1000, 0, 0, 0)
    assert tuple(reconcile_by_digest(nothing, nothing, "k", COLS).first()) == (0,) * 6


def test_few_ranges_reach_the_scan(spark, tmp_path):
    pairs(spark, [(k, "x", None) for k in range(1000)]).write.parquet(f"{tmp_path}/t")
    ranges = spark.createDataFrame([(1,), (2,), (7,)], "range long")
    rows = _within(spark.read.parquet(f"{tmp_path}/t"), "k", ranges, 100, 10)
    assert rows.count() == 300 and "GreaterThanOrEqual(k,100)" in plan_of(rows)


def test_bucketed_merge_leaves_the_stored_side_where_it_is(spark, tmp_path):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS bucketed")
    table = BucketTable(spark, "bucketed.pairs", str(tmp_path), "k", 4)
    first, second = pairs(spark, [(k, "x", "y") for k in range(100)]), pairs(spark, [(k, "new", None) for k in range(90, 120)])
    assert table.version() is None
    table.merge(first, ("a",), version=None)
    merged = table.merged(second, ("a",), version=None)
    with_plan = plan_of(merged)
    assert with_plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in with_plan
    want = sorted(map(tuple, merge_upsert(first, second, "k", ("a",)).collect()))
    assert sorted(map(tuple, merged.collect())) == want
    assert table.merge(second, ("a",), version=None) == 1
    assert sorted(map(tuple, spark.table("bucketed.pairs").collect())) == want
    assert table.merge(second, ("a",), version=None) == 2 and table.version() == 2
    assert sorted(map(tuple, table.read().collect())) == want
    (tmp_path / "v3").mkdir()  # a version that was never finished
    assert table.version() == 2 and table.merge(second, ("a",), version=None) == 3


MAY = 1_714_521_600_000_000


@pytest.mark.parametrize("kind", [Mirror, MonthMirror])
def test_followed_counts_equal_a_recount(spark, tmp_path, kind):
    """Deletes, late old versions, unchanged rows, repeated batches and compactions in between."""
    mirror = kind(spark, str(tmp_path), SPEC, width=3)
    counts = FollowedCounts(mirror, "status")

    def row(key, status, ts):
        return {"op": "u", "after": {"order_id": key, "status": status, "created_at": MAY}, "ts_ms": ts}

    def gone(key, ts):
        return {"op": "d", "before": {"order_id": key}, "ts_ms": ts}

    batches = [
        [row(1, "pending", 1), row(2, "pending", 1), row(3, None, 1), row(9, "pending", 1)],
        [row(1, "shipped", 2), gone(2, 5), row(2, "late", 3), row(3, None, 2), gone(77, 4)],
        [row(1, "old", 1), row(2, "back", 6), row(77, "hidden", 2), row(3, "shipped", 3), gone(9, 9), gone(9, 8)],
    ]
    assert counts.counts().count() == 0
    for number, messages in enumerate(batches):
        batch = parse_cdc(spark.createDataFrame([(json.dumps(m),) for m in messages], "value string"), SPEC, nulls="keep")
        counts.append(batch, number)
        counts.append(batch, number)  # run again
        recount = mirror.current().groupBy("status").agg(F.count(F.lit(1)).alias("rows"))
        assert sorted(map(tuple, counts.counts().collect()), key=repr) == sorted(map(tuple, recount.collect()), key=repr)
        if number == 1:
            mirror.compact()
    assert sorted(map(tuple, counts.counts().collect())) == [("back", 1), ("shipped", 2)]


def test_bounds_come_from_footers(spark, tmp_path):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day")
    spark.range(5, 905).select("id", day).repartition(3).write.parquet(f"{tmp_path}/t")
    found = bounds(spark, f"{tmp_path}/t", "id", "day")
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(day), MAX(day)]" in plan_of(found)
    row = found.first()
    assert (row.row_count, row.id_low, row.id_high, str(row.day_low)) == (900, 5, 904, "2024-01-06")
    assert "csv" in (spark.conf.get("spark.sql.sources.useV1SourceList"))  # the setting is as it was


def test_all_checks_of_a_table_read_it_once(spark, tmp_path):
    """Unique, reference and row checks of a table and of its parent in one scan each."""
    spark.createDataFrame([(1, 7, 2.0), (1, 8, -1.0), (2, None, 3.0), (None, 9, None)], "id long, ref int, v double").write.parquet(str(tmp_path / "child"))
    spark.createDataFrame([(7,), (7,), (8,)], "key long").write.parquet(str(tmp_path / "parent"))
    frames = {n: spark.read.parquet(str(tmp_path / n)) for n in ("child", "parent")} | {"empty": spark.createDataFrame([], "x int")}
    checks = [
        Check("child", "id", "unique"), Check("child", "id", "not_null"), Check("child", "v", "range", minimum=0),
        Check("child", "ref", "relationships", parent="parent", parent_column="key"), Check("parent", "key", "unique"),
        Check("child", "ref", "relationships", parent="absent", parent_column="key"), Check("empty", "x", "unique"),
        Check("absent", "x", "not_null"), Check("absent", "*", "populated"), Check("empty", "*", "populated"), Check("parent", "*", "populated"),
        Check("child", "v", "unique"),
    ]
    report = run_checks(spark, frames, checks)
    found = [(r.table_name, r.check_name, r.failures, r.status) for r in report.collect()]
    assert sorted(found) == sorted([
        ("child", "unique", 1, "FAIL"), ("child", "not_null", 1, "FAIL"), ("child", "range", 1, "FAIL"),
        ("child", "relationships", 1, "FAIL"), ("parent", "unique", 1, "FAIL"), ("child", "relationships", 0, "SKIP"),
        ("empty", "unique", 0, "SKIP"), ("absent", "not_null", 0, "SKIP"), ("absent", "populated", 1, "FAIL"),
        ("empty", "populated", 1, "FAIL"), ("parent", "populated", 0, "PASS"), ("child", "unique", 0, "PASS"),
    ])
    one = run_checks(spark, frames, [c for c in checks if c.kind != "populated" and c.table != "empty" and "absent" not in (c.table, c.parent)])
    assert one._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 4  # two tables, each also behind its row count


def test_the_registered_bounds_read_no_row(spark):
    from brookmark.workload import all_queries

    found = all_queries()["footer_bounds"](spark, "/root/testdata/sf0.001")
    assert plan_of(found).count("PushedAggregation: [COUNT(*)") == 3
