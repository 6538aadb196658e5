from brookmark.operators.quality import Check, failing_rows, replica_checks, run_checks, verdict
from brookmark.operators.reconcile import compare_rows, reconcile

CHECKS = [
    Check("t", "k", "unique"), Check("t", "k", "not_null"), Check("t", "s", "accepted_values", values=("a", "b")),
    Check("t", "n", "range", minimum=0, maximum=9),
    Check("t", "p", "relationships", parent="parent", parent_column="id"),
]


def report(spark, frames, checks=CHECKS):
    rows = run_checks(spark, frames, checks).collect()
    return {(r.column_name, r.check_name): (r.failures, r.status) for r in rows}


def frames(spark, rows):
    return {
        "t": spark.createDataFrame(rows, "k long, s string, n int, p long"),
        "parent": spark.createDataFrame([(1,), (2,), (2,)], "id long"),
    }


def test_each_check_finds_its_defect(spark):
    bad = [(1, "a", 0, 1), (1, "b", 9, 2), (1, "c", 10, 3), (2, None, -1, 3), (2, "a", None, None), (None, "a", 1, 1)]
    got = report(spark, frames(spark, bad))
    assert got == {
        ("k", "unique"): (2, "FAIL"), ("k", "not_null"): (1, "FAIL"), ("s", "accepted_values"): (1, "FAIL"),
        ("n", "range"): (2, "FAIL"), ("p", "relationships"): (2, "FAIL"),
    }
    for check, expected in zip(CHECKS, (2, 1, 1, 2, 2)):
        assert failing_rows(frames(spark, bad), check).count() == expected


def test_clean_rows_pass(spark):
    got = report(spark, frames(spark, [(1, "a", 0, 1), (2, None, None, None)]))
    assert {v for v in got.values()} == {(0, "PASS")}


def test_what_cannot_run_is_skipped(spark):
    empty = report(spark, frames(spark, []))
    assert {v[1] for v in empty.values()} == {"SKIP"}
    no_parent = {"t": frames(spark, [(1, "a", 0, 1)])["t"]}
    assert report(spark, no_parent)[("p", "relationships")][1] == "SKIP"
    assert {v[1] for v in report(spark, {}).values()} == {"SKIP"}
    partly = run_checks(spark, no_parent, CHECKS)
    assert tuple(verdict(partly).first()) == (4, 0, 1, False)


def test_marts_must_exist_and_hold_rows(spark):
    checks = [Check(n, "*", "populated") for n in ("t", "none", "void")]
    rows = run_checks(spark, {"t": spark.range(1), "void": spark.range(0)}, checks).collect()
    assert {r.table_name: r.status for r in rows} == {"t": "PASS", "none": "FAIL", "void": "FAIL"}


def test_reconcile_is_null_safe(spark):
    schema = "k long, a string, b string"
    src = spark.createDataFrame([(1, None, "x"), (2, "x", None), (3, None, None), (4, "p", "q")], schema)
    dst = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, None, None), (5, "p", "q")], schema)
    row = reconcile(src, dst, "k", ["a", "b"]).first()
    assert tuple(row) == (4, 4, 2, 1, 1, 1)
    assert {r.k: r.verdict for r in compare_rows(src, dst, "k", ["a", "b"]).collect()}[1] == "differing"


def test_empty_replica_is_not_a_pass(spark):
    schema = "k long, status string"
    source = spark.createDataFrame([(1, "cancelled"), (2, "shipped")], schema)
    gone = spark.createDataFrame([(3, "x")], schema)
    expected = source.where("status = 'cancelled'")
    good = {r.check_name: r.status for r in replica_checks(source, source, "k", gone, expected).collect()}
    assert set(good.values()) == {"PASS"}
    none = {r.check_name: r.status for r in replica_checks(source, source.limit(0), "k", gone, expected).collect()}
    assert none == {"row_count": "FAIL", "not_empty": "FAIL", "deletes_applied": "SKIP", "statuses_applied": "SKIP"}
