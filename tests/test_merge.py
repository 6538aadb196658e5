import random

from pyspark.sql import functions as F

from brookmark.operators.merge import latest_by_key, merge_upsert, unique_violations

SCHEMA = "k long, a string, b string, v long"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_matched_unmatched_and_untouched(spark):
    target = spark.createDataFrame([(1, "t", "t", 1), (2, "t", "t", 1)], SCHEMA)
    updates = spark.createDataFrame([(2, "u", "u", 2), (3, "u", "u", 2)], SCHEMA)
    merged = merge_upsert(target, updates, "k", ["a", "v"], version="v")
    assert rows(merged) == [(1, "t", "t", 1), (2, "u", "t", 2), (3, "u", "u", 2)]


def test_null_updates_overwrite_and_null_versions(spark):
    target = spark.createDataFrame([(1, "t", "t", 1), (2, "t", "t", None), (3, "t", "t", 3)], SCHEMA)
    updates = spark.createDataFrame([(1, None, "u", 1), (2, "u", "u", 0), (3, "u", "u", None)], SCHEMA)
    guarded = merge_upsert(target, updates, "k", ["a", "v"], version="v")
    assert rows(guarded) == [(1, None, "t", 1), (2, "u", "t", 0), (3, "t", "t", 3)]
    free = merge_upsert(target, updates, "k", ["a"])
    assert [r[1] for r in rows(free)] == [None, "u", "u"]


def test_replay_is_idempotent_and_batches_commute(spark):
    rng = random.Random(5)
    history = [(rng.randrange(20), f"a{i}", f"b{i}", i) for i in range(200)]
    target = spark.createDataFrame([], SCHEMA)

    def apply(state, batch):
        newest = latest_by_key(spark.createDataFrame(batch, SCHEMA), "k", "v")
        out = merge_upsert(state, newest, "k", ["a", "b", "v"], version="v")
        return spark.createDataFrame(out.collect(), SCHEMA)

    batches = [history[i : i + 50] for i in range(0, 200, 50)]
    forward = target
    for batch in batches:
        forward = apply(apply(forward, batch), batch)
    backward = target
    for batch in reversed(batches):
        backward = apply(backward, batch)
    expected = {}
    for row in history:
        expected[row[0]] = row
    assert rows(forward) == rows(backward) == sorted(expected.values())


def test_latest_takes_the_total_order(spark):
    df = spark.createDataFrame(
        [(1, "x", "p", 5), (1, "y", "p", 5), (1, "z", "p", 4), (2, "q", "p", None), (2, "r", "p", 0)], SCHEMA
    )
    assert rows(latest_by_key(df, "k", "v", ["a"])) == [(1, "y", "p", 5), (2, "r", "p", 0)]


def test_hot_key_is_reduced_before_the_shuffle(spark, tmp_path):
    """A key with a third of the rows: each task hands over one row of it at most."""
    df = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias("v")
    )
    newest = latest_by_key(df, "k", "v")
    plan = newest._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan
    assert newest.where("k = -1").first().v == 299_997 and newest.count() == 1001


def test_unique_violations(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (3, "y"), (4, None), (5, None)], "k long, e string")
    assert rows(unique_violations(df, "e", "k")) == [("y", 2)]


def test_latest_without_a_version_is_settled_by_the_tie_break(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert sorted(map(tuple, latest_by_key(df, "k", None, ["v"]).collect())) == [(1, "b"), (2, None)]
