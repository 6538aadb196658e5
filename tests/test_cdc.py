import json
import random
import re
from datetime import date, datetime
from decimal import Decimal

import pytest

from brookmark.sources.changelog import read_cdc_files
from brookmark.sources.files import delete_listed
from brookmark.sources.fixture import ACTIVITY
from brookmark.specs import CATALOG, TableSpec
from brookmark.streaming.cdc import collapse, current, merge_latest, parse_cdc, tombstones
from brookmark.streaming.mirror import Mirror, run_mirror
from brookmark.streaming.rates import consumer_lag, message_rate

ORDERS = CATALOG["orders"]
NOON = 1_704_110_400_000_000  # 2024-01-01 12:00 in microseconds


def image(key, **change):
    base = {
        "order_id": key, "customer_id": 7, "order_date": NOON, "total_amount": 12.5, "status": "pending",
        "created_at": NOON, "updated_at": NOON,
    }
    return {**base, **change}


def message(op, key, ts, **change):
    row = {"order_id": key} if op == "d" else image(key, **change)
    return json.dumps({"op": op, "before" if op == "d" else "after": row, "ts_ms": ts})


def log(spark, *messages):
    return spark.createDataFrame([(m,) for m in messages], "value string")


def parsed(spark, *messages, spec=ORDERS, **kw):
    return parse_cdc(log(spark, *messages), spec, **kw).collect()


def test_row_image(spark):
    (row,) = parsed(spark, message("c", 1, 5))
    assert row.order_date == datetime(2024, 1, 1, 12) and row.total_amount == Decimal("12.50")
    assert (row.ver, row.is_deleted, row.status) == (5, False, "pending")


@pytest.mark.parametrize("op", ["r", "c", "u"])
def test_upserts_take_after(spark, op):
    assert [r.order_id for r in parsed(spark, message(op, 3, 1))] == [3]


def test_messages_without_a_record_are_dropped(spark):
    wrapped = json.dumps({"schema": {}, "payload": json.loads(message("c", 1, 1))})
    nothing = json.dumps({"op": "u", "before": None, "after": None, "ts_ms": 1})
    truncate = json.dumps({"op": "t", "ts_ms": 1})
    assert parsed(spark, "", "not json", wrapped, nothing, truncate) == []


def test_money_is_exact(spark):
    text = message("c", 1, 1).replace("12.5", "1234567890123456.78")
    assert parsed(spark, text)[0].total_amount == Decimal("1234567890123456.78")
    assert parsed(spark, message("c", 1, 1).replace("12.5", "19.99"))[0].total_amount == Decimal("19.99")


def test_bad_leaves_do_not_lose_their_siblings(spark):
    text = message("c", 1, 1).replace("12.5", '"abc"')
    row = parsed(spark, text)[0]
    assert row.total_amount == Decimal("0.00") and row.status == "pending" and row.order_id == 1
    assert parsed(spark, text, nulls="keep")[0].total_amount is None


def test_nulls_take_defaults_or_stay(spark):
    bare = json.dumps({"op": "c", "after": {"order_id": 1, "status": None}, "ts_ms": 1})
    row = parsed(spark, bare)[0]
    assert (row.status, row.customer_id, row.total_amount) == ("", 0, Decimal("0.00"))
    assert row.created_at == datetime(1970, 1, 1)
    kept = parsed(spark, bare, nulls="keep")[0]
    assert kept.status is None and kept.created_at is None


def test_every_declared_type(spark):
    spec = TableSpec(
        "all_types",
        (
            ("id", "BIGINT"), ("i", "INTEGER"), ("s", "SMALLINT"), ("b", "BOOLEAN"), ("r", "REAL"),
            ("d", "DOUBLE PRECISION"), ("n", "NUMERIC(18,4)"), ("day", "DATE"), ("t", "TIMESTAMP"),
            ("u", "UUID"), ("j", "JSONB"), ("c", "CHAR"),
        ),
        "id",
    )
    row = {
        "id": 1, "i": 2, "s": 3, "b": True, "r": 0.5, "d": 0.25, "n": 1.2345, "day": 19723, "t": NOON + 1,
        "u": "abc", "j": '{"x": 1}', "c": "z",
    }
    got = parsed(spark, json.dumps({"op": "c", "after": row, "ts_ms": 1}), spec=spec)[0]
    assert (got.i, got.s, got.b, got.r, got.d, got.n) == (2, 3, True, 0.5, 0.25, Decimal("1.2345"))
    assert got.day == date(2024, 1, 1) and got.t == datetime(2024, 1, 1, 12, 0, 0, 1) and got.j == '{"x": 1}'
    empty = parsed(spark, json.dumps({"op": "c", "after": {"id": 1}, "ts_ms": 1}), spec=spec)[0]
    assert (empty.i, empty.s, empty.b, empty.r, empty.n) == (0, 0, False, 0.0, Decimal("0.0000"))


def state(spark, *messages):
    versions = parse_cdc(log(spark, *messages), ORDERS)
    return {r.order_id: r.status for r in current(versions, ORDERS).collect()}


def test_newest_wins_and_deletes_stay(spark):
    assert state(spark, message("u", 1, 9, status="shipped"), message("u", 1, 3)) == {1: "shipped"}
    late = [message("c", 1, 1), message("d", 1, 5), message("u", 1, 4, status="shipped")]
    assert state(spark, *late) == {}
    assert state(spark, *late, message("c", 1, 6)) == {1: "pending"}
    versions = parse_cdc(log(spark, *late), ORDERS)
    assert [tuple(r) for r in tombstones(versions, ORDERS).collect()] == [(1, 5)]


def test_equal_versions_are_settled_the_same_way_every_time(spark):
    tied = [message("u", 1, 5, status="shipped"), message("u", 1, 5, status="pending"), message("d", 2, 5),
            message("u", 2, 5)]
    assert state(spark, *tied) == state(spark, *reversed(tied)) == {1: "shipped"}


def test_shuffled_batches_converge(spark):
    rng = random.Random(11)
    messages = [message(rng.choice("cuud"), rng.randrange(12), ts, status=f"s{ts}") for ts in range(120)]
    expected = None
    for seed in range(3):
        random.Random(seed).shuffle(messages)
        versions = parse_cdc(log(spark), ORDERS)
        for i in range(0, 120, 40):
            batch = parse_cdc(log(spark, *messages[i : i + 40]), ORDERS)
            versions = merge_latest(batch, merge_latest(batch, versions, ORDERS), ORDERS)
            versions = spark.createDataFrame(versions.collect(), versions.schema)
        got = sorted(tuple(r) for r in versions.collect())
        expected = expected or got
        assert got == expected
    direct = current(parse_cdc(log(spark, *messages), ORDERS), ORDERS)
    assert sorted(r.order_id for r in direct.collect()) == sorted(r[0] for r in expected if not r[-1])


def test_stream_resumes_and_rebuilds(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def drop(name, *messages):
        (source / f".{name}").write_text("\n".join(messages) + "\n")
        (source / f".{name}").rename(source / name)

    def work(path, checkpoint):
        stream = read_cdc_files(spark, str(source), files_per_trigger=1)
        query = run_mirror(stream, ORDERS, str(tmp_path / path), str(tmp_path / checkpoint), once=True)
        query.awaitTermination()
        mirror = Mirror(spark, str(tmp_path / path), ORDERS)
        return {r.order_id: r.status for r in mirror.current().collect()}

    drop("a.json", message("c", 1, 1), message("c", 2, 1), message("c", 3, 1))
    assert work("m", "cp") == {1: "pending", 2: "pending", 3: "pending"}
    drop("b.json", message("u", 1, 3, status="shipped"), message("d", 2, 3))
    drop("c.json", message("u", 2, 2, status="late"), "")
    assert work("m", "cp") == {1: "shipped", 3: "pending"}
    log_before = Mirror(spark, str(tmp_path / "m"), ORDERS).versions().count()
    assert work("m", "cp") == {1: "shipped", 3: "pending"}  # nothing new
    assert Mirror(spark, str(tmp_path / "m"), ORDERS).versions().count() == log_before
    assert work("m2", "cp2") == {1: "shipped", 3: "pending"}  # rebuilt from the earliest message


def test_compaction_changes_nothing_wherever_it_stops(spark, tmp_path):
    mirror = Mirror(spark, str(tmp_path / "m"), ORDERS, width=2)
    batches = [
        [message("c", k, 1) for k in range(6)],
        [message("u", 1, 5, status="shipped"), message("d", 4, 5)],
        [message("u", 4, 2, status="late"), message("c", 9, 2)],
    ]
    for number, batch in enumerate(batches):
        mirror.append(parse_cdc(log(spark, *batch), ORDERS), number)
        if number < 2:
            mirror.compact(upto=number)
    expected = {0: "pending", 1: "shipped", 2: "pending", 3: "pending", 5: "pending", 9: "pending"}
    assert {r.order_id: r.status for r in mirror.current().collect()} == expected
    stale = [r.path for r in mirror.compacted_batches(1).collect()]
    assert sorted(p.rsplit("=", 1)[1] for p in stale) == ["0", "1"]
    mirror.compact()
    assert {r.order_id: r.status for r in mirror.current().collect()} == expected


def test_folded_batches_are_not_read_again(spark, tmp_path):
    mirror = Mirror(spark, str(tmp_path / "m"), ORDERS, width=2)
    assert mirror.folded() is None and mirror.compacted_batches().count() == 0
    mirror.compact()  # nothing to fold
    first = parse_cdc(log(spark, *[message("c", k, 1) for k in range(6)]), ORDERS)
    mirror.append(first, 0)
    mirror.append(parse_cdc(log(spark, message("u", 1, 5, status="shipped"), message("d", 4, 5)), ORDERS), 1)
    whole = sorted(tuple(r) for r in mirror.current().collect())

    # stopped between the base and the mark: batches are read from both
    stopped = Mirror(spark, mirror.path, ORDERS, width=2)
    stopped.base.write(collapse(stopped._log(), ORDERS))
    assert sorted(tuple(r) for r in mirror.current().collect()) == whole

    mirror.compact()
    assert mirror.folded() == 1 and mirror._log().count() == 0
    assert mirror.versions().count() == 6  # one per key
    plan = mirror._log()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*batch_id#\d+L > 1\)", plan)
    mirror.append(first, 0)  # a repeated batch changes nothing
    assert sorted(tuple(r) for r in mirror.current().collect()) == whole
    assert delete_listed(spark, mirror.compacted_batches()) == 2
    assert sorted(tuple(r) for r in mirror.current().collect()) == whole
    mirror.append(parse_cdc(log(spark, message("u", 4, 6, status="back")), ORDERS), 2)
    assert mirror._log().count() == 1 and mirror.compacted_batches().count() == 0
    assert {r.order_id: r.status for r in mirror.current().collect()}[4] == "back"


def test_late_data_and_streamed_rates(spark, tmp_path):
    rows = [(datetime(2024, 1, 1, 0, m), "orders") for m in (0, 1, 4, 6, 11)]
    spark.createDataFrame(rows, "ts timestamp, topic string").coalesce(1).write.parquet(str(tmp_path / "r"))
    batch = message_rate(spark.read.parquet(str(tmp_path / "r")), "ts", "topic")
    assert [r.messages for r in batch.orderBy("window_start").collect()] == [3, 1, 1]
    assert batch.orderBy("window_start").first().per_second == 3 / 300
    stream = spark.readStream.schema("ts timestamp, topic string").parquet(str(tmp_path / "r"))
    query = (
        message_rate(stream, "ts", "topic", watermark="1 minute")
        .writeStream.format("memory").queryName("rates").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    closed = spark.table("rates").orderBy("window_start").collect()
    assert [r.messages for r in closed] == [3, 1]  # the last window is still open


def test_consumer_lag(spark):
    report = json.dumps(
        {
            "timestamp": "2024-01-01T00:00:00.000Z",
            "sources": [
                {
                    "description": "k",
                    "endOffset": {"cdc.public.orders": {"0": 10, "1": 5}},
                    "latestOffset": {"cdc.public.orders": {"0": 12, "1": 5, "2": 4}},
                }
            ],
        }
    )
    (row,) = consumer_lag(spark, [report]).collect()
    assert (row.topic, row.lag) == ("cdc.public.orders", 6)


def test_a_fifth_table_needs_only_a_spec(spark):
    text = json.dumps({"op": "c", "after": {"user_id": 4, "seen_on": 1}, "ts_ms": 1})
    (row,) = current(parse_cdc(log(spark, text), ACTIVITY), ACTIVITY).collect()
    assert row.user_id == 4 and row.seen_on == date(1970, 1, 2)
    assert current(parse_cdc(log(spark, text), ACTIVITY), ACTIVITY).columns == ACTIVITY.column_names
