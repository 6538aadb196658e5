"""Mirrors in month folders, and mirror views through compaction and maintenance."""

import json
from datetime import datetime, timezone

import pytest

from brookmark.plans.adhoc import bounded_query
from brookmark.plans.layers import mirror_path, publish, publish_mirror
from brookmark.plans.upkeep import run_maintenance
from brookmark.sources.files import Folders
from brookmark.sources.fixture import ACTIVITY
from brookmark.specs import CATALOG
from brookmark.streaming.cdc import parse_cdc
from brookmark.streaming.mirror import Mirror, MonthMirror, mirror_of

SPEC = CATALOG["orders"]
DAY = 86_400_000_000
MAY, JUNE = 1_714_521_600_000_000, 1_717_200_000_000_000  # 2024-05-01, 2024-06-01


def made(key, at, status="pending", ts=1, op="c"):
    return {"op": op, "after": {"order_id": key, "status": status, "created_at": at}, "ts_ms": ts}


def gone(key, ts):
    """A delete that carries the key alone, so that its date is the default."""
    return {"op": "d", "before": {"order_id": key}, "ts_ms": ts}


def send(spark, mirror, number, *messages, nulls="default"):
    raw = spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")
    mirror.append(parse_cdc(raw, SPEC, nulls), number)


def live(df):
    return sorted((r.order_id, r.status) for r in df.collect())


@pytest.mark.parametrize("nulls", ["default", "keep"])
@pytest.mark.parametrize("fold", [(), (0,), (0, 1), (0, 1, 2), (2,)])
def test_months_agree_with_the_plain_mirror(spark, tmp_path, fold, nulls):
    """Wherever compactions fall: late deletes, deletes before their row, late old versions, rows without a date."""
    months, plain = MonthMirror(spark, str(tmp_path / "m"), SPEC, width=3), Mirror(spark, str(tmp_path / "p"), SPEC, width=3)
    batches = [
        [made(1, MAY), made(2, MAY + DAY), made(3, JUNE), made(4, JUNE), gone(7, 9), made(8, None), made(9, None, ts=5)],
        [made(1, MAY, "shipped", 2), gone(3, 2), made(5, JUNE + DAY), gone(8, 4)],
        [gone(2, 3), made(4, JUNE, "old", 0), made(7, MAY, ts=2), made(3, JUNE, "back", 5), made(6, MAY, ts=1), made(9, None, "late", 2)],
    ]
    for number, messages in enumerate(batches):
        for mirror in (months, plain):
            send(spark, mirror, number, *messages, nulls=nulls)
        if number in fold:
            months.compact()
    whole = plain.current()
    assert live(months.current()) == live(whole)
    for month in ("2024-05", "2024-06", "1970-01", "2031-01"):
        assert live(months.month(month)) == live(whole.where(f"date_format(created_at, 'yyyy-MM') = '{month}'"))


def test_a_month_opens_its_folder_alone(spark, tmp_path):
    mirror = MonthMirror(spark, str(tmp_path), SPEC)
    send(spark, mirror, 0, made(1, MAY), made(2, JUNE), made(3, JUNE))
    mirror.compact()
    send(spark, mirror, 1, gone(2, 3))
    mirror.compact()
    own = mirror.base.read().where("month = '2024-06'")
    assert own.count() == 2  # the tombstone lies with the row it ends
    assert Folders(spark, f"{tmp_path}/base").listed("", 2) == ["month=2024-05/slot=0", "month=2024-06/slot=0"]
    plan = mirror.month("2024-06")._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert live(mirror.month("2024-06")) == [(3, "pending")]


def test_news_of_other_months_open_no_folder(spark, tmp_path):
    """Deletes of June's rows, unfolded: May's folder is all that May needs of the base; June still loses them."""
    mirror = MonthMirror(spark, str(tmp_path), SPEC)
    send(spark, mirror, 0, made(1, MAY), made(2, JUNE), made(3, JUNE))
    mirror.compact()
    send(spark, mirror, 1, gone(2, 3), made(4, JUNE), gone(1, 4), made(5, MAY))
    plan = mirror.month("2024-05")._jdf.queryExecution().executedPlan().toString()
    assert "2024-05" in plan and "2024-06" not in plan
    assert live(mirror.month("2024-05")) == [(5, "pending")]
    assert live(mirror.month("2024-06")) == [(3, "pending"), (4, "pending")]


def test_tombstones_leave_the_map_of_keys_alone(spark, tmp_path):
    """A compaction of deletes alone rewrites their rows' folders; nothing moves, so the map stays as it is."""
    mirror = MonthMirror(spark, str(tmp_path), SPEC)
    send(spark, mirror, 0, made(1, MAY), made(2, JUNE), made(3, JUNE), nulls="keep")
    mirror.compact()
    files = lambda part: sorted(p.relative_to(tmp_path) for p in (tmp_path / "base" / part).rglob("*.parquet"))
    keys, may, june = files("_keys"), files("month=2024-05"), files("month=2024-06")
    send(spark, mirror, 1, gone(2, 3), nulls="keep")
    mirror.compact()
    assert files("_keys") == keys and files("month=2024-05") == may
    assert files("month=2024-06") != june
    assert live(mirror.current()) == [(1, "pending"), (3, "pending")] == live(mirror.month("2024-05")) + live(mirror.month("2024-06"))


def test_far_keys_of_a_month_share_a_folder(spark, tmp_path):
    mirror = MonthMirror(spark, str(tmp_path), SPEC)
    send(spark, mirror, 0, made(1, MAY), made(5_000_000, MAY), made(20_000_000, MAY))
    mirror.compact()
    assert Folders(spark, f"{tmp_path}/base").listed("", 2) == ["month=2024-05/slot=0", "month=2024-05/slot=1"]


def test_layout_follows_the_specification(spark, tmp_path):
    assert type(mirror_of(spark, str(tmp_path), SPEC)) is MonthMirror
    assert type(mirror_of(spark, str(tmp_path), ACTIVITY)) is Mirror
    with pytest.raises(ValueError):
        MonthMirror(spark, str(tmp_path), ACTIVITY)


@pytest.mark.parametrize("kind", [Mirror, MonthMirror])
def test_views_outlive_the_log(spark, tmp_path, kind):
    """Published once; then folded, all log folders retired, and more messages."""
    root = str(tmp_path)
    mirror = kind(spark, mirror_path(root, SPEC), SPEC)
    query = "SELECT order_id, status FROM mirror.orders_current"
    ask = lambda: live(bounded_query(spark, query).rows)
    mirror.prepare()
    publish(spark, root) if kind is MonthMirror else publish_mirror(spark, mirror)
    assert ask() == []
    send(spark, mirror, 0, made(1, MAY), made(2, JUNE), made(3, MAY))
    assert ask() == [(1, "pending"), (2, "pending"), (3, "pending")]
    mirror.compact()
    assert ask() == live(mirror.current())
    assert spark.table("mirror.orders").count() == 3  # folded batches are not read again
    done = run_maintenance(spark, root, datetime.now(timezone.utc), mirrors=[mirror])
    assert done["log_folders_retired"] == 1
    assert Folders(spark, f"{mirror.path}/log").listed() == ["batch_id=-1"]
    assert ask() == [(1, "pending"), (2, "pending"), (3, "pending")]
    send(spark, mirror, 1, gone(1, 5), made(2, JUNE, "shipped", 2, "u"))
    assert ask() == [(2, "shipped"), (3, "pending")] == live(mirror.current())
    mirror.compact()
    run_maintenance(spark, root, datetime.now(timezone.utc), mirrors=[mirror])
    assert ask() == [(2, "shipped"), (3, "pending")] == live(mirror.current())
