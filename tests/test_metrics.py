import random
from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from brookmark.operators import alerts as A
from brookmark.operators import metrics as M
from brookmark.specs import CATALOG

T0 = datetime(2024, 1, 1)


def daily(spark, values):
    rows = [(date(2024, 1, 1) + timedelta(days=i), None if v is None else D(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "day date, revenue decimal(28,2)")


def test_z_needs_eight_days(spark):
    assert M.revenue_z(daily(spark, range(1, 8))).collect() == []
    assert M.revenue_z(daily(spark, range(1, 9))).count() == 1


def test_z_values(spark):
    assert M.revenue_z(daily(spark, [5] * 10)).first().z == 0.0
    row = M.revenue_z(daily(spark, [1, 3] * 5 + [6])).first()
    assert (row.latest, row.mean, row.z) == (6.0, 2.0, 4.0)
    assert M.revenue_anomalies(M.revenue_z(daily(spark, [1, 3] * 5 + [6]))).count() == 1
    # only the 30 days before count, and a missing sum is passed over
    long = M.revenue_z(daily(spark, [1000] * 20 + [1, 3] * 15 + [6])).first()
    assert long.z == 4.0
    assert M.revenue_z(daily(spark, [1, 3] * 5 + [6, None])).first().latest == 6.0
    assert M.revenue_z(daily(spark, [None] * 9)).collect() == []


def test_z_over_calendar_days(spark):
    gap = daily(spark, [1, 3] * 5 + [6]).where(F.col("day") != date(2024, 1, 5))
    assert M.fill_calendar(gap).count() == 11
    assert M.revenue_z(gap, calendar=True).first().mean < M.revenue_z(gap).first().mean


def test_rolling_z_ends_with_the_same_score(spark):
    values = [random.Random(3).randrange(100) for _ in range(60)]
    last = M.rolling_z(daily(spark, values)).orderBy(F.desc("day")).first()
    assert last.z == pytest.approx(M.revenue_z(daily(spark, values)).first().z)


def samples(spark, series):
    rows = [(name, T0 + timedelta(seconds=s), v) for name, points in series.items() for s, v in points]
    return spark.createDataFrame(rows, "series string, ts timestamp, value long")


def brute_increase(points, window):
    out, deltas = {}, []
    for i, (s, v) in enumerate(points):
        previous = points[i - 1][1] if i else None
        deltas.append((s, 0 if previous is None else v if v < previous else v - previous))
        out[s] = sum(d for at, d in deltas if s - window <= at <= s)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_increase_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    series = {}
    for name, size in (("hot", 400), ("cold", 20), ("one", 1)):
        value, at, points = 0, rng.randrange(50), []
        for _ in range(size):
            at += rng.choice([1, 5, 10, 60, 60, 300, 4000])
            value = rng.randrange(3) if rng.random() < 0.1 else value + rng.randrange(5)
            points.append((at, value))
        series[name] = points
    for window in (60, 300):
        got = M.increase(samples(spark, series), "ts", "series", "value", window).collect()
        found = {(r.series, int((r.ts - T0).total_seconds())): r.increase for r in got}
        wanted = {(n, s): v for n, p in series.items() for s, v in brute_increase(p, window).items()}
        assert found == wanted


def test_rate_and_restart(spark):
    points = {"a": [(0, 10), (60, 70), (120, 5)]}
    rows = M.rate(samples(spark, points), "ts", "series", "value", 120).orderBy("ts").collect()
    assert [r.rate for r in rows] == [0.0, 0.5, 65 / 120]


def brute_hold(points, duration, gap):
    out, run = [], []
    for s, ok in [*points, (None, False)]:
        if run and s is not None and s - run[-1] > gap:
            if run[-1] - run[0] >= duration:
                out.append((run[0], run[-1], len(run)))
            run = []
        if ok:
            run.append(s)
        elif run:
            if run[-1] - run[0] >= duration:
                out.append((run[0], run[-1], len(run)))
            run = []
    return out


@pytest.mark.parametrize("seed", range(4))
def test_hold_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    series = {n: [(i * 60, int(rng.random() < p)) for i in range(300)] for n, p in (("a", 0.9), ("b", 0.5), ("c", 1.0))}
    # samples go missing for minutes and for whole slices
    series["d"] = [p for p in series["c"] if rng.random() < 0.3]
    series["e"] = [p for p in series["a"] if p[0] < 3000 or 9000 < p[0] < 9400 or p[0] > 15000]
    got = M.hold(samples(spark, series), "ts", "series", F.col("value") == 1, 300, slice_seconds=1800).collect()
    found = sorted(
        (r.series, int((r.since - T0).total_seconds()), int((r.until - T0).total_seconds()), r.samples) for r in got
    )
    wanted = sorted((n, *h) for n, p in series.items() for h in brute_hold([(s, v == 1) for s, v in p], 300, M.STALE_AFTER))
    assert found == wanted


def test_linear_prediction(spark):
    falling = {"disk": [(i * 600, 100_000 - i * 1000) for i in range(37)], "flat": [(i * 600, 50) for i in range(37)],
               "single": [(21_600, 5)]}
    out = M.predict_linear(samples(spark, falling), "ts", "series", "value", 21_600, 86_400).collect()
    got = {r.series: r.predicted for r in out}
    assert got["disk"] == pytest.approx(64_000 - 86_400 * 1000 / 600) and got["flat"] == pytest.approx(50)
    assert "single" not in got
    fixed = M.predict_linear(
        samples(spark, falling), "ts", "series", "value", 3600, 600, at=T0 + timedelta(seconds=6000)
    )
    assert {r.series: r.predicted for r in fixed.collect()}["disk"] == pytest.approx(89_000)


def test_ratio_and_totals(spark):
    df = spark.createDataFrame([("a", 1, 10), ("b", 5, 10), ("c", 1, 0)], "m string, avail int, size int")
    assert [r.m for r in M.ratio_below(df, "avail", "size", A.DISK_LOW_RATIO).collect()] == ["a"]
    lag = spark.createDataFrame([("g", 6000), ("g", 5000), ("h", 1)], "grp string, lag long")
    over = M.metric_total(lag, "grp", "lag").where(F.col("lag") > A.CONSUMER_LAG_LIMIT)
    assert [r.grp for r in over.collect()] == ["g"]
    assert M.metric_total(lag, "grp", "lag", "max").where("grp = 'g'").first().lag == 6000


def test_metric_names(spark):
    names = ["airflow.etl.freshness.orders", "airflow.dag.d1.t1.duration", "airflow.ti_failures",
             "airflow.etl.freshness.a.b", "other"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: (r.metric, r.labels) for r in M.rename_metrics(df, "name").collect()}
    assert got == {
        names[0]: ("etl_source_freshness_lag_seconds", {"table": "orders"}),
        names[1]: ("airflow_task_duration", {"dag_id": "d1", "task_id": "t1"}),
        names[2]: ("airflow_ti_failures", {}),
        names[3]: (names[3], {}),
        names[4]: (names[4], {}),
    }


def test_freshness(spark):
    schema = CATALOG["orders"].schema
    row = (1, 1, T0, D("1"), "pending", T0, T0 + timedelta(microseconds=500_000))
    frames = {"orders": spark.createDataFrame([row], schema), "customers": spark.createDataFrame([], CATALOG["customers"].schema)}
    lags = M.freshness(frames, CATALOG, F.lit("2024-01-03 00:00:01").cast("timestamp"))
    assert [tuple(r) for r in lags.collect()] == [("orders", 172_800.5)]
    assert M.stale_sources(lags).count() == 1


def test_rolling_prediction_matches_the_single_one(spark):
    rng = random.Random(2)
    points = {"a": [(i * 600, 1000 - i * 7 + rng.randrange(9)) for i in range(200)], "b": [(0, 1)]}
    df = samples(spark, points)
    rolling = {
        r.ts: r.predicted
        for r in M.predict_rolling(df, "ts", "series", "value", 3600, 7200).collect()
    }
    assert len(rolling) == 199  # the first sample has no trend, nor has the single one
    for i in (1, 5, 12, 13, 50, 199):
        at = T0 + timedelta(seconds=i * 600)
        single = M.predict_linear(df, "ts", "series", "value", 3600, 7200, at=at).where("series = 'a'").first()
        assert rolling[at] == pytest.approx(single.predicted)


@pytest.mark.parametrize("seed", range(3))
def test_rolling_prediction_matches_a_fit_of_each_window(spark, seed):
    rng = random.Random(seed)
    points = {
        "uneven": sorted({(rng.randrange(40_000), rng.randrange(1000)) for _ in range(150)}),
        "edges": [(i * 1800, rng.randrange(50)) for i in range(20)],  # samples on the ends of windows and slices
        "gaps": [(s, rng.randrange(9)) for s in (0, 100, 9000, 9100, 9100 + 3600, 30_000)],
        "spike": [(i * 60, 10**15 if i == 5 else 0) for i in range(200)],
    }
    points["uneven"] = list({s: (s, v) for s, v in points["uneven"]}.values())
    got = {
        (r.series, int((r.ts - T0).total_seconds())): (r.slope, r.predicted)
        for r in M.predict_rolling(samples(spark, points), "ts", "series", "value", 3600, 7200).collect()
    }
    wanted = {}
    for name, samples_of in points.items():
        for at, _ in samples_of:
            inside = [(s - at, v) for s, v in samples_of if at - 3600 <= s <= at]
            mx, my = (sum(p[i] for p in inside) / len(inside) for i in (0, 1))
            sxx = sum((s - mx) ** 2 for s, _ in inside)
            if sxx:
                slope = sum((s - mx) * (v - my) for s, v in inside) / sxx
                wanted[name, at] = (slope, my + slope * (7200 - mx), max(v for _, v in inside))
    assert got.keys() == wanted.keys()
    for k, (slope, predicted, peak) in wanted.items():
        assert got[k] == pytest.approx((slope, predicted), rel=1e-6, abs=1e-6 + 1e-12 * peak)
    assert got["spike", 199 * 60] == (0.0, 0.0)  # nothing of the spike is left


def test_alert_rules(spark):
    falling = {"disk": [(i * 600, 30_000 - i * 1000) for i in range(40)], "flat": [(i * 600, 5) for i in range(40)]}
    out = A.will_run_out(samples(spark, falling), "ts", "series", "value", max_gap=600).collect()
    assert [(r.series, r.since, r.samples) for r in out] == [("disk", T0 + timedelta(seconds=600), 39)]
    errors = samples(spark, {"dag": [(0, 0), (60, 1), (120, 1), (4000, 1)]})
    assert A.failed_runs(errors, "ts", "series", "value").count() == 2
    assert A.import_errors(errors, "ts", "series", "value", max_gap=3880).count() == 1
    assert A.import_errors(errors, "ts", "series", "value").count() == 0  # nothing was heard for an hour
    disk = spark.createDataFrame(
        [("n", T0 + timedelta(seconds=s), free, 100) for s, free in ((0, 20), (300, 15), (600, 10), (900, 20), (1200, 90))],
        "series string, ts timestamp, free int, size int",
    )
    assert A.low_share(disk, "ts", "series", "free", "size").first().held_seconds == 900
    assert A.critical_share(disk, "ts", "series", "free", "size").first().held_seconds == 300
    lag = spark.createDataFrame(
        [("g", T0 + timedelta(seconds=s), p, 6000) for s in (0, 300, 600) for p in (0, 1)],
        "grp string, ts timestamp, part int, lag long",
    )
    assert A.lagging_consumers(lag, "ts", "grp", "lag").first().held_seconds == 600
