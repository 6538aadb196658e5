"""Freshness, revenue anomaly and time-series operators over metric samples.

Samples are ``(series..., ts, value)`` with one sample per series and instant. Operators that need
the order within a series cut it into time slices and carry a small per-slice summary across, so a
series that holds a large share of all samples is worked on by many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmark.functions.scalars import days_between, seconds_between
from brookmark.operators.unions import union_all
from brookmark.specs import TableSpec

# Alert thresholds.
STALE_SECONDS = 172_800
ANOMALY_LIMIT = 3.0
HISTORY_DAYS = 30
MINIMUM_DAYS = 8

#: Seconds after which a series without a new sample counts as silent, unless a caller says otherwise.
STALE_AFTER = 300

# Dotted metric name (``*`` matches one segment) -> metric name, label per ``*``.
METRIC_NAMES: list[tuple[str, str, tuple[str, ...]]] = [
    ("airflow.dagrun.duration.success.*", "airflow_dagrun_duration_success", ("dag_id",)),
    ("airflow.dagrun.duration.failed.*", "airflow_dagrun_duration_failed", ("dag_id",)),
    ("airflow.dag.*.*.duration", "airflow_task_duration", ("dag_id", "task_id")),
    ("airflow.ti_failures", "airflow_ti_failures", ()),
    ("airflow.ti_successes", "airflow_ti_successes", ()),
    ("airflow.scheduler_heartbeat", "airflow_scheduler_heartbeat", ()),
    ("airflow.dag_processing.import_errors", "airflow_dag_import_errors", ()),
    ("airflow.etl.freshness.*", "etl_source_freshness_lag_seconds", ("table",)),
    ("airflow.etl.revenue_anomaly_z", "etl_revenue_anomaly_z", ()),
    ("airflow.etl.rows_synced.*", "etl_rows_synced", ("table",)),
]


def freshness(frames: Mapping[str, DataFrame], specs: dict[str, TableSpec],
              now: Column | None = None) -> DataFrame:
    """Seconds since the newest cursor value of every table that has a cursor and a row."""
    at = F.current_timestamp() if now is None else now
    parts = []
    for name, df in frames.items():
        cursor = specs[name].cursor_column
        if cursor:
            newest = df.agg(F.max(cursor).alias("newest"))
            parts.append(
                newest.where(F.col("newest").isNotNull()).select(
                    F.lit(name).alias("table_name"),
                    seconds_between(at, F.col("newest")).alias("lag_seconds"),
                )
            )
    return union_all(parts)


def stale_sources(lags: DataFrame, limit: float = STALE_SECONDS) -> DataFrame:
    return lags.where(F.col("lag_seconds") > limit)


def fill_calendar(daily: DataFrame) -> DataFrame:
    """Daily revenue with a zero for every calendar day that has no row."""
    spine = daily.agg(F.min("day").alias("a"), F.max("day").alias("b")).select(
        F.explode(days_between(F.col("a"), F.col("b"))).alias("day")
    )
    return spine.join(daily, "day", "left").select(
        "day", F.coalesce("revenue", F.lit(0)).cast(daily.schema["revenue"].dataType).alias("revenue")
    )


def _z(latest: Column, mean: Column, deviation: Column) -> Column:
    return F.coalesce((latest - mean) / F.nullif(deviation, F.lit(0.0)), F.lit(0.0))


def revenue_z(daily: DataFrame, as_of: datetime | None = None, n: int = HISTORY_DAYS,
              minimum: int = MINIMUM_DAYS, calendar: bool = False) -> DataFrame:
    """z-score of the newest day's revenue against the ``n`` days before it that are present.

    No row with fewer than ``minimum`` days or no history; a constant history gives 0.
    """
    days = daily if as_of is None else daily.where(F.col("day") <= F.lit(as_of))
    if calendar:
        days = fill_calendar(days)
    newest = days.orderBy(F.col("day").desc()).limit(n + 1)
    # at most n + 1 rows from here on
    ranked = newest.withColumns(
        {
            "value": F.col("revenue").cast("double"),
            "place": F.row_number().over(
                Window.orderBy(F.col("revenue").isNull(), F.col("day").desc())
            ),
        }
    )
    history = F.when(F.col("place") > 1, F.col("value"))
    summary = ranked.agg(
        F.count(F.lit(1)).alias("days"),
        F.max(F.when(F.col("place") == 1, F.col("day"))).alias("day"),
        F.max(F.when(F.col("place") == 1, F.col("value"))).alias("latest"),
        F.avg(history).alias("mean"),
        F.stddev_pop(history).alias("deviation"),
    )
    return summary.where((F.col("days") >= minimum) & F.col("mean").isNotNull()).select(
        "day", "latest", "mean", _z(F.col("latest"), F.col("mean"), F.col("deviation")).alias("z")
    )


def rolling_z(daily: DataFrame, n: int = HISTORY_DAYS, minimum: int = MINIMUM_DAYS) -> DataFrame:
    """The same score for every day against its own ``n`` previous days.

    The single-partition window runs over the daily aggregate, one row per calendar day.
    """
    before = Window.orderBy("day").rowsBetween(-n, -1)
    value = F.col("revenue").cast("double")
    scored = daily.where(F.col("revenue").isNotNull()).select(
        "day",
        value.alias("value"),
        F.count(value).over(before).alias("history_days"),
        F.avg(value).over(before).alias("mean"),
        F.stddev_pop(value).over(before).alias("deviation"),
    )
    return scored.where(F.col("history_days") >= minimum - 1).select(
        "day", "value", "mean", _z(F.col("value"), F.col("mean"), F.col("deviation")).alias("z")
    )


def revenue_anomalies(scores: DataFrame, limit: float = ANOMALY_LIMIT) -> DataFrame:
    return scores.where(F.abs("z") > limit)


def _names(series: str | Sequence[str]) -> list[str]:
    return [series] if isinstance(series, str) else list(series)


def _slice(ts: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(ts)) / F.lit(seconds * 1_000_000)).cast("long")


def counter_deltas(df: DataFrame, ts: str, series: str | Sequence[str], value: str,
                   slice_seconds: int) -> DataFrame:
    """Growth since the previous sample; a counter that fell restarted from zero.

    The first sample of a series has no growth. The predecessor of a slice's first sample is the
    last sample of the closest earlier slice, taken from a summary with one row per slice.
    """
    keys = _names(series)
    sliced = df.select(*keys, ts, value, _slice(ts, slice_seconds).alias("_slice"))
    last = sliced.groupBy(*keys, "_slice").agg(F.max_by(value, ts).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_slice")
    carried = last.select(*keys, "_slice", F.lag("_last").over(earlier).alias("_carried"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(ts)
    previous = F.coalesce(F.lag(value).over(inside), F.col("_carried"))
    now = F.col(value)
    return (
        sliced.join(carried, [*keys, "_slice"])
        .withColumn("_previous", previous)
        .withColumn(
            "delta",
            F.when(F.col("_previous").isNull(), F.lit(0).cast(df.schema[value].dataType))
            .when(now < F.col("_previous"), now)
            .otherwise(now - F.col("_previous")),
        )
        .drop("_carried", "_previous")
    )


def increase(df: DataFrame, ts: str, series: str | Sequence[str], value: str, window: int,
             slices_per_window: int = 12) -> DataFrame:
    """Counter growth over the last ``window`` seconds at every sample, restarts included.

    Growth enters a running sum at its sample and leaves it just after ``ts + window``, which
    makes the window linear in the number of samples. A slice is several windows long; only the
    last window of each is also given to the next slice.
    """
    keys = _names(series)
    width = window * slices_per_window
    deltas = counter_deltas(df, ts, keys, value, width)
    micros, span = F.unix_micros(F.col(ts)), F.lit(window * 1_000_000)
    placed = _with_context(deltas, ts, window, width)
    steps = F.array(
        F.struct(micros.alias("at"), F.lit(0).alias("leaves"), F.col("delta").alias("change")),
        F.struct((micros + span).alias("at"), F.lit(1).alias("leaves"), (-F.col("delta")).alias("change")),
    )
    running = (
        Window.partitionBy(*keys, "_home")
        .orderBy("_step.at", "_step.leaves")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.withColumn("_step", F.explode(steps))
        .withColumn("increase", F.sum("_step.change").over(running))
        .where(F.col("_own") & (F.col("_step.leaves") == 0))
        .select(*keys, ts, value, "increase")
    )


def rate(df: DataFrame, ts: str, series: str | Sequence[str], value: str, window: int) -> DataFrame:
    """Per-second growth over the last ``window`` seconds at every sample."""
    grown = increase(df, ts, series, value, window)
    per_second = F.col("increase").cast("double") / F.lit(float(window))
    return grown.withColumn("rate", per_second).drop("increase")


def hold(df: DataFrame, ts: str, series: str | Sequence[str], condition: Column, duration: int,
         slice_seconds: int = 3_600, max_gap: int = STALE_AFTER) -> DataFrame:
    """Stretches in which a condition stayed true for at least ``duration`` seconds.

    A stretch ends at a false sample, and where the next sample comes more than ``max_gap`` seconds
    later. Both are marks; all true samples with the same last mark form one stretch, so stretches
    are plain groups. A slice is summed up by its ends and its last mark.
    """
    keys = _names(series)
    inside = Window.partitionBy(*keys, "_slice").orderBy(ts)
    silent = F.expr(f"interval {max_gap} seconds")
    sliced = df.select(
        *keys, ts, _slice(ts, slice_seconds).alias("_slice"),
        F.coalesce(condition, F.lit(False)).alias("_true"),
    )
    marks = sliced.withColumn(
        "_mark", F.when(~F.col("_true") | (F.lag(ts).over(inside) + silent < F.col(ts)), F.col(ts))
    )
    slices = marks.groupBy(*keys, "_slice").agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.max("_mark").alias("_end")
    )
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    opened = slices.withColumn(
        "_open", F.when(F.lag("_last").over(by_slice) + silent < F.col("_first"), F.col("_first"))
    )
    last_mark = F.max(F.coalesce("_end", "_open")).over(by_slice.rowsBetween(Window.unboundedPreceding, -1))
    carried = opened.select(*keys, "_slice", F.coalesce("_open", last_mark).alias("_carried"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = marks.join(carried, [*keys, "_slice"]).withColumn(
        "_after", F.coalesce(F.max("_mark").over(so_far), F.col("_carried"))
    )
    held = seconds_between(F.col("until"), F.col("since"))
    return (
        marked.where("_true")
        .groupBy(*keys, "_after")
        .agg(F.min(ts).alias("since"), F.max(ts).alias("until"), F.count(F.lit(1)).alias("samples"))
        .drop("_after")
        .withColumn("held_seconds", held)
        .where(F.col("held_seconds") >= duration)
    )


def predict_linear(df: DataFrame, ts: str, series: str | Sequence[str], value: str, lookback: int,
                   ahead: int, at: datetime | None = None) -> DataFrame:
    """Least-squares value ``ahead`` seconds after ``at`` from the last ``lookback`` seconds.

    ``at`` defaults to the newest sample of all (one aggregate, used as a scalar subquery). Time is
    measured from ``at`` to keep the sums small. A series with one instant has no trend.
    """
    keys = _names(series)
    end = F.lit(at).cast("timestamp") if at else df.agg(F.max(ts).cast("timestamp")).scalar()
    start = end - F.expr(f"interval {lookback} seconds")
    recent = df.where(F.col(ts).between(start, end)).select(
        *keys,
        seconds_between(F.col(ts), end).alias("_x"),
        F.col(value).cast("double").alias("_y"),
    )
    fitted = recent.groupBy(*keys).agg(
        F.regr_slope("_y", "_x").alias("slope"), F.regr_intercept("_y", "_x").alias("intercept")
    )
    return fitted.where(F.col("slope").isNotNull()).select(
        *keys, "slope", (F.col("intercept") + F.col("slope") * ahead).alias("predicted")
    )


def _with_context(df: DataFrame, ts: str, window: int, width: int) -> DataFrame:
    """Rows under every slice that needs them: their own, and the next if its windows reach back."""
    next_start = (F.col("_slice") + 1) * F.lit(width * 1_000_000)
    reaches = F.unix_micros(F.col(ts)) + F.lit(window * 1_000_000) >= next_start
    homes = F.when(reaches, F.array(F.col("_slice"), F.col("_slice") + 1)).otherwise(
        F.array(F.col("_slice"))
    )
    placed = df.withColumn("_home", F.explode(homes))
    return placed.withColumn("_own", F.col("_home") == F.col("_slice"))


def predict_rolling(df: DataFrame, ts: str, series: str | Sequence[str], value: str, lookback: int,
                    ahead: int) -> DataFrame:
    """The same prediction at every sample, from the ``lookback`` seconds before it.

    A slice is one look-back long, so a window is the beginning of its own slice and the end of the
    one before. Both are running statistics, one forwards and one backwards, and are put together
    at the sample: linear in the samples, and nothing is ever taken out of a sum again, so a large
    value leaves no rounding error behind. Time is measured from the start of the slice.
    """
    keys = _names(series)
    micros, span = F.unix_micros(F.col(ts)), lookback * 1_000_000
    sliced = df.select(*keys, ts, value, _slice(ts, lookback).alias("_slice"))
    placed = _with_context(sliced, ts, lookback, lookback)
    own, y = F.col("_own"), F.col(value).cast("double")
    timed = placed.withColumns(
        {
            # where a sample enters its own slice, or leaves the windows of the next one
            "_at": F.when(own, micros).otherwise(micros + F.lit(span)),
            "_x": (micros - F.col("_home") * F.lit(span)) / F.lit(1_000_000),
            "_new": F.when(own, y),
            "_old": F.when(~own, y),
        }
    )
    home = Window.partitionBy(*keys, "_home")
    parts = (("_new", home.orderBy("_at")), ("_old", home.orderBy(F.col("_at").desc())))
    running = {}
    for part, order in parts:
        so_far = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        for name, stat in (("n", F.regr_count), ("x", F.regr_avgx), ("y", F.regr_avgy), ("xx", F.regr_sxx), ("xy", F.regr_sxy)):
            running[f"{part}_{name}"] = F.coalesce(stat(part, "_x").over(so_far), F.lit(0))

    def stat(name: str) -> tuple[Column, Column]:
        return F.col(f"_new_{name}"), F.col(f"_old_{name}")

    (n1, n2), (x1, x2), (y1, y2) = stat("n"), stat("x"), stat("y")
    share = n2 / F.nullif(n1 + n2, F.lit(0))
    between = n1 * share
    sxx = sum(stat("xx")) + between * (x2 - x1) * (x2 - x1)
    sxy = sum(stat("xy")) + between * (x2 - x1) * (y2 - y1)
    since = F.col("_x") + ahead - (x1 + share * (x2 - x1))
    return (
        timed.withColumns(running)
        .where("_own")
        .withColumn("slope", sxy / F.nullif(sxx, F.lit(0.0)))
        .where(F.col("slope").isNotNull())
        .select(
            *keys, ts, value, "slope",
            (y1 + share * (y2 - y1) + F.col("slope") * since).alias("predicted"),
        )
    )


def ratio_below(df: DataFrame, part: str, whole: str, limit: float) -> DataFrame:
    """Samples whose part-to-whole ratio is under a limit; a zero whole never is."""
    ratio = F.col(part).cast("double") / F.nullif(F.col(whole).cast("double"), F.lit(0.0))
    return df.withColumn("ratio", ratio).where(F.col("ratio") < limit)


def metric_total(df: DataFrame, by: str | Sequence[str], value: str, how: str = "sum") -> DataFrame:
    """Samples folded over their labels with ``sum`` or ``max``."""
    fold = {"sum": F.sum, "max": F.max}[how]
    return df.groupBy(*_names(by)).agg(fold(value).alias(value))


def rename_metrics(df: DataFrame, name: str,
                   rules: list[tuple[str, str, tuple[str, ...]]] = METRIC_NAMES) -> DataFrame:
    """Dotted names to a metric name and a label map; a name no rule matches stays as it is, without labels."""
    parts = F.split(F.col(name), r"\.")
    metric, labels = F.lit(None).cast("string"), F.lit(None).cast("map<string,string>")
    for pattern, target, label_names in reversed(rules):
        segments = pattern.split(".")
        fits = F.size(parts) == len(segments)
        stars = []
        for place, segment in enumerate(segments):
            if segment == "*":
                stars.append(F.get(parts, F.lit(place)))
            else:
                fits = fits & (F.get(parts, F.lit(place)) == segment)
        pairs = [x for label, star in zip(label_names, stars) for x in (F.lit(label), star)]
        found = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
        metric = F.when(fits, F.lit(target)).otherwise(metric)
        labels = F.when(fits, found).otherwise(labels)
    bare = F.create_map().cast("map<string,string>")
    return df.withColumns({"metric": F.coalesce(metric, F.col(name)), "labels": F.coalesce(labels, bare)})
