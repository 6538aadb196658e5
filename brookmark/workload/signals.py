"""Freshness, anomaly, counters, alerts and rates."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from brookmark.operators import alerts as A
from brookmark.operators import metrics as M
from brookmark.operators.star import daily_net_revenue
from brookmark.sources import fixture
from brookmark.specs import CATALOG
from brookmark.streaming.alerts import ENDED, hold_stream
from brookmark.streaming.rates import message_rate
from brookmark.workload.keyed import work_folder
from brookmark.workload.shapes import NOW, with_stages


#: Hourly samples: an hour without one ends a stretch.
HOURLY_GAP = 3600


def _events(spark, d):
    return fixture.base(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _daily(spark, d):
    return daily_net_revenue(fixture.orders(spark, d))


def _rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


def event_counter(spark, d):
    """Running number of events per type and minute; restarts from zero every midnight."""
    minute = F.date_trunc("minute", "ts").alias("minute")
    counted = _events(spark, d).groupBy("event_type", minute).agg(F.count(F.lit(1)).alias("n"))
    today = Window.partitionBy("event_type", F.to_date("minute")).orderBy("minute")
    return counted.select("event_type", "minute", F.sum("n").over(today).alias("value"))


def hourly_gauge(spark, d):
    hour = F.date_trunc("hour", "ts").alias("hour")
    amount = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return _events(spark, d).groupBy("event_type", hour).agg(
        F.count(F.lit(1)).alias("n"), amount.alias("value")
    )


def alert_hold(spark, d):
    """Event types with at least three events in every hour for two hours or more."""
    return M.hold(hourly_gauge(spark, d), "hour", "event_type", F.col("n") >= 3, 7200, max_gap=HOURLY_GAP)


def alert_hold_stream(spark, d):
    """The stretches of ``alert_hold`` from a stream that stops between three loads of samples.

    A last sample of another series lets the time pass after which the open stretches end.
    """
    root = work_folder(spark)
    hourly_gauge(spark, d).write.parquet(f"{root}/gauge")
    gauge = spark.read.parquet(f"{root}/gauge")
    ends = gauge.agg(F.percentile_approx("hour", [0.33, 0.66]).alias("cut"), F.max("hour").alias("last")).first()
    if ends["last"] is None:
        return M.hold(gauge, "hour", "event_type", F.col("n") >= 3, 7200, max_gap=HOURLY_GAP)
    first, second = (F.lit(c) for c in ends["cut"])
    clock = gauge.limit(1).withColumns({"event_type": F.lit("clock"), "hour": F.lit(ends["last"] + timedelta(days=1)), "n": F.lit(0).cast("long")})
    loads = [gauge.where(F.col("hour") <= first), gauge.where((F.col("hour") > first) & (F.col("hour") <= second)), gauge.where(F.col("hour") > second), clock]
    for load in loads:
        load.write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(gauge.schema).parquet(f"{root}/landed")
        fired = hold_stream(stream, "hour", "event_type", F.col("n") >= 3, 7200, max_gap=HOURLY_GAP)
        fired.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(
            f"{root}/fired", format="parquet", outputMode="append"
        ).awaitTermination()
    return spark.read.parquet(f"{root}/fired").where(F.col("state") == ENDED).drop("state")


def ratio_alert(spark, d):
    """Hours in which less than a quarter of the events were clicks, held for an hour or more."""
    hour = F.date_trunc("hour", "ts").alias("hour")
    hourly = _events(spark, d).groupBy(hour).agg(
        F.count_if(F.col("event_type") == "click").alias("clicks"), F.count(F.lit(1)).alias("n")
    )
    whole = hourly.withColumn("series", F.lit("events"))
    return A.low_share(whole, "hour", "series", "clicks", "n", A.DISK_LOW_RATIO, 3600, HOURLY_GAP)


def low_ratio_hours(spark, d):
    """Hours of a type in which its value per event is under five."""
    return _rounded(M.ratio_below(hourly_gauge(spark, d), "value", "n", 5.0), "ratio")


def metric_names(spark, d):
    """Events as dotted metric names, renamed to metrics with labels and summed per label."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    dotted = (
        F.when(kind == "signup", F.concat(F.lit("airflow.dagrun.duration.success.u"), user))
        .when(kind == "error", F.concat(F.lit("airflow.dagrun.duration.failed.u"), user))
        .when(kind == "click", F.concat(F.lit("airflow.dag.clicks.u"), user, F.lit(".duration")))
        .when(kind == "view", F.lit("airflow.etl.rows_synced.views"))
        .otherwise(F.concat(F.lit("airflow.unknown."), kind))
    )
    named = M.rename_metrics(_events(spark, d).select(dotted.alias("name"), "value"), "name")
    flat = named.select(
        "metric", F.col("labels")["dag_id"].alias("dag_id"), F.col("labels")["task_id"].alias("task_id"),
        F.col("labels")["table"].alias("source_table"), F.col("value").cast("decimal(18,2)").alias("value"),
    )
    total = M.metric_total(flat, ["metric", "dag_id", "task_id", "source_table"], "value")
    return total.withColumn("value", F.col("value").cast("decimal(28,2)"))


def lag_alert(spark, d):
    """Types whose hourly event count summed over users exceeds a limit for a stretch of time."""
    hour = F.date_trunc("hour", "ts").alias("hour")
    per_user = _events(spark, d).groupBy("event_type", "user_id", hour).agg(F.count(F.lit(1)).alias("lag"))
    return A.lagging_consumers(per_user, "hour", "event_type", "lag", limit=2, max_gap=HOURLY_GAP)


def predicted(spark, d):
    out = M.predict_linear(
        hourly_gauge(spark, d), "hour", "event_type", "value",
        A.DISK_LOOKBACK, A.DISK_AHEAD,
    )
    return _rounded(_rounded(out, "slope", digits=10), "predicted")


def predicted_hourly(spark, d):
    out = M.predict_rolling(
        hourly_gauge(spark, d), "hour", "event_type", "value", A.DISK_LOOKBACK, A.DISK_AHEAD
    )
    return _rounded(_rounded(out, "slope", digits=10), "predicted")


def _freshness(spark, d):
    return M.freshness(fixture.operational(spark, d), CATALOG, F.lit(NOW).cast("timestamp"))


QUERIES = {
    "freshness": _freshness,
    "stale_sources": lambda spark, d: M.stale_sources(_freshness(spark, d)),
    "revenue_z": lambda spark, d: _rounded(M.revenue_z(_daily(spark, d)), "mean", "z"),
    "revenue_z_calendar": lambda spark, d: _rounded(
        M.revenue_z(_daily(spark, d), calendar=True), "mean", "z"
    ),
    "rolling_z": lambda spark, d: _rounded(M.rolling_z(_daily(spark, d)), "mean", "z"),
    "revenue_anomalies": lambda spark, d: _rounded(
        M.revenue_anomalies(M.rolling_z(_daily(spark, d)), 2.0), "mean", "z"
    ),
    "event_increase": lambda spark, d: M.increase(
        event_counter(spark, d), "minute", "event_type", "value", A.FAILED_RUN_WINDOW
    ),
    "failed_runs": lambda spark, d: A.failed_runs(
        event_counter(spark, d).where(F.col("event_type") == "error"), "minute", "event_type", "value"
    ),
    "run_out_alert": lambda spark, d: A.will_run_out(
        hourly_gauge(spark, d), "hour", "event_type", "value", max_gap=HOURLY_GAP
    ),
    "predict_hourly": predicted_hourly,
    "low_ratio_hours": low_ratio_hours,
    "event_rate": lambda spark, d: _rounded(
        M.rate(event_counter(spark, d), "minute", "event_type", "value", 300), "rate", digits=9
    ),
    "alert_hold": alert_hold,
    "alert_hold_stream": alert_hold_stream,
    "ratio_alert": ratio_alert,
    "lag_alert": lag_alert,
    "predict_linear": predicted,
    "metric_names": metric_names,
    "message_rate": lambda spark, d: _rounded(
        message_rate(_events(spark, d), "ts", "event_type"), "per_second", digits=9
    ),
}

_ROLLING = """
    select day, cast(revenue as double) as value,
           count(revenue) over w as history_days, avg(cast(revenue as double)) over w as mean,
           stddev_pop(cast(revenue as double)) over w as deviation
    from net_daily where revenue is not null
    window w as (order by day rows between 30 preceding and 1 preceding)"""

_COUNTER = """
    counted as (select event_type, date_trunc('minute', ts) as minute, count(*) as n from events group by 1, 2),
    samples as (select event_type, minute, cast(sum(n) over (partition by event_type, cast(minute as date)
                order by minute) as bigint) as value from counted),
    before as (select *, lag(value) over (partition by event_type order by minute) as prev from samples),
    deltas as (select event_type, minute, value, case when prev is null then 0 when value < prev then value
               else value - prev end as delta from before)"""


def _grown(minutes: int) -> str:
    return (
        "cast(sum(delta) over (partition by event_type order by minute"
        f" range between interval '{minutes}' minute preceding and current row) as bigint)"
    )


def _z_sql(daily: str) -> str:
    return f"""
        select l.day, l.value as latest, round(h.mean, 6) as mean,
               round(case when h.deviation > 0 then (l.value - h.mean) / h.deviation else 0 end, 6) as z
        from (select day, cast(revenue as double) as value from {daily} n order by day desc limit 1) l
        cross join (select avg(value) as mean, stddev_pop(value) as deviation, count(*) as days
              from (select cast(revenue as double) as value from {daily} n order by day desc limit 30 offset 1) x) h
        where h.days >= 7"""


def _held(source: str, key: str, condition: str, seconds: int) -> str:
    return f"""
        select {key}, min(hour) as since, max(hour) as until, count(*) as samples,
               cast(epoch(max(hour)) - epoch(min(hour)) as double) as held_seconds
        from (select *, sum(case when {condition} and hour - prev <= interval 1 hour then 0 else 1 end)
                      over (partition by {key} order by hour) as island
              from (select *, lag(hour) over (partition by {key} order by hour) as prev from ({source}) h) g) i
        where {condition} group by {key}, island
        having epoch(max(hour)) - epoch(min(hour)) >= {seconds}"""


_HOURLY = """select event_type, date_trunc('hour', ts) as hour, count(*) as n,
             cast(sum(cast(value as decimal(18,2))) as double) as value from events group by 1, 2"""
_TREND = f"""
    select event_type, hour, value, case when points > 1 then s end as slope,
           case when points > 1 then b + s * (epoch(hour) - epoch(date '2024-01-01') + 86400) end as predicted
    from (select event_type, hour, value, count(*) over w as points,
                 regr_slope(value, epoch(hour) - epoch(date '2024-01-01')) over w as s,
                 regr_intercept(value, epoch(hour) - epoch(date '2024-01-01')) over w as b
          from ({_HOURLY}) h
          window w as (partition by event_type order by hour
                       range between interval '6' hour preceding and current row)) r"""
_LAGS = """
    select * from (
        select 'customers' as table_name, max(updated_at) as newest from raw_customers
        union all select 'products', max(updated_at) from raw_products
        union all select 'orders', max(updated_at) from raw_orders
        union all select 'order_items', max(updated_at) from raw_items) n where newest is not null"""
_LAG = f"""select table_name, cast(epoch(timestamp '{NOW}') - epoch(newest) as double) as lag_seconds
           from ({_LAGS}) f"""

ORACLE = {
    "freshness": with_stages(_LAG),
    "stale_sources": with_stages(f"select * from ({_LAG}) s where lag_seconds > 172800"),
    "revenue_z": with_stages(_z_sql("net_daily")),
    "revenue_z_calendar": with_stages(_z_sql("""(
        select s.day, coalesce(n.revenue, 0) as revenue from
          (select cast(unnest(generate_series(min(day), max(day), interval '1' day)) as date) as day
           from net_daily) s left join net_daily n on s.day = n.day)""")),
    "rolling_z": with_stages(f"""
        select day, value, round(mean, 6) as mean,
               round(case when deviation > 0 then (value - mean) / deviation else 0 end, 6) as z
        from ({_ROLLING}) r where history_days >= 7"""),
    "revenue_anomalies": with_stages(f"""
        select day, value, round(mean, 6) as mean, round((value - mean) / deviation, 6) as z
        from ({_ROLLING}) r where history_days >= 7 and deviation > 0
        and abs((value - mean) / deviation) > 2"""),
    "event_increase": f"with {_COUNTER} select event_type, minute, value, {_grown(30)} as increase from deltas",
    "failed_runs": f"""with {_COUNTER} select * from (
        select event_type, minute, value, {_grown(30)} as increase from deltas) g
        where event_type = 'error' and increase > 0""",
    "run_out_alert": _held(
        f"select *, coalesce(predicted < 0, false) as low from ({_TREND}) t where slope is not null",
        "event_type", "low", 1800,
    ),
    "predict_hourly": f"""select event_type, hour, value, round(slope, 10) as slope,
        round(predicted, 6) as predicted from ({_TREND}) t where slope is not null""",
    "low_ratio_hours": f"""select event_type, hour, n, value, round(value / n, 6) as ratio
        from ({_HOURLY}) h where value / n < 5""",
    "event_rate": f"""with {_COUNTER} select event_type, minute, value,
        round(cast({_grown(5)} as double) / 300.0, 9) as rate from deltas""",
    "alert_hold": _held(_HOURLY, "event_type", "n >= 3", 7200),
    "alert_hold_stream": _held(_HOURLY, "event_type", "n >= 3", 7200),
    "ratio_alert": _held(
        """select 'events' as series, date_trunc('hour', ts) as hour, count(*) as n,
           count(case when event_type = 'click' then 1 end) as clicks from events group by 1, 2""",
        "series", "clicks / cast(n as double) < 0.25", 3600,
    ),
    "lag_alert": _held(_HOURLY, "event_type", "n > 2", 600),
    "predict_linear": f"""
        with h as ({_HOURLY}), m as (select max(hour) as newest from h),
        x as (select event_type, value as y, epoch(hour) - epoch(newest) as x from h cross join m
              where epoch(hour) - epoch(newest) >= -21600)
        select event_type, round(regr_slope(y, x), 10) as slope,
               round(regr_intercept(y, x) + regr_slope(y, x) * 86400, 6) as predicted
        from x group by 1 having count(distinct x) > 1""",
    "metric_names": """
        select case event_type when 'signup' then 'airflow_dagrun_duration_success'
                    when 'error' then 'airflow_dagrun_duration_failed' when 'click' then 'airflow_task_duration'
                    when 'view' then 'etl_rows_synced' else 'airflow.unknown.' || event_type end as metric,
               case event_type when 'click' then 'clicks' when 'signup' then 'u' || cast(user_id as varchar)
                    when 'error' then 'u' || cast(user_id as varchar) end as dag_id,
               case when event_type = 'click' then 'u' || cast(user_id as varchar) end as task_id,
               case when event_type = 'view' then 'views' end as source_table,
               cast(sum(cast(value as decimal(18,2))) as decimal(28,2)) as value
        from events group by 1, 2, 3, 4""",
    "message_rate": """
        select time_bucket(interval '5' minute, ts) as window_start, event_type, count(*) as messages,
               round(count(*) / 300.0, 9) as per_second from events group by 1, 2""",
}
