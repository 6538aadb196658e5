"""The alert rules over metric samples; each gives the samples or stretches that would fire.

A stretch ends where no sample comes for ``max_gap`` seconds; set it above the sample interval.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmark.operators.metrics import (
    STALE_AFTER,
    hold,
    increase,
    metric_total,
    predict_rolling,
)

# Limits, windows and hold times (seconds) of the rules.
FAILED_RUN_WINDOW = 1_800
IMPORT_ERROR_HOLD = 600
CONSUMER_LAG_LIMIT = 10_000
CONSUMER_LAG_HOLD = 600
DISK_LOW_RATIO = 0.25
DISK_LOW_HOLD = 900
DISK_CRITICAL_RATIO = 0.18
DISK_CRITICAL_HOLD = 300
DISK_LOOKBACK = 21_600
DISK_AHEAD = 86_400
DISK_FORECAST_HOLD = 1_800


def failed_runs(counter: DataFrame, ts: str, series: str, value: str) -> DataFrame:
    """Samples at which a failure counter grew within the last half hour."""
    return increase(counter, ts, series, value, FAILED_RUN_WINDOW).where(F.col("increase") > 0)


def import_errors(gauge: DataFrame, ts: str, series: str, value: str, max_gap: int = STALE_AFTER) -> DataFrame:
    return hold(gauge, ts, series, F.col(value) > 0, IMPORT_ERROR_HOLD, max_gap=max_gap)


def lagging_consumers(lag: DataFrame, ts: str, group: str, value: str,
                      limit: int = CONSUMER_LAG_LIMIT, duration: int = CONSUMER_LAG_HOLD,
                      max_gap: int = STALE_AFTER) -> DataFrame:
    """Consumer groups whose lag, summed over topics and partitions, stays above a limit."""
    total = metric_total(lag, [group, ts], value)
    return hold(total, ts, group, F.col(value) > limit, duration, max_gap=max_gap)


def low_share(samples: DataFrame, ts: str, series: str, part: str, whole: str,
              limit: float = DISK_LOW_RATIO, duration: int = DISK_LOW_HOLD,
              max_gap: int = STALE_AFTER) -> DataFrame:
    """Stretches in which the share of free space stays under a limit; a zero size never counts."""
    share = F.col(part).cast("double") / F.nullif(F.col(whole).cast("double"), F.lit(0.0))
    shares = samples.withColumn("share", share)
    return hold(shares, ts, series, F.col("share") < limit, duration, max_gap=max_gap)


def critical_share(samples: DataFrame, ts: str, series: str, part: str, whole: str,
                   max_gap: int = STALE_AFTER) -> DataFrame:
    return low_share(samples, ts, series, part, whole, DISK_CRITICAL_RATIO, DISK_CRITICAL_HOLD, max_gap)


def will_run_out(gauge: DataFrame, ts: str, series: str, value: str, lookback: int = DISK_LOOKBACK,
                 ahead: int = DISK_AHEAD, duration: int = DISK_FORECAST_HOLD,
                 max_gap: int = STALE_AFTER) -> DataFrame:
    """Stretches in which the trend of the last hours stays below zero a day ahead."""
    forecast = predict_rolling(gauge, ts, series, value, lookback, ahead)
    return hold(forecast, ts, series, F.col("predicted") < 0, duration, max_gap=max_gap)
