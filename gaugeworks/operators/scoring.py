"""Rolling z-scores and the risk flag (WIN-3..6, PRJ-9, PRJ-10).

With a frame of n rows that includes the current one, a z-score of finite values
cannot exceed (n-1)/sqrt(n). The default frame of 2 rows therefore never reaches
the risk threshold of 2.5; from 9 rows on it can. Pass ``frame_rows`` for a
longer history, or use the true 24-hour frame over hourly rows.

The windows run over rolled-up rows, so one device contributes at most one row
per day or hour, however many readings it sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gaugeworks import settings
from gaugeworks.functions import scalars

DAY_SECONDS = 24 * 3600
HOUR_SECONDS = 3600


def _zscore(value: str, frame: WindowSpec) -> Column:
    return scalars.guarded_zscore(F.col(value), F.avg(value).over(frame), F.stddev_samp(value).over(frame))


def zscore_daily(
    daily: DataFrame, frame_rows: int = settings.RISK_FRAME_ROWS, value: str = "avg_vibration_rms"
) -> DataFrame:
    """Z-score over the last ``frame_rows`` daily rows of a device, gaps ignored."""
    frame = Window.partitionBy("device_id").orderBy("date").rowsBetween(1 - frame_rows, 0)
    return daily.withColumn("vibration_zscore", _zscore(value, frame))


def zscore_days(daily: DataFrame, days: int, value: str = "avg_vibration_rms") -> DataFrame:
    """Z-score over the last ``days`` calendar days of a device, gaps respected."""
    day = F.unix_date("date").cast("bigint")
    frame = Window.partitionBy("device_id").orderBy(day).rangeBetween(1 - days, 0)
    return daily.withColumn("vibration_zscore", _zscore(value, frame))


def zscore_24h(hourly: DataFrame, value: str = "avg_vibration_rms") -> DataFrame:
    """Z-score over the 24 hours ending with the current hour, gaps respected."""
    seconds = F.unix_seconds("window_start")
    frame = Window.partitionBy("device_id").orderBy(seconds).rangeBetween(HOUR_SECONDS - DAY_SECONDS, 0)
    return hourly.withColumn("vibration_zscore", _zscore(value, frame))


def flag_risk(scored: DataFrame, threshold: float = settings.RISK_ZSCORE) -> DataFrame:
    return scored.withColumn("is_at_risk", F.col("vibration_zscore") > F.lit(threshold))


def score_daily(daily: DataFrame, frame_rows: int = settings.RISK_FRAME_ROWS) -> DataFrame:
    return flag_risk(zscore_daily(daily, frame_rows))
