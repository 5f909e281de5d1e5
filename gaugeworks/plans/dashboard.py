"""The five dashboard queries (Q-1..Q-5). ``as_of`` stands for "now"."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks import settings
from gaugeworks.functions import scalars
from gaugeworks.functions.scalars import rounded


def latest_reading(silver: DataFrame) -> DataFrame:
    """Newest reading per device (WIN-2); the higher entry id wins a tie.

    The rank filter is pushed ahead of the shuffle as a group limit: a task
    sends one row per device, also for a device with most of the readings.
    """
    order = [F.col("recorded_at").desc_nulls_last(), F.col("entry_id").desc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy("device_id").orderBy(*order))
    owned = silver.filter(F.col("device_id").isNotNull())
    return owned.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def twin_state(silver: DataFrame, as_of=None) -> DataFrame:
    minutes = scalars.whole_minutes(F.col("recorded_at"), scalars.moment(as_of))
    return (
        latest_reading(silver)
        .select(
            "device_id",
            F.col("recorded_at").alias("last_seen"),
            rounded("vibration_rms", 3, "vibration_rms_mm_s"),
            rounded("temperature_celsius", 2),
            rounded("pressure_bar", 3),
            minutes.alias("minutes_since_last_reading"),
            scalars.freshness(minutes).alias("data_freshness"),
            "source_channel",
            "entry_id",
        )
        .orderBy("device_id")
    )


def at_risk_devices(daily: DataFrame, as_of=None, days: int = settings.AT_RISK_DAYS) -> DataFrame:
    """Empty for the default 2-row z-score frame; see ``operators.scoring``."""
    since = F.date_sub(F.to_date(scalars.moment(as_of)), days)
    return (
        daily.filter(F.col("is_at_risk") & (F.col("date") >= since))
        .select(
            "device_id",
            "date",
            rounded("avg_vibration_rms", 3, "avg_vibration_rms_mm_s"),
            rounded("max_vibration_rms", 3, "max_vibration_rms_mm_s"),
            rounded("vibration_zscore", 3),
            "is_at_risk",
            "reading_count",
            rounded("avg_temperature_celsius", 2),
            rounded("avg_pressure_bar", 3),
            "_computed_at",
        )
        .orderBy(F.desc("vibration_zscore"), F.desc("date"))
    )


def vibration_trend(hourly: DataFrame, as_of=None, hours: int = settings.TREND_HOURS) -> DataFrame:
    since = F.timestamp_add("HOUR", F.lit(-hours), scalars.moment(as_of))
    if settings.HOURLY_PARTITION in hourly.columns:
        # The stored table is partitioned by date; this prunes the folders.
        hourly = hourly.filter(F.col(settings.HOURLY_PARTITION) >= F.to_date(since))
    return (
        hourly.filter((F.col("window_start") >= since) & F.col("device_id").isNotNull())
        .select(
            "device_id",
            "window_start",
            "window_end",
            rounded("avg_vibration_rms", 3, "avg_vibration_rms_mm_s"),
            rounded("max_vibration_rms", 3, "max_vibration_rms_mm_s"),
            rounded("min_vibration_rms", 3, "min_vibration_rms_mm_s"),
            "reading_count",
            scalars.exceeds(F.col("avg_vibration_rms"), settings.VIBRATION_LIMIT).alias("threshold_exceeded"),
            rounded("avg_temperature_celsius", 2),
            rounded("avg_pressure_bar", 3),
        )
        .orderBy("device_id", F.asc("window_start"))
    )


def _layer_health(table: DataFrame, name: str, layer: str, latest, as_of) -> DataFrame:
    """Rows, newest record and lag of one table (AGG-16)."""
    return table.agg(F.count(F.lit(1)).alias("row_count"), F.max(latest).alias("latest_record_at")).select(
        F.lit(name).alias("table_name"),
        F.lit(layer).alias("layer"),
        "row_count",
        "latest_record_at",
        scalars.whole_minutes(F.col("latest_record_at"), scalars.moment(as_of)).alias("data_lag_minutes"),
    )


def pipeline_health(
    bronze: DataFrame, silver: DataFrame, hourly: DataFrame, daily: DataFrame, as_of=None
) -> DataFrame:
    """Bronze times are text and are parsed before the maximum is taken."""
    layers = [
        (bronze, "bronze_sensors", "bronze", scalars.parse_timestamp(F.col("recorded_at"))),
        (silver, "silver_sensors", "silver", F.col("recorded_at")),
        (hourly, "gold_sensors_hourly", "gold", F.col("window_start")),
        (daily, "gold_sensors_daily", "gold", F.col("date").cast("timestamp")),
    ]
    health = None
    for table, name, layer, latest in layers:
        rows = _layer_health(table, name, layer, latest, as_of)
        health = rows if health is None else health.unionByName(rows)
    rank = F.when(F.col("layer") == "bronze", 1).when(F.col("layer") == "silver", 2).when(F.col("layer") == "gold", 3)
    return health.orderBy(rank.otherwise(4))


def daily_summary(daily: DataFrame, as_of=None, days: int = settings.SUMMARY_DAYS) -> DataFrame:
    since = F.date_sub(F.to_date(scalars.moment(as_of)), days)
    figures = []
    for metric, digits in (("temperature_celsius", 2), ("pressure_bar", 3)):
        figures += [rounded(f"{fn}_{metric}", digits) for fn in ("avg", "min", "max")]
    return (
        daily.filter(F.col("date") >= since)
        .select(
            "device_id",
            "date",
            "reading_count",
            *[rounded(f"{fn}_vibration_rms", 3, f"{fn}_vibration_rms_mm_s") for fn in ("avg", "min", "max")],
            rounded("vibration_zscore", 3),
            "is_at_risk",
            *figures,
            "_computed_at",
        )
        .orderBy(F.asc("device_id"), F.desc("date"))
    )
