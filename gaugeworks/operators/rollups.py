"""Silver to Gold: hourly and daily figures per device (AGG-1, AGG-2, PRJ-6..8).

Both roll-ups are grouped aggregates with a map-side part, so a device that owns
a third of all readings still sends one row per task and bucket.

Averages come from exact sums, so they do not depend on the order of rows or parts: two days
of equal readings have equal averages, and a deviation of 0 stays 0. Groups with numbers that the
exact form does not hold fall back to sums of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks import settings
from gaugeworks.functions import scalars

HOUR = "1 hour"


def sentinel_to_null(silver: DataFrame) -> DataFrame:
    return silver.withColumns({m: scalars.missing_to_null(F.col(m)) for m in settings.METRICS})


def _exact_sums(metric: str) -> tuple[Column, Column, Column]:
    """Sums of the two parts of all numbers, and whether they hold them; the last is null without numbers."""
    high, low, fits = scalars.split_number(F.col(metric))
    high, low = F.try_sum(high), F.try_sum(low)
    return high, low, F.when(F.count(metric) > 0, F.bool_and(fits) & high.isNotNull() & low.isNotNull())


def _mean(metric: str) -> Column:
    high, low, exact = _exact_sums(metric)
    return F.coalesce(F.when(exact, scalars.joined_mean(high, low, F.count(metric))), F.avg(metric))


def _figures() -> list[Column]:
    figures = []
    for metric in settings.METRICS:
        for name, fn in (("avg", _mean), ("min", F.min), ("max", F.max)):
            figures.append(fn(metric).alias(f"{name}_{metric}"))
    return [*figures, F.count("entry_id").alias("reading_count")]


def _figure_names() -> list[str]:
    return [f"{fn}_{m}" for m in settings.METRICS for fn in ("avg", "min", "max")] + ["reading_count"]


def hourly(readings: DataFrame, now=None) -> DataFrame:
    """Per device and epoch-aligned hour. Rows without a time fall out."""
    return (
        readings.groupBy("device_id", F.window("recorded_at", HOUR).alias("window"))
        .agg(*_figures())
        .withColumns(
            {
                "window_start": F.col("window.start"),
                "window_end": F.col("window.end"),
                "_computed_at": scalars.moment(now),
            }
        )
        .drop("window")
    )


def daily(readings: DataFrame, now=None) -> DataFrame:
    """Per device and date. Rows without a time share a null date."""
    return (
        readings.groupBy("device_id", F.to_date("recorded_at").alias("date"))
        .agg(*_figures())
        .withColumn("_computed_at", scalars.moment(now))
    )


def hour_parts(readings: DataFrame) -> DataFrame:
    """Mergeable hourly parts: both roll-ups follow from them after one scan.

    Averages do not merge, so sums and counts are kept. A null time stays as a
    group of its own for the daily roll-up.
    """
    parts = []
    for m in settings.METRICS:
        high, low, exact = _exact_sums(m)
        parts += [
            high.alias(f"high_{m}"),
            low.alias(f"low_{m}"),
            exact.alias(f"exact_{m}"),
            F.sum(m).alias(f"sum_{m}"),
            F.count(m).alias(f"n_{m}"),
            F.min(m).alias(f"min_{m}"),
            F.max(m).alias(f"max_{m}"),
        ]
    hour = F.date_trunc("hour", F.col("recorded_at")).alias("hour")
    return readings.groupBy("device_id", hour).agg(*parts, F.count("entry_id").alias("reading_count"))


def hourly_from_parts(parts: DataFrame, now=None) -> DataFrame:
    averages = {}
    for m in settings.METRICS:
        mean = scalars.joined_mean(F.col(f"high_{m}"), F.col(f"low_{m}"), F.col(f"n_{m}"))
        averages[f"avg_{m}"] = F.coalesce(F.when(F.col(f"exact_{m}"), mean), F.try_divide(f"sum_{m}", f"n_{m}"))
    return (
        parts.filter(F.col("hour").isNotNull())
        .withColumns(averages)
        .select(
            "device_id",
            *_figure_names(),
            F.col("hour").alias("window_start"),
            (F.col("hour") + F.expr(f"INTERVAL {HOUR}")).alias("window_end"),
            scalars.moment(now).alias("_computed_at"),
        )
    )


def daily_from_parts(parts: DataFrame, now=None) -> DataFrame:
    merged = []
    for m in settings.METRICS:
        n = F.sum(f"n_{m}")
        mean = scalars.joined_mean(F.try_sum(f"high_{m}"), F.try_sum(f"low_{m}"), n)
        merged += [
            F.coalesce(F.when(F.bool_and(f"exact_{m}"), mean), F.try_divide(F.sum(f"sum_{m}"), n)).alias(f"avg_{m}"),
            F.min(f"min_{m}").alias(f"min_{m}"),
            F.max(f"max_{m}").alias(f"max_{m}"),
        ]
    return (
        parts.groupBy("device_id", F.to_date("hour").alias("date"))
        .agg(*merged, F.sum("reading_count").alias("reading_count"))
        .withColumn("_computed_at", scalars.moment(now))
    )
