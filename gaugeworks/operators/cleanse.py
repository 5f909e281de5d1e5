"""Bronze to Silver: types, timestamps, missing values, one row per key.

PRJ-3, PRJ-4, FLT-1, PRJ-5, WIN-1, PRJ-8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks import settings
from gaugeworks.functions import scalars


def cast_readings(df: DataFrame) -> DataFrame:
    """Metrics to double and the entry id to bigint; unparseable text to null."""
    columns = {name: F.col(name).try_cast("double") for name in settings.METRICS}
    columns["entry_id"] = F.col("entry_id").try_cast("bigint")
    return df.withColumns(columns)


def parse_recorded_at(df: DataFrame) -> DataFrame:
    return df.withColumn("recorded_at", scalars.parse_timestamp(F.col("recorded_at")))


def drop_unowned(df: DataFrame) -> DataFrame:
    """Rows without a device cannot be attributed."""
    return df.filter(F.col("device_id").isNotNull())


def fill_missing(df: DataFrame) -> DataFrame:
    """Null (and NaN) metrics to the sentinel."""
    return df.fillna(settings.MISSING, subset=list(settings.METRICS))


def clean(df: DataFrame, fill: bool = True) -> DataFrame:
    """Typed rows with a device. ``fill=False`` keeps nulls instead of sentinels."""
    typed = drop_unowned(parse_recorded_at(cast_readings(df)))
    return fill_missing(typed) if fill else typed


def latest_delivery(df: DataFrame) -> DataFrame:
    """One row per (device, entry): the newest ``_ingested_at``.

    Rows of one micro-batch share that time, so further columns break ties and
    the winner does not depend on the row order. Spark plans the rank filter as
    a group limit ahead of the shuffle: each task sends at most one row per key,
    however often the key repeats.
    """
    ties = [c for c in ("ingested_at", "_source_file", "recorded_at", *settings.METRICS) if c in df.columns]
    order = [F.col(c).desc_nulls_last() for c in ("_ingested_at", *ties)]
    rank = F.row_number().over(Window.partitionBy(*settings.KEYS).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def stamp_updated(df: DataFrame, now=None) -> DataFrame:
    return df.withColumn("_silver_updated_at", scalars.moment(now))


def to_silver(bronze: DataFrame, now=None, fill: bool = True) -> DataFrame:
    """The whole Silver step without the write."""
    return stamp_updated(latest_delivery(clean(bronze, fill)), now)
