"""Exact distinct device counts that can be merged over any dates (AGG-9, AGG-12, AGG-13).

Devices are numbered once. Each date keeps bitmaps of the numbers seen, in buckets of
32,768 devices, and dates are or-ed into weeks or all time without rereading rows. A
bitmap has a fixed size, so no task holds the devices of a date as a set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Devices of one bitmap; fixed by Spark's bitmap functions.
BUCKET = 32_768


def numbered(devices: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``device_id, number`` for each device of ``devices`` that ``known`` does not hold; null is left out.

    Numbers count up within a partition, so they fill few buckets. The result must be stored before it is
    used twice; ``known`` is the stored table, which the result extends.
    """
    ids = devices.select("device_id").filter(F.col("device_id").isNotNull()).distinct()
    start = 0
    if known is not None:
        ids = ids.join(known.select("device_id"), "device_id", "left_anti")
        last = known.agg(F.max("number")).head()[0] or 0
        start = -(-last // BUCKET) * BUCKET
    # Spark's buckets count from 1.
    return ids.select("device_id", (F.monotonically_increasing_id() + 1 + start).alias("number"))


def date_bitmaps(days: DataFrame, numbers: DataFrame, flags: dict[str, Column] | None = None) -> DataFrame:
    """``date, bucket, seen`` and a bitmap for each flag; ``days`` has ``device_id`` and ``date``, repeats allowed.

    A flag is a condition over ``days``; its bitmap holds the devices that met it on the date.
    """
    flags = flags or {}
    placed = days.select("device_id", "date", *[cond.alias(name) for name, cond in flags.items()]).join(numbers, "device_id")
    position = F.bitmap_bit_position("number")
    return placed.groupBy("date", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(position).alias("seen"),
        *[F.bitmap_construct_agg(F.when(F.col(name), position)).alias(name) for name in flags],
    )


#: Period of each row, by the start of the period; all time has none.
PERIODS = {
    "day": lambda date: date,
    "week": lambda date: F.trunc(date, "week"),
    "all": lambda date: F.lit(None).cast("date"),
}


def counts(bitmaps: DataFrame, maps: dict[str, str], periods: tuple[str, ...] = ("day", "week", "all")) -> DataFrame:
    """``period, period_start`` and the distinct devices of each of ``maps`` (bitmap column -> name of the count)."""
    spans = F.array(*[F.struct(F.lit(p).alias("period"), PERIODS[p](F.col("date")).alias("period_start")) for p in periods])
    each = bitmaps.select("*", F.inline(spans))
    merged = each.groupBy("period", "period_start", "bucket").agg(*[F.bitmap_or_agg(name).alias(name) for name in maps])
    return merged.groupBy("period", "period_start").agg(
        *[F.sum(F.bitmap_count(name)).cast("long").alias(alias) for name, alias in maps.items()]
    )


def count_between(bitmaps: DataFrame, first, last, name: str = "seen") -> DataFrame:
    """``devices``: how many distinct devices a range of dates saw, ends included; one row."""
    chosen = bitmaps.filter((F.col("date") >= F.lit(first).cast("date")) & (F.col("date") <= F.lit(last).cast("date")))
    merged = chosen.groupBy("bucket").agg(F.bitmap_or_agg(name).alias("bits"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias("devices"))
