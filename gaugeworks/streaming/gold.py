"""Hourly Gold as a stream: hours close by watermark, late readings are kept aside (AGG-1, STR-1).

A run takes what is new in two steps. The first deals each micro-batch to two
folders: readings whose hour was closed by the readings of earlier batches are
late, all others are timely. The second is a windowed aggregate with state over the
timely ones; its watermark never passes the limit of the first step, so it drops no
row. Hours that late readings touch, and those still open, are computed anew when
Gold is read, from these hours' readings only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators import rollups
from gaugeworks.session import list_folders, path_exists
from gaugeworks.sources.tables import read_table

DELAY = "2 hours"
TIMELY, LATE, MARKS, HOURS = "timely", "late", "marks", "hours"


def _hour() -> Column:
    """Start of the hour, which the session's zone (UTC) makes the window's."""
    return F.date_trunc("hour", F.col("recorded_at"))


def _part(root: str, kind: str, batch: int) -> str:
    return f"{root}/{kind}/batch={batch:09d}"


def newest(spark: SparkSession, root: str, before: int | None = None):
    """The newest time of all batches, or of those ``before`` one; null without any. One row for each batch is read last."""
    batches = [int(name.partition("=")[2]) for name in list_folders(spark, f"{root}/{MARKS}") if name.startswith("batch=")]
    batches = [b for b in batches if before is None or b < before]
    return spark.read.schema("newest timestamp").parquet(_part(root, MARKS, max(batches))).head()[0] if batches else None


def _closed(at, delay: str) -> Column:
    """Whether the hour of ``recorded_at`` ends at or before the watermark that ``at`` gives."""
    limit = F.lit(at).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    return F.coalesce(_hour() + F.expr(f"INTERVAL {rollups.HOUR}") <= limit, F.lit(False))


def _deal(readings: DataFrame, root: str, checkpoint: str, delay: str) -> None:
    def deal(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # The mark is written last: a batch that is repeated after a failure keeps the files it wrote whole.
        if path_exists(spark, f"{_part(root, MARKS, number)}/_SUCCESS"):
            return
        before = newest(spark, root, number)
        timed = batch.where("recorded_at is not null")
        closed = _closed(before, delay)
        for kind, rows in ((TIMELY, timed.where(~closed)), (LATE, timed.where(closed))):
            if not path_exists(spark, f"{_part(root, kind, number)}/_SUCCESS"):
                rows.write.mode("overwrite").parquet(_part(root, kind, number))
        mark = timed.agg(F.greatest(F.max("recorded_at"), F.lit(before).cast("timestamp")).alias("newest"))
        mark.coalesce(1).write.mode("overwrite").parquet(_part(root, MARKS, number))

    query = (
        readings.writeStream.foreachBatch(deal).option("checkpointLocation", f"{checkpoint}/deal")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_hourly(readings: DataFrame, root: str, checkpoint: str, delay: str = DELAY, now=None) -> None:
    """Take all new readings of a stream and close the hours that the watermark has passed.

    ``readings`` have ``recorded_at`` as a timestamp; those without a time fall out, as in
    the batch roll-up. A run that was cut is finished by the next one. One run at a time.
    """
    spark = readings.sparkSession
    _deal(readings, root, checkpoint, delay)
    if not list_folders(spark, f"{root}/{TIMELY}"):
        return
    # All new files in one batch: two batches of one delivery could set the watermark between its files.
    timely = spark.readStream.schema(readings.schema).parquet(f"{root}/{TIMELY}/batch=*")
    query = (
        rollups.hourly(timely.withWatermark("recorded_at", delay), now)
        .writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/hours").trigger(availableNow=True).start(f"{root}/{HOURS}")
    )
    query.awaitTermination()


def closed_hours(spark: SparkSession, root: str) -> DataFrame:
    """The hours as they were when they closed."""
    return read_table(spark, f"{root}/{HOURS}")


def late_readings(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/{LATE}").drop("batch")


def hourly_now(spark: SparkSession, root: str, delay: str = DELAY, now=None) -> DataFrame:
    """Gold with every reading taken so far: closed hours, and anew those that are open or got late readings.

    Only devices and hours in need are aggregated again; the readings meet them by a join on both.
    """
    timely, late = read_table(spark, f"{root}/{TIMELY}").drop("batch"), late_readings(spark, root)
    key = ["device_id", "window_start"]
    hour = _hour().alias("window_start")
    touched = late.select("device_id", hour).distinct()
    at = newest(spark, root)
    still_open = timely.where(~_closed(at, delay))
    of_touched = timely.where(_closed(at, delay)).withColumn("window_start", _hour())
    again = touched.select(*(F.col(c).alias(f"_{c}") for c in key))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    rows = still_open.unionByName(late).unionByName(of_touched.join(again, same, "left_semi").drop("window_start"))
    return closed_hours(spark, root).join(again, same, "left_anti").unionByName(rollups.hourly(rows, now))
