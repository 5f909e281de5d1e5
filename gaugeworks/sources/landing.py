"""The raw landing folder (SRC-3, SNK-8, SNK-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from gaugeworks.functions import scalars
from gaugeworks.sources.schemas import READING

PARTS = ("year", "month", "day", "hour")


def with_landing_parts(readings: DataFrame, now=None) -> DataFrame:
    """Adds the folder parts, taken from the write time."""
    return readings.select(*READING.names).withColumns(scalars.time_parts(scalars.moment(now)))


def write_landing(readings: DataFrame, path: str, now=None, rows_per_file: int = 0) -> None:
    """Compact JSON lines under ``year=/month=/day=/hour=``; nulls are written.

    Spark names the files uniquely, so writers never collide. ``rows_per_file``
    limits the size of a file; 1 gives one reading per file.
    """
    (
        with_landing_parts(readings, now)
        .write.mode("append")
        .partitionBy(*PARTS)
        .option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", rows_per_file)
        .json(path)
    )


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Scan with the fixed schema. Filters on the folder parts prune folders."""
    parts = [StructField(part, StringType()) for part in PARTS]
    return spark.read.schema(StructType(READING.fields + parts)).json(path)


def ordered_by_device(readings: DataFrame) -> DataFrame:
    """Hand-off in device order, each device by time (SNK-9).

    Range partitioning keeps every device in order over consecutive partitions
    and still splits a device that holds many rows.
    """
    order = ["device_id", "recorded_at", "entry_id"]
    return readings.repartitionByRange(*order).sortWithinPartitions(*order)
