"""Table statistics and row counts (AGG-9, AGG-10, AGG-21)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugeworks.sources.tables import read_if_exists


def table_stats(df: DataFrame, table_name: str, approximate: bool = False) -> DataFrame:
    """Rows, devices and the range of ``recorded_at``. Devices are counted
    exactly unless ``approximate`` is set."""
    devices = F.approx_count_distinct("device_id") if approximate else F.count_distinct("device_id")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        devices.alias("distinct_devices"),
        F.min("recorded_at").alias("min_recorded_at"),
        F.max("recorded_at").alias("max_recorded_at"),
    ).select(F.lit(table_name).alias("table_name"), "*")


def count_rows(df: DataFrame) -> DataFrame:
    """One row; over Parquet this reads no column data."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def table_row_count(spark: SparkSession, ref: str) -> DataFrame:
    """Row count of a stored table; 0 when there is no such table."""
    table = read_if_exists(spark, ref)
    return spark.sql("SELECT 0L AS row_count") if table is None else count_rows(table)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows while they are written, without another scan."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen
