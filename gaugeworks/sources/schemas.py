"""Explicit schemas; nothing is inferred (SRC-2)."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

READING = StructType(
    [
        StructField("device_id", StringType()),
        StructField("entry_id", LongType()),
        StructField("recorded_at", StringType()),
        StructField("vibration_rms", DoubleType()),
        StructField("temperature_celsius", DoubleType()),
        StructField("pressure_bar", DoubleType()),
        StructField("source_channel", IntegerType()),
        StructField("ingested_at", StringType()),
    ]
)

# Feed values arrive as text; a number in the JSON reads as its text too.
FEED = StructType(
    [
        StructField("entry_id", StringType()),
        StructField("created_at", StringType()),
        StructField("field1", StringType()),
        StructField("field2", StringType()),
        StructField("field3", StringType()),
    ]
)

PAYLOAD = StructType([StructField("feeds", ArrayType(FEED))])

CHANNEL = StructType(
    [
        StructField("channel_id", IntegerType()),
        StructField("device_id", StringType()),
        StructField("name", StringType()),
    ]
)

METRIC = StructType(
    [
        StructField("metric_name", StringType()),
        StructField("value", DoubleType()),
        StructField("unit", StringType()),
        StructField("dimensions", MapType(StringType(), StringType())),
        StructField("ts", TimestampType()),
    ]
)

ALARM_RULE = StructType(
    [
        StructField("rule", StringType()),
        StructField("metric_name", StringType()),
        StructField("statistic", StringType()),
        StructField("period_seconds", LongType()),
        StructField("evaluation_periods", LongType()),
        StructField("comparison", StringType()),
        StructField("threshold", DoubleType()),
        StructField("missing_data", StringType()),
        StructField("dimensions", MapType(StringType(), StringType())),
    ]
)
