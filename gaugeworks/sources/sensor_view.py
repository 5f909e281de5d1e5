"""Sensor readings as a view over the ``events`` table.

Every event becomes a reading, and every tenth is delivered a second time a day
later with a changed value, so that de-duplication has work to do. Some keys and
values are blanked to exercise the null handling. No event is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import pin_utc

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


#: The first date; the second delivery of :func:`moving_deliveries` leaves it without readings.
EMPTIED = "2024-01-01"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def spread(events: DataFrame) -> DataFrame:
    """The events dealt over all cores, for costly work on each row: a file with few row groups is read by few tasks."""
    return events.repartition(events.sparkSession.sparkContext.defaultParallelism * 2, "event_id")


def device_name(user_id: Column) -> Column:
    return F.format_string("device-%06d", user_id)


def _readings(events: DataFrame) -> DataFrame:
    """Readings of events that say whether they are delivered ``again``."""

    def blanked(every: int, value: Column) -> Column:
        return F.when(F.col("event_id") % every != 0, value)

    bump = F.when(F.col("again"), F.lit(1.0)).otherwise(F.lit(0.0))
    day, minute = F.expr("INTERVAL '1' DAY"), F.expr("INTERVAL '1' MINUTE")
    return events.select(
        blanked(97, device_name(F.col("user_id"))).alias("device_id"),
        F.col("event_id").alias("entry_id"),
        F.date_format("ts", ISO_FORMAT).alias("recorded_at"),
        blanked(11, F.col("value") + bump).alias("vibration_rms"),
        blanked(17, F.get_json_object("props", "$.k").cast("double")).alias("temperature_celsius"),
        blanked(13, (F.lit(1.0) + (F.col("event_id") % 100) * F.lit(0.01)).cast("double")).alias("pressure_bar"),
        (F.col("user_id") % 3).cast("int").alias("source_channel"),
        F.when(F.col("again"), F.col("ts") + day).otherwise(F.col("ts") + minute).alias("_ingested_at"),
    )


def first_deliveries(events: DataFrame) -> DataFrame:
    return _readings(events.withColumn("again", F.lit(False)))


def second_deliveries(events: DataFrame) -> DataFrame:
    return _readings(events.filter(F.col("event_id") % 10 == 0).withColumn("again", F.lit(True)))


def moving_deliveries(events: DataFrame, again: bool) -> DataFrame:
    """Raw readings in two deliveries; the second moves readings to the next day.

    It holds every tenth event and all events of ``EMPTIED``, so that no reading is
    left on that date. Some readings have no entry id.
    """
    day = F.expr("INTERVAL '1' DAY")
    if again:
        events = events.filter((F.col("event_id") % 10 == 0) | (F.to_date("ts") == F.lit(EMPTIED).cast("date")))
        events = events.withColumn("ts", F.col("ts") + day)
    readings = _readings(spread(events).withColumn("again", F.lit(again)))
    entry_id = F.when(F.col("entry_id") % 89 != 0, F.col("entry_id"))
    return readings.withColumn("entry_id", entry_id).withColumn("ingested_at", F.date_format("_ingested_at", ISO_FORMAT))


def bronze_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows: all events, plus the re-deliveries, from one scan."""
    deliveries = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return _readings(read_events(spark, sf_dir).select("*", F.explode(deliveries).alias("again")))


def feed_payloads(events: DataFrame) -> DataFrame:
    """A feed payload per event, with a second, older feed that must be ignored.

    Some payloads have no feeds, no entry id, blank or non-numeric fields.
    """

    def every(n: int) -> Column:
        return F.col("event_id") % n == 0

    entry = F.when(every(19), "").otherwise(F.concat(F.lit('"entry_id":'), F.col("event_id").cast("string"), F.lit(",")))
    field1 = F.when(every(7), "N/A").otherwise(F.col("value").cast("string"))
    field2 = F.when(every(5), " ").otherwise(F.concat(F.lit(" "), F.get_json_object("props", "$.k"), F.lit(" ")))
    feed = F.concat(
        F.lit("{"),
        entry,
        F.lit('"created_at":"'), F.date_format("ts", ISO_FORMAT),
        F.lit('","field1":"'), field1,
        F.lit('","field2":"'), field2,
        F.lit('","field3":'), F.when(every(3), "null").otherwise(F.col("user_id").cast("string")),
        F.lit("}"),
    )
    older = F.lit(',{"entry_id":1,"created_at":"2000-01-01T00:00:00Z","field1":"0"}')
    feeds = F.when(every(11), "").otherwise(F.concat(feed, older))
    channel = F.when(F.col("user_id") % 2 == 0, 9).otherwise(276330)
    return events.select(
        channel.alias("channel_id"),
        F.concat(F.lit('{"channel":{"name":"c"},"feeds":['), feeds, F.lit("]}")).alias("payload"),
    )


def untimed_payloads(events: DataFrame) -> DataFrame:
    """The feed payloads; every 23rd has an empty time."""
    untimed = spread(events).withColumn("untimed", F.col("event_id") % 23 == 0)
    rows = feed_payloads(untimed.filter("NOT untimed"))
    emptied = F.regexp_replace("payload", r'("feeds":\[\{[^}]*?"created_at":")[^"]*', "$1")
    return rows.unionByName(feed_payloads(untimed.filter("untimed")).withColumn("payload", emptied))


def raw_texts(events: DataFrame) -> DataFrame:
    """A raw JSON text per event; some break the contract in one of several ways."""

    def nth(k: int) -> Column:
        return F.col("event_id") % 20 == k

    device = F.when(nth(1), "").otherwise(F.concat(F.lit('"device_id":"'), device_name(F.col("user_id")), F.lit('",')))
    entry = F.col("event_id").cast("string")
    recorded = F.concat(F.lit('"'), F.date_format("ts", ISO_FORMAT), F.lit('"'))
    text = F.concat(
        F.lit("{"),
        device,
        F.lit('"entry_id":'), F.when(nth(2), F.concat(F.lit('"'), entry, F.lit('"'))).otherwise(entry),
        F.lit(',"recorded_at":'), F.when(nth(3), "null").when(nth(9), '"soon"').otherwise(recorded),
        F.lit(',"vibration_rms":'), F.when(nth(4), '"high"').when(nth(5), "null").when(nth(10), "1e999").otherwise(F.col("value").cast("string")),
        F.when(nth(6), ',"firmware":"v1","batch":7').otherwise(""),
        F.lit(',"source_channel":'), F.when(nth(11), "99999999999").otherwise((F.col("user_id") % 3).cast("string")),
        F.when(nth(7), "").otherwise("}"),
    )
    return events.select(F.col("event_id"), F.when(nth(8), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text).alias("value"))


def computed_feed(events: DataFrame) -> DataFrame:
    """The time at which Gold was last computed, reported after every third event."""
    none = F.create_map().cast("map<string,string>")
    return events.filter(F.col("event_id") % 3 == 0).select(
        F.lit("GoldTableLastComputed").alias("metric_name"), F.unix_seconds("ts").cast("double").alias("value"),
        F.lit("None").alias("unit"), none.alias("dimensions"), "ts",
    )


def table_feed(events: DataFrame) -> DataFrame:
    """The metrics of the dashboard's hourly curves, as they would stand after each event."""
    seen = F.col("event_id") + 1
    values = {
        "BronzeRowCount": seen,
        "SilverRowCount": F.floor(seen * 9 / 10),
        "GoldHourlyRowCount": F.floor(seen / 2),
        "GoldDailyRowCount": F.floor(seen / 10),
        "AtRiskDeviceCount": F.col("user_id") % 7,
        "MaxVibrationZScore": F.floor("value"),
    }
    rows = F.array(
        *[F.struct(F.lit(name).alias("metric_name"), value.cast("double").alias("value")) for name, value in values.items()]
    )
    none = F.create_map().cast("map<string,string>")
    return events.select("ts", F.inline(rows)).select(
        "metric_name", "value", F.lit("Count").alias("unit"), none.alias("dimensions"), "ts"
    )


def metric_feed(events: DataFrame) -> DataFrame:
    """Metric rows as the platform would report them for each event."""
    none = F.create_map().cast("map<string,string>")
    per_device = F.create_map(F.lit("DeviceId"), device_name(F.col("user_id")))
    stages = F.element_at(F.array(F.lit("Bronze"), F.lit("Silver"), F.lit("Gold")), (F.col("event_id") % 3 + 1).cast("int"))

    def metric(name: Column, value: Column, unit: str, dimensions: Column) -> Column:
        return F.struct(
            name.alias("metric_name"),
            value.cast("double").alias("value"),
            F.lit(unit).alias("unit"),
            dimensions.alias("dimensions"),
        )

    rows = F.array_compact(
        F.array(
            metric(F.lit("RecordsIngested"), F.lit(1), "Count", per_device),
            metric(F.concat(stages, F.lit("WriteLatencyMs")), F.col("value") * 10, "Milliseconds", none),
            metric(F.lit("GetRecords.IteratorAgeMilliseconds"), F.col("value") * 150, "Milliseconds", none),
            metric(F.lit("GoldTableLastUpdate"), F.unix_seconds("ts"), "None", none),
            F.when(F.col("event_type") == "error", metric(F.lit("PipelineErrors"), F.lit(1), "Count", per_device)),
        )
    )
    return events.select("ts", F.inline(rows)).select("metric_name", "value", "unit", "dimensions", "ts")
