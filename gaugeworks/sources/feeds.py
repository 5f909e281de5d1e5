"""Feed payloads to readings, and the channel dimension (SRC-6, SRC-8, JOIN-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks import settings
from gaugeworks.functions import scalars
from gaugeworks.operators.joins import join_dimension
from gaugeworks.sources.schemas import CHANNEL, PAYLOAD


def channel_dimension(spark: SparkSession, channels: list[tuple] | None = None) -> DataFrame:
    """Channel to device rows, (id, device[, name]). A missing name becomes
    ``channel_<id>``; no rows at all give the three defaults."""
    rows = [(c[0], c[1], c[2] if len(c) > 2 else None) for c in channels or settings.DEFAULT_CHANNELS]
    name = F.coalesce(F.col("name"), F.concat(F.lit("channel_"), F.col("channel_id").cast("string")))
    return spark.createDataFrame(rows, CHANNEL).withColumn("name", name)


def parse_feeds(payloads: DataFrame, channels: DataFrame, now=None) -> DataFrame:
    """(channel_id, payload) rows to readings; one per device of the channel.

    Only the first feed counts. A payload without feeds gives no reading; a feed
    without an entry id gets 0; blank or non-numeric fields become null.
    """
    feeds = F.from_json("payload", PAYLOAD)["feeds"]
    first = payloads.select("channel_id", F.explode(F.slice(feeds, 1, 1)).alias("feed"))
    entry_id = F.when(F.col("feed.entry_id").isNull(), F.lit(0)).otherwise(F.col("feed.entry_id").try_cast("bigint"))
    ingested_at = F.date_format(scalars.moment(now), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return join_dimension(first, channels, ["channel_id"]).select(
        "device_id",
        entry_id.alias("entry_id"),
        F.coalesce("feed.created_at", F.lit("")).alias("recorded_at"),
        scalars.parse_number(F.col("feed.field1")).alias("vibration_rms"),
        scalars.parse_number(F.col("feed.field2")).alias("temperature_celsius"),
        scalars.parse_number(F.col("feed.field3")).alias("pressure_bar"),
        F.col("channel_id").cast("int").alias("source_channel"),
        ingested_at.alias("ingested_at"),
    )
