"""A stream of readings to the landing layout (SNK-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.sources.landing import PARTS, with_landing_parts
from gaugeworks.streaming.bronze import AVAILABLE_NOW

BUFFER_INTERVAL = "60 seconds"
# About 5 MB of compact readings.
ROWS_PER_FILE = 20_000


def deliver(
    readings: DataFrame, path: str, checkpoint: str, mode: str = "continuous", rows_per_file: int = ROWS_PER_FILE
) -> StreamingQuery:
    """Buffered JSON files under ``year=/month=/day=/hour=`` of the write time."""
    trigger = {"availableNow": True} if mode == AVAILABLE_NOW else {"processingTime": BUFFER_INTERVAL}
    query = (
        with_landing_parts(readings)
        .writeStream.format("json")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*PARTS)
        .trigger(**trigger)
        .start(path)
    )
    if mode == AVAILABLE_NOW:
        query.awaitTermination()
    return query
