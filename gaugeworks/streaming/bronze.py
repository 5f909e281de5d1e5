"""Landing files to the Bronze table (SRC-1, PRJ-1, PRJ-2, SNK-1, SNK-2, STR-1..3)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.functions import scalars
from gaugeworks.sources.contract import check_contract, quarantined, valid_readings
from gaugeworks.sources.schemas import READING

AVAILABLE_NOW = "available_now"
CONTINUOUS = "continuous"
POLL_INTERVAL = "30 seconds"
POLL_SECONDS = 5
AUDIT = ("_ingested_at", "_source_file", "_batch_id")


@dataclass(frozen=True)
class Running:
    """A continuous job: its query, the one beside it if there is one, and their reports."""

    query: StreamingQuery
    aside: StreamingQuery | None
    reports: object

    def awaitTermination(self) -> None:  # noqa: N802 - as Spark's queries have it
        """Wait for the end of either query, and raise its failure."""
        queries = [q for q in (self.query, self.aside) if q is not None]
        while all(q.isActive for q in queries):
            queries[0].awaitTermination(POLL_SECONDS)
        self.stop()
        for q in queries:
            if q.exception() is not None:
                raise q.exception()

    def processAllAvailable(self) -> None:  # noqa: N802
        for q in (self.query, self.aside):
            if q is not None:
                q.processAllAvailable()

    def stop(self) -> None:
        for q in (self.query, self.aside):
            if q is not None:
                q.stop()
        self.reports.finish(self.query)

    @property
    def isActive(self) -> bool:  # noqa: N802
        return self.query.isActive and (self.aside is None or self.aside.isActive)


def landing_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """New JSON files, each exactly once, with the fixed schema.

    ``options`` go to the file source; ``maxFilesPerTrigger`` bounds a
    micro-batch and ``cleanSource`` keeps the folder listing short.
    """
    return spark.readStream.schema(READING).options(**options).json(path)


def landing_text_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """The same files as text lines, for the contract check."""
    return spark.readStream.schema("value string").options(**options).text(path)


def add_audit_columns(df: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Ingestion time, source file and one id per run; batch or streaming."""
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source_file": F.col("_metadata.file_path"),
            "_batch_id": F.lit(batch_id or str(uuid.uuid4())),
        }
    )


def to_bronze(landing: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Audit columns added, folder columns of the landing layout left out."""
    return add_audit_columns(landing, batch_id).select(*READING.names, *AUDIT)


def to_checked_bronze(lines: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Only readings that meet the contract."""
    return valid_readings(check_contract(add_audit_columns(lines, batch_id)), *AUDIT)


def to_quarantine(lines: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Only texts that break the contract, with the reasons."""
    return quarantined(check_contract(add_audit_columns(lines, batch_id))).select("value", "violations", *AUDIT)


def with_partition_date(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("_partition_date", F.to_date(scalars.parse_timestamp(F.col("recorded_at"))))


def append_stream(
    df: DataFrame, path: str, checkpoint: str, mode: str = AVAILABLE_NOW, partition_by: tuple[str, ...] = ()
) -> StreamingQuery:
    """Append to a Parquet folder. ``available_now`` takes what is there and
    waits for the end; ``continuous`` returns a query that polls."""
    if mode not in (AVAILABLE_NOW, CONTINUOUS):
        raise ValueError(f"mode {mode!r} is neither {AVAILABLE_NOW!r} nor {CONTINUOUS!r}")
    trigger = {"availableNow": True} if mode == AVAILABLE_NOW else {"processingTime": POLL_INTERVAL}
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(**trigger)
        .start(path)
    )
    if mode == AVAILABLE_NOW:
        query.awaitTermination()
    return query


def write_bronze(bronze: DataFrame, table: str, checkpoint: str, mode: str = AVAILABLE_NOW) -> StreamingQuery:
    return append_stream(with_partition_date(bronze), table, checkpoint, mode, ("_partition_date",))
