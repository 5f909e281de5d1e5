"""The jobs of the platform (PIPE-1..6, SRC-9) and their order.

Tables are the only hand-off between jobs, so each can be rerun by itself.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks import settings
from gaugeworks.operators import health, metrics, quality
from gaugeworks.operators.layout import compact, finish_swap, fragmented
from gaugeworks.operators.upsert import read_upserted
from gaugeworks.plans import gold
from gaugeworks.plans.silver import SilverStep, apply_batch
from gaugeworks.functions.scalars import compact_json
from gaugeworks.session import staged
from gaugeworks.sources.feeds import channel_dimension, parse_feeds
from gaugeworks.sources.json_schema import Contract, split_once
from gaugeworks.sources.landing import write_landing
from gaugeworks.sources.schemas import READING
from gaugeworks.sources.tables import drop_partitions, is_path, read_if_exists, read_table, write_table
from gaugeworks.streaming import bronze as bronze_stream
from gaugeworks.streaming.progress import BatchReports
from gaugeworks.streaming.silver import bronze_stream as new_bronze_files
from gaugeworks.streaming.silver import upsert_stream


@dataclass(frozen=True)
class Locations:
    """Where everything lives; all paths are arguments of the jobs."""

    landing: str
    bronze: str
    silver: str
    hourly: str
    daily: str
    metrics: str
    quality: str
    quarantine: str
    checkpoints: str
    pending_dates: str

    @classmethod
    def under(cls, root: str) -> Locations:
        root = root.rstrip("/")
        return cls(
            landing=f"{root}/landing",
            bronze=f"{root}/bronze_sensors",
            silver=f"{root}/silver_sensors",
            hourly=f"{root}/gold_sensors_hourly",
            daily=f"{root}/gold_sensors_daily",
            metrics=f"{root}/metrics",
            quality=f"{root}/quality",
            quarantine=f"{root}/quarantine",
            checkpoints=f"{root}/checkpoints",
            pending_dates=f"{root}/pending_dates",
        )


def _report_latency(spark: SparkSession, stage_name: str, started: float, where: Locations) -> None:
    begin, end = (datetime.fromtimestamp(t, timezone.utc) for t in (started, time.time()))
    run = spark.createDataFrame(
        [(stage_name, None, begin, end)], "stage string, device_id string, started_at timestamp, finished_at timestamp"
    )
    metrics.publish(metrics.stage_latencies(run), where.metrics)


def _report_count(table: DataFrame, name: str, where: Locations) -> None:
    counted = health.count_rows(table)
    metrics.publish(counted.select(*metrics.metric_row(name, F.col("row_count"), "Count", F.current_timestamp())), where.metrics)


def run_landing(
    spark: SparkSession,
    payloads: DataFrame,
    where: Locations,
    channels: list[tuple] | None = None,
    contract: Contract | None = None,
) -> None:
    """Feed payloads to landing files, with ingest counts per device (PIPE-5). Payloads are parsed once.

    With a ``contract`` the readings are checked before they land; those that break it
    go to quarantine as they would have been written.
    """
    if contract is not None:
        texts = parse_feeds(payloads, channel_dimension(spark, channels)).select(compact_json(*READING.names).alias("value"))

        def land(valid: DataFrame) -> None:
            # The landing schema's own types, as without a contract.
            readings = valid.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in READING.fields])
            write_landing(readings, where.landing)
            metrics.publish(metrics.ingest_counts(readings), where.metrics)

        split_once(texts, contract, land, lambda bad: write_table(bad, where.quarantine, "append"))
        return
    with staged(parse_feeds(payloads, channel_dimension(spark, channels)), "readings") as readings:
        write_landing(readings, where.landing)
        metrics.publish(metrics.ingest_counts(readings), where.metrics)


def run_bronze(
    spark: SparkSession,
    where: Locations,
    mode: str = bronze_stream.AVAILABLE_NOW,
    check_contract: bool = False,
    **source_options,
):
    """New landing files to Bronze (PIPE-1). Quality and latency are reported for every
    micro-batch, in both modes, while the query runs. With ``check_contract`` bad texts
    go to the quarantine table, by a second query with a checkpoint of its own, so
    both sides are exactly-once; a failure of either is raised."""
    aside = None
    if check_contract:
        lines = bronze_stream.landing_text_stream(spark, where.landing, **source_options)
        incoming = bronze_stream.to_checked_bronze(lines)
        aside = bronze_stream.append_stream(
            bronze_stream.to_quarantine(lines), where.quarantine, f"{where.checkpoints}/quarantine", mode
        )
    else:
        incoming = bronze_stream.to_bronze(bronze_stream.landing_stream(spark, where.landing, **source_options))
    measures = [rule.measure().alias(rule.name) for rule in quality.STANDARD_RULES]
    watched = incoming.observe("bronze_quality", *measures)

    def report(progress) -> None:
        seen = progress.observedMetrics.get("bronze_quality")
        if seen is not None and progress.numInputRows > 0:
            write_table(quality.observed_results(spark, "bronze_sensors", seen.asDict()), where.quality, "append")
            metrics.publish(metrics.progress_latencies(spark, "Bronze", [progress]), where.metrics)

    reports = BatchReports(spark, "bronze_quality", report)
    query = bronze_stream.write_bronze(watched, where.bronze, f"{where.checkpoints}/bronze", mode)
    if mode != bronze_stream.AVAILABLE_NOW:
        return bronze_stream.Running(query, aside, reports)
    reports.finish(query)
    _report_count(read_table(spark, where.bronze), "BronzeRowCount", where)
    return query


def run_silver(
    spark: SparkSession,
    where: Locations,
    incremental: bool = False,
    block_size: int | None = None,
    null_safe: bool = True,
    split_blocks: bool = False,
    **source_options,
) -> None:
    """Bronze to Silver (PIPE-2): all of Bronze, or only its new files.

    Incremental runs leave the dates they changed for :func:`refresh_pending`.
    """
    started = time.time()
    if incremental:

        def keep(step: SilverStep) -> None:
            write_table(step.quality, where.quality, "append")

        stream = new_bronze_files(spark, where.bronze, **source_options)
        upsert_stream(
            stream, where.silver, f"{where.checkpoints}/silver", block_size, null_safe, keep,
            on_dates=lambda dates: publish_dates(dates, where), split_blocks=split_blocks,
        )
    else:
        step = apply_batch(read_table(spark, where.bronze), where.silver, block_size, null_safe, split_blocks=split_blocks)
        write_table(step.quality, where.quality, "append")
    _report_count(read_upserted(spark, where.silver), "SilverRowCount", where)
    _report_latency(spark, "Silver", started, where)


def publish_dates(dates: DataFrame, where: Locations) -> None:
    """Leave dates to refresh, under an id of their own, so that readers know which they have read."""
    tagged = dates.select("date", F.lit(f"dates-{uuid.uuid4().hex}").alias("_published"))
    write_table(tagged, where.pending_dates, "append", ("_published",))


def run_gold(
    spark: SparkSession,
    where: Locations,
    frame_rows: int = settings.RISK_FRAME_ROWS,
    skip_optimize: bool = False,
    dates: DataFrame | None = None,
) -> None:
    """Silver to both Gold tables (PIPE-3); all dates unless some are given."""
    started = time.time()
    silver = read_upserted(spark, where.silver)
    for ref in filter(is_path, (where.hourly, where.daily)):
        # A compaction that was cut ends before its dates are written again, never after.
        finish_swap(spark, ref)
    if dates is None:
        gold.rebuild(silver, where.hourly, where.daily, frame_rows)
    else:
        gold.refresh(silver, where.hourly, where.daily, dates, frame_rows)
    if not skip_optimize:
        for ref, column, by in (
            (where.hourly, gold.HOURLY_PARTITION, ("device_id", "window_start")),
            # A partition holds one date, so the device alone orders it.
            (where.daily, gold.DAILY_PARTITION, ("device_id",)),
        ):
            # Writes size their files, so few partitions need this, if any.
            if is_path(ref) and (worn := fragmented(read_table(spark, ref), column)):
                compact(spark, ref, column, *by, only=worn, zorder=True)
    daily = read_table(spark, where.daily)
    _report_count(read_table(spark, where.hourly), "GoldHourlyRowCount", where)
    _report_count(daily, "GoldDailyRowCount", where)
    metrics.publish(metrics.risk_metrics(daily), where.metrics)
    _report_latency(spark, "Gold", started, where)


def refresh_pending(
    spark: SparkSession, where: Locations, frame_rows: int = settings.RISK_FRAME_ROWS, skip_optimize: bool = False
) -> None:
    """Refresh Gold for the dates that Silver batches left pending. Those read are
    dropped only afterwards, so a failed refresh is made up by the next one; dates
    that a Silver job leaves meanwhile stay for the next one, too."""
    pending = read_if_exists(spark, where.pending_dates)
    if pending is None:
        return
    with staged(pending, "pending") as read:
        # One id for each Silver batch since the last refresh.
        published = [row[0] for row in read.select("_published").distinct().collect()]
        if not published:
            return
        run_gold(spark, where, frame_rows, skip_optimize, dates=read.select("date").distinct())
        drop_partitions(spark, where.pending_dates, "_published", published)


def run_metrics(spark: SparkSession, where: Locations, as_of=None, dry_run: bool = False) -> DataFrame:
    """A snapshot of the stored tables, appended to the metrics table (PIPE-4); a dry run only returns it."""
    rows = metrics.snapshot(
        read_table(spark, where.bronze),
        read_upserted(spark, where.silver),
        read_table(spark, where.hourly),
        read_table(spark, where.daily),
        as_of,
    )
    if not dry_run:
        metrics.publish(rows, where.metrics)
    return rows


def run_all(
    spark: SparkSession,
    where: Locations,
    incremental: bool = False,
    frame_rows: int = settings.RISK_FRAME_ROWS,
    skip_optimize: bool = False,
    check_contract: bool = False,
    null_safe: bool = True,
    split_blocks: bool = False,
    **source_options,
) -> None:
    """Bronze, Silver, Gold, metrics, in this order (PIPE-6).

    Incremental runs take what is new through Silver and then refresh the dates
    it changed.
    """
    run_bronze(spark, where, check_contract=check_contract, **source_options)
    if not incremental:
        run_silver(spark, where, null_safe=null_safe, split_blocks=split_blocks)
        run_gold(spark, where, frame_rows, skip_optimize)
    else:
        run_silver(spark, where, incremental=True, null_safe=null_safe, split_blocks=split_blocks, **source_options)
        refresh_pending(spark, where, frame_rows, skip_optimize)
    run_metrics(spark, where)
