"""The registered queries: each operator over the whole ``events`` table.

Doubles are rounded to 6 digits, since sums of doubles depend on the order of
rows, and timestamps lose their zone. "Now" is the day after the newest event.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampType

from gaugeworks import settings
from gaugeworks.functions import scalars
from gaugeworks.operators import alarms, blocks, cleanse, distinct, health, layout, metrics, pyramid, quality, rollups, scoring, series
from gaugeworks.operators.upsert import read_upserted, upsert
from gaugeworks.plans import dashboard, gold, jobs
from gaugeworks.plans.oracle import BRONZE_FILES
from gaugeworks.session import stage, work_path
from gaugeworks.sources import contract, json_schema, landing
from gaugeworks.sources import sensor_view as view
from gaugeworks.sources.feeds import channel_dimension, parse_feeds
from gaugeworks.sources.schemas import READING
from gaugeworks.sources.tables import read_table, run_sql, write_table
from gaugeworks.streaming import bronze as bronze_stream
from gaugeworks.streaming import delivery
from gaugeworks.streaming import gold as gold_stream
from gaugeworks.streaming.silver import bronze_stream as new_bronze_files
from gaugeworks.streaming.silver import upsert_stream

AS_OF = "2024-01-31 00:00:00"
FIRST_PERIOD = "2024-01-01 00:00:00"
MIDDLE = "2024-01-16 00:00:00"
RECOMPUTED_SINCE = "2024-01-25"
# The default frame of 2 rows cannot reach the threshold; 14 days can.
RISK_FRAME = 14

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_SILVER = ("device_id", "entry_id", "recorded_at", *settings.METRICS, "source_channel")


def neat(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DoubleType):
            column = F.round(column, 6)
        elif isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def settled(df: DataFrame) -> DataFrame:
    """Sums of doubles vary in the last bits with the order of rows; rounding to
    6 digits first keeps a later rounding to 2 or 3 digits from flipping."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({name: F.round(name, 6) for name in doubles})


def register(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: neat(build(spark, sf_dir))
    return build


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse.latest_delivery(cleanse.clean(view.bronze_readings(spark, sf_dir)))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.sentinel_to_null(_silver(spark, sf_dir))


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.hourly(_readings(spark, sf_dir), AS_OF)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.daily(_readings(spark, sf_dir), AS_OF)


def _risk_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_daily(_daily(spark, sf_dir), RISK_FRAME)


def _stored_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """All four tables. Silver and the hourly parts are stored, as the jobs do,
    because several branches read them."""
    silver = stage(_silver(spark, sf_dir), "silver")
    parts = stage(rollups.hour_parts(rollups.sentinel_to_null(silver)), "hour-parts")
    daily = stage(scoring.score_daily(rollups.daily_from_parts(parts, AS_OF), RISK_FRAME), "daily")
    return view.bronze_readings(spark, sf_dir), silver, rollups.hourly_from_parts(parts, AS_OF), daily


# Cleansing


@register
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse.clean(view.bronze_readings(spark, sf_dir))


@register
def silver_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@register
def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first deliveries make the table, the second ones are upserted."""
    events = view.read_events(spark, sf_dir)
    path = work_path(spark, "silver")
    for delivered in (view.first_deliveries(events), view.second_deliveries(events)):
        upsert(cleanse.latest_delivery(cleanse.clean(delivered)), path)
    return read_upserted(spark, path)


#: Blocks that the queries on splitting end with, about: their limit follows from the size of the table.
SPLIT_BLOCKS = 200


def _in_blocks(spark: SparkSession, batches: list[DataFrame], rows: int) -> DataFrame:
    path = work_path(spark, "silver-blocks")
    for delivered in batches:
        blocks.upsert_blocks(cleanse.latest_delivery(cleanse.clean(delivered)), path, limit=max(rows // SPLIT_BLOCKS, 1))
    return blocks.read_blocks(spark, path)


@register
def silver_upsert_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One device makes the table, then all devices come, then updates; blocks split on the way."""
    events = view.read_events(spark, sf_dir)
    size = events.agg(F.count("*"), F.min("user_id")).head()
    first = view.first_deliveries(events)
    one = view.first_deliveries(events.filter(F.col("user_id") == size[1]))
    return _in_blocks(spark, [one, first, view.second_deliveries(events)], size[0])


@register
def silver_upsert_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even ids, then odd ones, which hit no stored row, then updates, which hit some blocks' rows."""
    events = view.read_events(spark, sf_dir)
    even, odd = (view.first_deliveries(events.filter(F.col("event_id") % 2 == rest)) for rest in (0, 1))
    return _in_blocks(spark, [even, odd, view.second_deliveries(events)], events.count())


@register
def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by two runs of the incremental job over the Bronze table."""
    events = view.read_events(spark, sf_dir)
    bronze, silver, checkpoint = (work_path(spark, n) for n in ("bronze", "silver", "checkpoint"))
    for delivered in (view.first_deliveries(events), view.second_deliveries(events)):
        write_table(delivered, bronze, "append")
        upsert_stream(new_bronze_files(spark, bronze), silver, checkpoint)
    return read_upserted(spark, silver).drop("_silver_updated_at")


def _moving_landing(spark: SparkSession, sf_dir: str, where: jobs.Locations, again: bool) -> None:
    readings = view.moving_deliveries(view.read_events(spark, sf_dir), again)
    landing.write_landing(readings, where.landing, AS_OF)


@register
def silver_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings without entry id: the incremental job keeps the newest of each device."""
    where = jobs.Locations.under(work_path(spark, "null-keys"))
    for again in (False, True):
        _moving_landing(spark, sf_dir, where, again)
        jobs.run_bronze(spark, where)
        jobs.run_silver(spark, where, incremental=True)
    return read_upserted(spark, where.silver).select(*_SILVER)


@register
def pipeline_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing to Gold; the second delivery moves readings to other dates and empties one."""
    where = jobs.Locations.under(work_path(spark, "pipeline-full"))
    for again in (False, True):
        _moving_landing(spark, sf_dir, where, again)
        jobs.run_all(spark, where, frame_rows=RISK_FRAME)
    return read_table(spark, where.daily).drop("_computed_at")


@register
def pipeline_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by increments: only what is new goes through Silver, only changed dates through Gold."""
    where = jobs.Locations.under(work_path(spark, "pipeline-incremental"))
    for again in (False, True):
        _moving_landing(spark, sf_dir, where, again)
        jobs.run_all(spark, where, incremental=True, frame_rows=RISK_FRAME)
    return read_table(spark, where.daily).drop("_computed_at")


# Roll-ups and scores


@register
def sentinel_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(spark, sf_dir)


@register
def gold_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly(spark, sf_dir).drop("_computed_at")


@register
def gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir).drop("_computed_at")


@register
def gold_daily_from_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = rollups.hour_parts(_readings(spark, sf_dir))
    return rollups.daily_from_parts(parts).drop("_computed_at")


@register
def gold_hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries, each taken by a run of the stream: the first half, the second, and a tenth of all, late."""
    readings = stage(_readings(spark, sf_dir), "readings")
    root, feed = work_path(spark, "gold-stream"), work_path(spark, "feed")
    is_late = F.coalesce(F.col("entry_id") % 10 == 3, F.lit(False))
    first = F.coalesce(F.col("recorded_at") < F.lit(MIDDLE).cast("timestamp"), F.lit(False))
    for rows in (readings.where(first & ~is_late), readings.where(~first & ~is_late), readings.where(is_late)):
        rows.write.mode("append").parquet(feed)
        new = spark.readStream.schema(readings.schema).parquet(feed)
        gold_stream.run_hourly(new, root, f"{root}/checkpoint", now=AS_OF)
    return gold_stream.hourly_now(spark, root, now=AS_OF).drop("_computed_at")


@register
def gold_hourly_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = rollups.hour_parts(_readings(spark, sf_dir))
    return rollups.hourly_from_parts(parts).drop("_computed_at")


@register
def zscore_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.zscore_daily(_daily(spark, sf_dir))
    return scored.select("device_id", "date", "avg_vibration_rms", "vibration_zscore")


@register
def zscore_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.zscore_days(_daily(spark, sf_dir), RISK_FRAME)
    return scored.select("device_id", "date", "avg_vibration_rms", "vibration_zscore")


@register
def zscore_24h_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.zscore_24h(_hourly(spark, sf_dir))
    return scored.select("device_id", "window_start", "avg_vibration_rms", "vibration_zscore")


@register
def zscore_split_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 24-hour score with every device's series cut into pieces of three days."""
    scored = series.zscore_24h(_hourly(spark, sf_dir), piece=3 * scoring.DAY_SECONDS)
    return scored.select("device_id", "window_start", "avg_vibration_rms", "vibration_zscore")


@register
def zscore_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily score over the last 14 rows, in pieces of 20 rows."""
    daily = stage(_daily(spark, sf_dir), "daily")
    scored = scoring.flag_risk(series.zscore_daily(daily, RISK_FRAME, piece=20))
    return scored.select("device_id", "date", "avg_vibration_rms", "vibration_zscore", "is_at_risk")


@register
def risk_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _risk_daily(spark, sf_dir)
    return scored.select("device_id", "date", "avg_vibration_rms", "vibration_zscore", "is_at_risk")


@register
def daily_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily Gold table with the default frame."""
    return scoring.score_daily(_daily(spark, sf_dir)).drop("_computed_at")


@register
def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold built from the first deliveries, then refreshed for the dates that
    the second deliveries changed."""
    events = view.read_events(spark, sf_dir)
    silver, hourly, daily = (work_path(spark, n) for n in ("silver", "hourly", "daily"))
    upsert(cleanse.latest_delivery(cleanse.clean(view.first_deliveries(events))), silver)
    gold.rebuild(read_upserted(spark, silver), hourly, daily, RISK_FRAME)
    again = cleanse.latest_delivery(cleanse.clean(view.second_deliveries(events)))
    dates = upsert(again, silver, track_dates=True)
    gold.refresh(read_upserted(spark, silver), hourly, daily, dates, RISK_FRAME)
    return read_table(spark, daily).drop("_computed_at")


# Quality and health


@register
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check(_silver(spark, sf_dir), "silver_sensors", quality.STANDARD_RULES + quality.PHYSICAL_RULES)


@register
def dq_report_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before nulls become sentinels, so that the null rates mean something."""
    return quality.check(view.bronze_readings(spark, sf_dir), "bronze_sensors")


@register
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summarize(dq_report_bronze(spark, sf_dir).unionByName(dq_report(spark, sf_dir)))


@register
def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.table_stats(_silver(spark, sf_dir), "silver_sensors")


@register
def table_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table and one that does not exist."""
    stored = health.table_row_count(spark, f"{sf_dir}/events.parquet").withColumn("table_name", F.lit("events"))
    absent = health.table_row_count(spark, f"{sf_dir}/no_such_table").withColumn("table_name", F.lit("no_such_table"))
    return stored.unionByName(absent)


@register
def devices_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct devices of each day, week and of all time, and those at risk, from bitmaps by date."""
    daily = stage(_risk_daily(spark, sf_dir), "daily")
    numbers = stage(distinct.numbered(daily), "device-numbers")
    bitmaps = stage(distinct.date_bitmaps(daily, numbers, {"at_risk": F.col("is_at_risk")}), "device-bitmaps")
    return distinct.counts(bitmaps, {"seen": "devices", "at_risk": "devices_at_risk"})


@register
def sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(
        spark,
        "SELECT device_id, count(*) AS readings, max(vibration_rms) AS max_vibration_rms FROM silver_sensors "
        "WHERE recorded_at < :as_of GROUP BY device_id",
        {"silver_sensors": _silver(spark, sf_dir)},
        as_of=AS_OF,
    )


# Dashboards


@register
def twin_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.twin_state(_silver(spark, sf_dir), AS_OF)


@register
def at_risk_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.at_risk_devices(settled(_risk_daily(spark, sf_dir)), AS_OF)


@register
def trend_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.vibration_trend(settled(_hourly(spark, sf_dir)), AS_OF)


@register
def pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.pipeline_health(*_stored_tables(spark, sf_dir), AS_OF)


@register
def daily_summary_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.daily_summary(settled(_risk_daily(spark, sf_dir)), AS_OF)


# Metrics and alarms


@register
def metrics_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metrics.snapshot(*_stored_tables(spark, sf_dir), as_of="2024-01-30 12:00:00")
    return rows.select("metric_name", "value", "unit", "ts")


@register
def metrics_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot as the metrics table holds it after it was published."""
    where = jobs.Locations.under(work_path(spark, "metrics"))
    rows = metrics.snapshot(*_stored_tables(spark, sf_dir), as_of="2024-01-30 12:00:00")
    metrics.publish(rows, where.metrics)
    return read_table(spark, where.metrics).select("metric_name", "value", "unit", "ts")


@register
def ingest_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = metrics.ingest_counts(cleanse.drop_unowned(view.bronze_readings(spark, sf_dir)), AS_OF)
    return counts.select("metric_name", F.col("dimensions")["DeviceId"].alias("device_id"), "value", "unit", "ts")


@register
def stage_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = view.bronze_readings(spark, sf_dir).select(
        F.lit("Bronze").alias("stage"),
        "device_id",
        scalars.parse_timestamp(F.col("recorded_at")).alias("started_at"),
        F.col("_ingested_at").alias("finished_at"),
    )
    rows = metrics.stage_latencies(runs)
    return rows.select("metric_name", F.col("dimensions")["DeviceId"].alias("device_id"), "value", "unit", "ts")


@register
def metric_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rollup(view.metric_feed(view.read_events(spark, sf_dir)), 300)


@register
def metric_rollup_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rollup(view.metric_feed(view.read_events(spark, sf_dir)), 86400)


@register
def dashboard_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.dashboard_curves(view.metric_feed(view.read_events(spark, sf_dir)), AS_OF)


def _all_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = view.read_events(spark, sf_dir)
    return view.metric_feed(events).unionByName(view.table_feed(events))


@register
def metric_rollup_pyramid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five minutes are stored; hours and days are merged from them, percentiles refined in the sketches' bands."""
    feed = _all_metrics(spark, sf_dir)
    parts = stage(pyramid.base_parts(feed), "metric-parts")
    return pyramid.pyramid(feed, parts, (300, 3600, 86400))


@register
def dashboard_curves_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fifteen curves, hourly ones included, over the look-back window."""
    feed = _all_metrics(spark, sf_dir)
    until = scalars.moment(AS_OF)
    since = F.timestamp_add("HOUR", F.lit(-metrics.LOOKBACK_HOURS), until)
    return pyramid.stored_curves(feed, stage(pyramid.base_parts(feed), "metric-parts"), since, until)


@register
def alarm_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = alarms.default_rules(AS_OF, gold_metric="GoldTableLastUpdate") + [
        ("device-errors", "PipelineErrors", "SampleCount", 3600, 2, alarms.AT_LEAST, 1.0, alarms.NOT_BREACHING,
         {"DeviceId": "device-000003"}),
    ]
    feed = view.metric_feed(view.read_events(spark, sf_dir))
    return alarms.evaluate(feed, alarms.rules_frame(spark, rules), FIRST_PERIOD, AS_OF)


@register
def alarm_state_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five default rules as they are, Gold's on its last computation, and a rule of its own for every device."""
    events = view.read_events(spark, sf_dir)
    feed = view.metric_feed(events).unionByName(view.computed_feed(events))
    devices = events.select(view.device_name(F.col("user_id")).alias("device_id"))
    each = alarms.rules_per_device(devices, "PipelineErrors", "Sum", 86400, 2, alarms.AT_LEAST, 1.0, alarms.NOT_BREACHING)
    rules = alarms.rules_frame(spark, alarms.default_rules(AS_OF)).unionByName(each)
    return alarms.evaluate(feed, rules, FIRST_PERIOD, AS_OF)


# Sources and sinks


@register
def feed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = view.feed_payloads(view.read_events(spark, sf_dir))
    return parse_feeds(payloads, channel_dimension(spark)).drop("ingested_at")


@register
def contract_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = contract.check_contract(view.raw_texts(view.read_events(spark, sf_dir)))
    return contract.valid_readings(checked)


@register
def contract_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = contract.check_contract(view.raw_texts(view.read_events(spark, sf_dir)))
    return contract.quarantined(checked).select("event_id", "value", F.array_join("violations", ";").alias("violations"))


@register
def contract_from_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw text with its violations and, if there are none, its typed fields, by the schema document."""
    rules = json_schema.compile_schema(json_schema.READING_SCHEMA)
    rows = json_schema.checked(view.raw_texts(view.read_events(spark, sf_dir)), rules)
    return rows.select("event_id", F.array_join("violations", ";").alias("violations"), "reading.*")


@register
def landing_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds, some without a time, through the contract: what landed, and what was set aside and why."""
    where = jobs.Locations.under(work_path(spark, "landing-checked"))
    payloads = view.untimed_payloads(view.read_events(spark, sf_dir))
    jobs.run_landing(spark, payloads, where, contract=json_schema.compile_schema(json_schema.READING_SCHEMA))
    landed = landing.read_landing(spark, where.landing).select("device_id", "entry_id", "recorded_at", *settings.METRICS)
    aside = read_table(spark, where.quarantine)
    field = lambda name: F.get_json_object("value", f"$.{name}")
    refused = aside.select(
        field("device_id").alias("device_id"), field("entry_id").cast("bigint").alias("entry_id"),
        field("recorded_at").alias("recorded_at"), *[field(m).cast("double").alias(m) for m in settings.METRICS],
        F.array_join("violations", ";").alias("violations"),
    )
    return landed.withColumn("violations", F.lit("")).unionByName(refused)


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = view.first_deliveries(view.read_events(spark, sf_dir))
    return first.withColumn("ingested_at", F.date_format("_ingested_at", view.ISO_FORMAT)).select(*READING.names)


@register
def landing_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "landing")
    landing.write_landing(raw_readings(spark, sf_dir), path, AS_OF)
    return landing.read_landing(spark, path)


@register
def ordered_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.ordered_by_device(raw_readings(spark, sf_dir))


@register
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files through the stream; the second run finds nothing new."""
    source, table, checkpoint = (work_path(spark, n) for n in ("landing", "bronze", "checkpoint"))
    landing.write_landing(raw_readings(spark, sf_dir), source, AS_OF)
    for _ in range(2):
        bronze = bronze_stream.to_bronze(bronze_stream.landing_stream(spark, source))
        bronze_stream.write_bronze(bronze, table, checkpoint)
    return read_table(spark, table).drop(*bronze_stream.AUDIT)


@register
def bronze_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit columns of two runs: rows, runs, and rows whose file is no landing file; rows are
    counted once more while the table is copied."""
    where = jobs.Locations.under(work_path(spark, "bronze-audit"))
    for again in (False, True):
        _moving_landing(spark, sf_dir, where, again)
        jobs.run_bronze(spark, where)
    bronze, seen = health.counted(read_table(spark, where.bronze), "bronze-rows")
    write_table(bronze, f"{where.bronze}_copy", "overwrite")
    return read_table(spark, where.bronze).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("_batch_id").alias("runs"),
        F.count_if(~F.coalesce(F.col("_source_file").contains("/landing/year="), F.lit(False))).alias("without_file"),
        F.count_if(F.col("_ingested_at").isNull()).alias("without_time"),
        F.lit(seen.get["row_count"]).cast("long").alias("counted_on_the_way"),
    )


@register
def bronze_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check results of a run of several micro-batches, one file each: a set for each batch."""
    where = jobs.Locations.under(work_path(spark, "bronze-quality"))
    raw = raw_readings(spark, sf_dir).withColumn("file", F.col("entry_id") % BRONZE_FILES)
    raw.repartition("file").write.partitionBy("file").option("ignoreNullFields", "false").json(where.landing)
    jobs.run_bronze(spark, where, maxFilesPerTrigger=1)
    return read_table(spark, where.quality)


@register
def landing_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of readings into the landing layout."""
    source, path, checkpoint = (work_path(spark, n) for n in ("readings", "landing", "checkpoint"))
    write_table(raw_readings(spark, sf_dir), source, "append")
    readings = spark.readStream.schema(READING).parquet(source)
    delivery.deliver(readings, path, checkpoint, bronze_stream.AVAILABLE_NOW)
    return landing.read_landing(spark, path).select(*READING.names)


@register
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recomputed dates replace theirs; the other dates stay."""
    daily = stage(_daily(spark, sf_dir).drop("_computed_at"), "daily")
    path = work_path(spark, "daily")
    write_table(daily, path, "overwrite_partitions", ("date",))
    since = F.col("date") >= F.lit(RECOMPUTED_SINCE).cast("date")
    again = daily.filter(since).withColumn("reading_count", F.col("reading_count") + 100)
    write_table(again, path, "overwrite_partitions", ("date",))
    return read_table(spark, path)


@register
def compact_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "hourly")
    gold.write_hourly(_hourly(spark, sf_dir), path)
    layout.compact(spark, path, gold.HOURLY_PARTITION, "window_start", "device_id")
    return read_table(spark, path).drop("_computed_at", gold.HOURLY_PARTITION)



@register
def compact_zorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files per date to few, along the Z-order curve of device and hour."""
    path = work_path(spark, "hourly-z")
    hourly = _hourly(spark, sf_dir).withColumn(gold.HOURLY_PARTITION, F.to_date("window_start"))
    write_table(hourly.repartition(6), path, "overwrite", (gold.HOURLY_PARTITION,))
    layout.compact(spark, path, gold.HOURLY_PARTITION, "device_id", "window_start", zorder=True)
    return read_table(spark, path).drop("_computed_at", gold.HOURLY_PARTITION)
