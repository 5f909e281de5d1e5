"""Pipeline metrics as rows of a long table (AGG-11..15, AGG-17..19, SNK-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions import scalars
from gaugeworks.operators.joins import join_dimension
from gaugeworks.operators.percentiles import band_sketch, exact_percentile
from gaugeworks.session import stage
from gaugeworks.sources.schemas import METRIC
from gaugeworks.sources.tables import write_table

P99 = 0.99
LOOKBACK_HOURS = 3
LAST_UPDATE = "GoldTableLastUpdate"
LAST_COMPUTED = "GoldTableLastComputed"

# Metric, statistic and period in seconds of each dashboard curve.
DASHBOARD_CURVES = [
    ("RecordsIngested", "Sum", 300),
    ("PipelineErrors", "Sum", 300),
    ("GetRecords.IteratorAgeMilliseconds", "Maximum", 300),
    ("BronzeWriteLatencyMs", "Average", 300),
    ("BronzeWriteLatencyMs", "p99", 300),
    ("SilverWriteLatencyMs", "Average", 300),
    ("SilverWriteLatencyMs", "p99", 300),
    ("GoldWriteLatencyMs", "Average", 300),
    ("GoldWriteLatencyMs", "p99", 300),
    ("BronzeRowCount", "Maximum", 3600),
    ("SilverRowCount", "Maximum", 3600),
    ("GoldHourlyRowCount", "Maximum", 3600),
    ("GoldDailyRowCount", "Maximum", 3600),
    ("AtRiskDeviceCount", "Maximum", 3600),
    ("MaxVibrationZScore", "Maximum", 3600),
]


def metric_row(name: str | Column, value: Column, unit: str, ts: Column, dimensions: Column | None = None) -> list[Column]:
    """The columns of one metric row."""
    no_dimensions = F.create_map().cast("map<string,string>")
    return [
        (F.lit(name) if isinstance(name, str) else name).alias("metric_name"),
        value.cast("double").alias("value"),
        F.lit(unit).alias("unit"),
        (no_dimensions if dimensions is None else dimensions).alias("dimensions"),
        ts.alias("ts"),
    ]


def _row_count(table: DataFrame, name: str, ts: Column) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("n")).select(*metric_row(name, F.col("n"), "Count", ts))


def row_counts(bronze: DataFrame, silver: DataFrame, hourly: DataFrame, daily: DataFrame, as_of=None) -> DataFrame:
    """Row counts of the four tables (AGG-11)."""
    ts = scalars.moment(as_of)
    return (
        _row_count(bronze, "BronzeRowCount", ts)
        .unionByName(_row_count(silver, "SilverRowCount", ts))
        .unionByName(_row_count(hourly, "GoldHourlyRowCount", ts))
        .unionByName(_row_count(daily, "GoldDailyRowCount", ts))
    )


def risk_metrics(daily: DataFrame, as_of=None) -> DataFrame:
    """At-risk devices of all time and of today, and today's highest z-score
    (AGG-12..14). Each is a narrow scan; "today" prunes to one date."""
    ts = scalars.moment(as_of)
    today = F.col("date") == F.to_date(ts)
    at_risk = daily.filter("is_at_risk")
    devices = F.count_distinct("device_id").alias("n")
    highest = F.coalesce(F.max("vibration_zscore"), F.lit(0.0)).alias("z")
    return (
        at_risk.agg(devices)
        .select(*metric_row("AtRiskDeviceCountAllTime", F.col("n"), "Count", ts))
        .unionByName(at_risk.filter(today).agg(devices).select(*metric_row("AtRiskDeviceCount", F.col("n"), "Count", ts)))
        .unionByName(daily.filter(today).agg(highest).select(*metric_row("MaxVibrationZScore", F.col("z"), "None", ts)))
    )


def freshness_metrics(daily: DataFrame, as_of=None) -> DataFrame:
    """Epoch seconds of midnight of the newest date (AGG-15) and of the last
    computation, which tells whether the job ran; 0.0 without rows."""
    ts = scalars.moment(as_of)
    newest = F.unix_timestamp(F.max(F.col("date").cast("timestamp"))).cast("double")
    computed = F.unix_timestamp(F.max("_computed_at")).cast("double")
    return daily.agg(
        F.coalesce(newest, F.lit(0.0)).alias("newest"), F.coalesce(computed, F.lit(0.0)).alias("computed")
    ).select(
        F.inline(
            F.array(
                F.struct(*metric_row(LAST_UPDATE, F.col("newest"), "None", ts)),
                F.struct(*metric_row(LAST_COMPUTED, F.col("computed"), "None", ts)),
            )
        )
    )


def snapshot(bronze: DataFrame, silver: DataFrame, hourly: DataFrame, daily: DataFrame, as_of=None) -> DataFrame:
    return (
        row_counts(bronze, silver, hourly, daily, as_of)
        .unionByName(risk_metrics(daily, as_of))
        .unionByName(freshness_metrics(daily, as_of))
    )


def ingest_counts(batch: DataFrame, as_of=None) -> DataFrame:
    """Readings per device of a batch (AGG-17)."""
    per_device = F.create_map(F.lit("DeviceId"), F.col("device_id"))
    return (
        batch.groupBy("device_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*metric_row("RecordsIngested", F.col("n"), "Count", scalars.moment(as_of), per_device))
    )


def stage_latencies(runs: DataFrame) -> DataFrame:
    """(stage, device_id, started_at, finished_at) rows to write-latency metrics
    in milliseconds; no device means all of them (AGG-18)."""
    took = (F.unix_micros("finished_at") - F.unix_micros("started_at")) / F.lit(1000.0)
    device = F.create_map(F.lit("DeviceId"), F.coalesce("device_id", F.lit("ALL")))
    name = F.concat(F.col("stage"), F.lit("WriteLatencyMs"))
    return runs.select(*metric_row(name, took, "Milliseconds", F.col("finished_at"), device))


def progress_latencies(spark: SparkSession, stage_name: str, progress: list) -> DataFrame:
    """Latency rows from the progress reports of a streaming query."""
    rows = [(p.timestamp, float(p.durationMs.get("triggerExecution", 0))) for p in progress]
    return spark.createDataFrame(rows, "at string, took double").select(
        *metric_row(
            f"{stage_name}WriteLatencyMs",
            F.col("took"),
            "Milliseconds",
            F.col("at").cast("timestamp"),
            F.create_map(F.lit("DeviceId"), F.lit("ALL")),
        )
    )


def publish(metrics: DataFrame, ref: str) -> None:
    """Append rows to the metrics table (SNK-11)."""
    write_table(metrics.select(*METRIC.names), ref, "append")


def rollup(metrics: DataFrame, period_seconds: int, percentile: float | None = P99) -> DataFrame:
    """Sum, average, extremes, count and an exact percentile per metric and
    period, over all dimensions (AGG-19). ``percentile=None`` saves its pass."""
    keys = ["metric_name", "period_start"]
    period = F.window("ts", f"{period_seconds} seconds")["start"]
    timed = metrics.filter(F.col("metric_name").isNotNull()).select(
        "metric_name", period.alias("period_start"), "value"
    )
    figures = [
        F.sum("value").alias("sum"),
        F.avg("value").alias("average"),
        F.max("value").alias("maximum"),
        F.min("value").alias("minimum"),
        F.count("value").alias("n"),
    ]
    if percentile is None:
        rolled = timed.groupBy(*keys).agg(*figures).withColumn("percentile", F.lit(None).cast("double"))
    else:
        band = band_sketch("value", percentile).alias("band")
        groups = stage(timed.groupBy(*keys).agg(*figures, band), "metric-groups")
        exact = exact_percentile(timed, groups, keys, "value", percentile, "percentile")
        rolled = groups.join(exact, keys, "left")
    return rolled.select(
        "metric_name", F.lit(period_seconds).cast("bigint").alias("period_seconds"), "period_start",
        "sum", "average", "maximum", "minimum", F.col("n").alias("sample_count"), "percentile",
    )


def dashboard_curves(metrics: DataFrame, as_of=None, hours: int = LOOKBACK_HOURS, curves=None) -> DataFrame:
    """The dashboard's curves over the look-back window, one row per point."""
    now = scalars.moment(as_of)
    since = F.timestamp_add("HOUR", F.lit(-hours), now)
    wanted = curves or DASHBOARD_CURVES
    names = sorted({name for name, _, _ in wanted})
    recent = metrics.filter(F.col("metric_name").isin(names) & (F.col("ts") >= since) & (F.col("ts") < now))
    rolled = None
    for seconds in sorted({seconds for _, _, seconds in wanted}):
        ranked = any(statistic == "p99" for _, statistic, period in wanted if period == seconds)
        rows = rollup(recent, seconds, P99 if ranked else None)
        rolled = rows if rolled is None else rolled.unionByName(rows)
    return curves_of(rolled, wanted)


def curves_of(rolled: DataFrame, wanted: list[tuple]) -> DataFrame:
    """Roll-ups to one row per point of each wanted (metric, statistic, period)."""
    spec = rolled.sparkSession.createDataFrame(
        wanted, "metric_name string, statistic string, period_seconds bigint"
    )
    by_statistic = F.create_map(
        F.lit("Sum"), F.col("sum"),
        F.lit("Average"), F.col("average"),
        F.lit("Maximum"), F.col("maximum"),
        F.lit("p99"), F.col("percentile"),
    )
    return join_dimension(rolled, spec, ["metric_name", "period_seconds"]).select(
        "metric_name",
        "statistic",
        "period_seconds",
        "period_start",
        by_statistic[F.col("statistic")].alias("value"),
    )
