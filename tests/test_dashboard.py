import pytest
from conftest import at
from pyspark.sql import functions as F

from gaugeworks.operators.rollups import hourly
from gaugeworks.plans import dashboard, gold
from gaugeworks.sources.tables import read_table

SILVER = (
    "device_id string, entry_id bigint, recorded_at timestamp, vibration_rms double, temperature_celsius double, "
    "pressure_bar double, source_channel int"
)
NOW = "2024-01-15 12:00:00"


def silver(spark, *rows):
    """(device, entry, time, vibration) rows."""
    return spark.createDataFrame([(d, e, at(t), v, 20.456, 1.0, 9) for d, e, t, v in rows], SILVER)


def test_twin_state(spark):
    df = silver(
        spark,
        ("d1", 1, "2024-01-15T11:00:00", 1.0),
        ("d1", 2, "2024-01-15T11:55:01", 2.71828),
        ("d2", 3, "2024-01-15T11:55:00", 3.0),
        ("d3", 4, "2024-01-15T11:45:00", 4.0),
        ("d4", 5, "2024-01-15T11:50:00", 5.0),
        ("d4", 6, "2024-01-15T11:50:00", 6.0),
        (None, 7, "2024-01-15T11:59:00", 5.0),
    )
    found = [
        (r["device_id"], r["entry_id"], r["vibration_rms_mm_s"], r["minutes_since_last_reading"], r["data_freshness"])
        for r in dashboard.twin_state(df, NOW).collect()
    ]
    assert found == [
        ("d1", 2, 2.718, 4, "LIVE"),
        ("d2", 3, 3.0, 5, "RECENT"),
        ("d3", 4, 4.0, 15, "STALE"),
        ("d4", 6, 6.0, 10, "RECENT"),
    ]


def daily(spark, *rows):
    """(device, date, z-score, flag) rows."""
    figures = {f"{fn}_{m}": F.lit(1.23456) for m in ("vibration_rms", "temperature_celsius", "pressure_bar") for fn in ("avg", "min", "max")}
    df = spark.createDataFrame(rows, "device_id string, date string, vibration_zscore double, is_at_risk boolean")
    return df.withColumns({"date": F.to_date("date"), **figures, "reading_count": F.lit(1), "_computed_at": F.lit(NOW)})


def test_at_risk_devices(spark):
    df = daily(
        spark,
        ("d1", "2024-01-08", 2.6, True),
        ("d2", "2024-01-07", 9.0, True),
        ("d3", "2024-01-15", 1.0, False),
        ("d4", "2024-01-10", 3.0, True),
        ("d5", "2024-01-11", 3.0, True),
    )
    assert [r["device_id"] for r in dashboard.at_risk_devices(df, NOW).collect()] == ["d5", "d4", "d1"]


def test_daily_summary(spark):
    df = daily(spark, ("d2", "2024-01-01", 0.0, False), ("d1", "2023-12-16", 0.0, False), ("d1", "2024-01-02", 0.0, False), ("d1", "2023-12-15", 0.0, False))
    found = dashboard.daily_summary(df, NOW)
    assert [(r["device_id"], str(r["date"])) for r in found.collect()] == [("d1", "2024-01-02"), ("d1", "2023-12-16"), ("d2", "2024-01-01")]
    first = found.first()
    assert (first["avg_vibration_rms_mm_s"], first["avg_temperature_celsius"], first["max_pressure_bar"]) == (1.235, 1.23, 1.235)


@pytest.mark.parametrize("stored", [False, True])
def test_vibration_trend(spark, path, stored):
    df = hourly(
        silver(
            spark,
            ("d1", 1, "2024-01-15T11:00:00", 10.0),
            ("d1", 2, "2024-01-15T10:00:00", 10.5),
            ("d1", 3, "2024-01-14T11:59:00", 10.5),
            ("d1", 4, "2024-01-14T12:00:00", None),
        )
    )
    if stored:
        gold.write_hourly(df, path("hourly"))
        df = read_table(spark, path("hourly"))
    found = dashboard.vibration_trend(df, NOW)
    assert [(r["window_start"].hour, r["threshold_exceeded"]) for r in found.collect()] == [(12, False), (10, True), (11, False)]
    if stored:
        assert f"PartitionFilters: [isnotnull({gold.HOURLY_PARTITION}" in found._jdf.queryExecution().executedPlan().toString()


def test_pipeline_health(spark):
    bronze = spark.createDataFrame([("2024-01-15T11:30:00Z",), ("zzz",)], "recorded_at string")
    rows = silver(spark, ("d1", 1, "2024-01-15T11:00:30", 1.0))
    found = dashboard.pipeline_health(bronze, rows, hourly(rows), daily(spark), NOW).collect()
    assert [(r["table_name"], r["row_count"], r["latest_record_at"], r["data_lag_minutes"]) for r in found[:2]] == [
        ("bronze_sensors", 2, at("2024-01-15T11:30:00"), 30),
        ("silver_sensors", 1, at("2024-01-15T11:00:30"), 59),
    ]
    assert sorted((r["table_name"], r["row_count"], r["data_lag_minutes"]) for r in found[2:]) == [
        ("gold_sensors_daily", 0, None),
        ("gold_sensors_hourly", 1, 60),
    ]
