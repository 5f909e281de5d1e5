import math

import pytest
from conftest import at
from pyspark.sql import functions as F

from gaugeworks.operators import rollups, scoring

SILVER = (
    "device_id string, entry_id bigint, recorded_at timestamp, vibration_rms double, temperature_celsius double, "
    "pressure_bar double"
)
FIGURES = [f"{fn}_{m}" for m in ("vibration_rms", "temperature_celsius", "pressure_bar") for fn in ("avg", "min", "max")]


def silver(spark, *rows):
    """(device, time, vibration) rows."""
    full = [(d, i, at(t) if t else None, v, 20.0, 1.0) for i, (d, t, v) in enumerate(rows)]
    return spark.createDataFrame(full, SILVER)


def daily(spark, *rows):
    """(device, day, average) rows."""
    return spark.createDataFrame(rows, "device_id string, date string, avg_vibration_rms double").withColumn(
        "date", F.to_date("date")
    )


def test_sentinel_becomes_null(spark):
    df = silver(spark, ("d1", "2024-01-15T10:00:00", -1.0), ("d1", "2024-01-15T10:00:00", 0.0), ("d1", "2024-01-15T10:00:00", -0.5))
    values = [r["vibration_rms"] for r in rollups.sentinel_to_null(df).orderBy("entry_id").collect()]
    assert values == [None, 0.0, -0.5]


def test_hourly(spark):
    df = silver(
        spark,
        ("d1", "2024-01-15T10:00:00", 2.0),
        ("d1", "2024-01-15T10:59:59", 4.0),
        ("d2", "2024-01-15T11:00:00", 6.0),
        ("d2", None, 8.0),
    )
    found = rollups.hourly(df, "2024-01-16 00:00:00")
    assert found.columns == ["device_id", *FIGURES, "reading_count", "window_start", "window_end", "_computed_at"]
    first, second = found.orderBy("device_id").collect()
    assert (first["avg_vibration_rms"], first["min_vibration_rms"], first["max_vibration_rms"]) == (3.0, 2.0, 4.0)
    assert (first["reading_count"], second["reading_count"]) == (2, 1)
    assert (second["window_start"], second["window_end"]) == (at("2024-01-15T11:00:00"), at("2024-01-15T12:00:00"))


def test_nulls_are_skipped_by_averages(spark):
    df = silver(spark, ("d1", "2024-01-15T10:00:00", None), ("d1", "2024-01-15T10:01:00", 6.0))
    row = rollups.hourly(df).first()
    assert (row["avg_vibration_rms"], row["reading_count"]) == (6.0, 2)


def test_daily(spark):
    df = silver(spark, *[("d1", f"2024-01-15T{h}:00:00", v) for h, v in (("00", 1.0), ("12", 3.0), ("23", 5.0))], ("d1", None, 7.0))
    found = rollups.daily(df)
    assert found.columns == ["device_id", "date", *FIGURES, "reading_count", "_computed_at"]
    undated, dated = found.orderBy("date").collect()
    assert (undated["date"], undated["avg_vibration_rms"]) == (None, 7.0)
    assert (str(dated["date"]), dated["avg_vibration_rms"], dated["reading_count"]) == ("2024-01-15", 3.0, 3)


def test_parts_give_the_same_tables(spark):
    df = silver(
        spark,
        ("d1", "2024-01-15T10:00:00", 2.0),
        ("d1", "2024-01-15T10:30:00", None),
        ("d1", "2024-01-15T11:00:00", None),
        ("d1", "2024-01-15T12:00:00", 7.0),
        ("d2", None, 5.0),
    )
    parts = rollups.hour_parts(df)
    for direct, merged in (
        (rollups.hourly(df, "2024-01-16"), rollups.hourly_from_parts(parts, "2024-01-16")),
        (rollups.daily(df, "2024-01-16"), rollups.daily_from_parts(parts, "2024-01-16")),
    ):
        assert direct.columns == merged.columns
        assert sorted(map(str, direct.collect())) == sorted(map(str, merged.collect()))


def test_averages_do_not_depend_on_the_order_of_rows(spark):
    # 0.1 + 0.2 + 0.3 is not 0.3 + 0.2 + 0.1 for doubles; large numbers hide small ones.
    values = [0.1, 0.2, 0.3, 1e7, -1e7, 58.53]
    rows = [("d1", f"2024-01-1{day}T{10 + i // 3}:00:00", v) for day, vs in ((5, values), (6, values[::-1]), (7, values[3:] + values[:3])) for i, v in enumerate(vs)]
    df = silver(spark, *rows).coalesce(1)
    for found in (rollups.daily(df), rollups.daily_from_parts(rollups.hour_parts(df))):
        assert {r["avg_vibration_rms"] for r in found.collect()} == {math.fsum(values) / 6}
        assert zscores(scoring.zscore_daily(found)) == [0.0, 0.0, 0.0]
    hours = sorted((r["window_start"], r["avg_vibration_rms"]) for r in rollups.hourly(df).collect())
    assert hours == sorted((r["window_start"], r["avg_vibration_rms"]) for r in rollups.hourly_from_parts(rollups.hour_parts(df)).collect())


def test_averages_of_numbers_beyond_the_exact_form(spark):
    inf = float("inf")
    for values, expected in (([1e300, 3e300], 2e300), ([1e-300, 3e-300], 2e-300), ([1.0, inf], inf), ([-1.5, -2.5], -2.0), ([None, None], None)):
        df = silver(spark, *[("d1", f"2024-01-15T1{i}:00:00", v) for i, v in enumerate(values)])
        for found in (rollups.daily(df), rollups.daily_from_parts(rollups.hour_parts(df))):
            assert found.first()["avg_vibration_rms"] == expected


def zscores(df):
    return [r["vibration_zscore"] for r in df.orderBy("device_id", "date").collect()]


def test_zscore_of_one_row_and_of_equal_rows(spark):
    assert zscores(scoring.zscore_daily(daily(spark, ("d1", "2024-01-01", 5.0)))) == [0.0]
    same = daily(spark, *[("d1", f"2024-01-0{d}", 5.0) for d in (1, 2, 3)])
    assert zscores(scoring.zscore_daily(same)) == [0.0, 0.0, 0.0]


def test_zscore_of_two_rows(spark):
    up = scoring.zscore_daily(daily(spark, ("d1", "2024-01-01", 1.0), ("d1", "2024-01-02", 3.0)))
    down = scoring.zscore_daily(daily(spark, ("d1", "2024-01-01", 3.0), ("d1", "2024-01-02", 1.0)))
    assert zscores(up) == [0.0, pytest.approx(1 / math.sqrt(2))]
    assert zscores(down) == [0.0, pytest.approx(-1 / math.sqrt(2))]


def test_devices_are_scored_apart(spark):
    df = daily(spark, ("d1", "2024-01-01", 1.0), ("d2", "2024-01-02", 99.0), ("d1", "2024-01-03", 1.0))
    assert zscores(scoring.zscore_daily(df)) == [0.0, 0.0, 0.0]


def test_default_frame_never_flags_but_a_longer_one_does(spark):
    rows = [("d1", f"2024-01-{d:02d}", 1.0 + d % 2) for d in range(1, 14)] + [("d1", "2024-01-14", 500.0)]
    assert scoring.score_daily(daily(spark, *rows)).filter("is_at_risk").count() == 0
    flagged = scoring.score_daily(daily(spark, *rows), 14).filter("is_at_risk").collect()
    assert [str(r["date"]) for r in flagged] == ["2024-01-14"]


def test_day_frame_respects_gaps(spark):
    df = daily(spark, ("d1", "2024-01-01", 1.0), ("d1", "2024-01-09", 3.0))
    assert zscores(scoring.zscore_days(df, 2)) == [0.0, 0.0]
    assert zscores(scoring.zscore_daily(df, 2)) == [0.0, pytest.approx(1 / math.sqrt(2))]


def test_24_hour_frame_respects_gaps(spark):
    rows = [("d1", at("2024-01-01T00:00:00"), 1.0), ("d1", at("2024-01-01T23:00:00"), 3.0), ("d1", at("2024-01-02T23:00:00"), 9.0)]
    hourly = spark.createDataFrame(rows, "device_id string, window_start timestamp, avg_vibration_rms double")
    found = [r["vibration_zscore"] for r in scoring.zscore_24h(hourly).orderBy("window_start").collect()]
    assert found == [0.0, pytest.approx(1 / math.sqrt(2)), 0.0]


def test_infinite_reading_flags_its_day_and_the_next(spark):
    rows = [("d1", "2024-01-01", 1.0), ("d1", "2024-01-02", float("inf")), ("d1", "2024-01-03", 1.0), ("d1", "2024-01-04", 1.0)]
    flags = [r["is_at_risk"] for r in scoring.score_daily(daily(spark, *rows)).orderBy("date").collect()]
    assert flags == [False, True, True, False]


@pytest.mark.parametrize(("zscore", "flag"), [(2.6, True), (2.5, False), (0.5, False), (0.0, False)])
def test_risk_is_strict(spark, zscore, flag):
    df = spark.createDataFrame([("d1", zscore)], "device_id string, vibration_zscore double")
    assert scoring.flag_risk(df).first()["is_at_risk"] is flag
