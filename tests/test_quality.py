import pytest

from gaugeworks.operators import quality
from gaugeworks.operators.quality import MinRows, NullRate, ValueRange

SCHEMA = (
    "device_id string, entry_id bigint, recorded_at string, vibration_rms double, "
    "temperature_celsius double, pressure_bar double"
)


def results(df, *rules):
    return {r["check_name"]: r["passed"] for r in quality.check(df, "t", rules or quality.STANDARD_RULES).collect()}


def frame(spark, vibrations, device="d1"):
    rows = [(device, i, "2024-01-01T00:00:00Z", v, 20.0, 1.0) for i, v in enumerate(vibrations)]
    return spark.createDataFrame(rows, SCHEMA)


def test_row_count(spark):
    three = frame(spark, [1.0, 2.0, 3.0])
    assert results(three, MinRows(1)) == {"min_row_count": True}
    assert results(three, MinRows(3)) == {"min_row_count": True}
    assert results(three, MinRows(4)) == {"min_row_count": False}
    assert results(frame(spark, []), MinRows(1)) == {"min_row_count": False}


@pytest.mark.parametrize(
    ("vibrations", "allowed", "passed"),
    [
        ([1.0, 2.0], 0.0, True),
        ([1.0, None], 0.0, False),
        ([None] + [1.0] * 9, 0.2, True),
        ([None] * 6 + [1.0] * 4, 0.05, False),
        ([None] + [1.0] * 9, 0.1, True),
        ([], 0.0, True),
    ],
)
def test_null_rate(spark, vibrations, allowed, passed):
    assert results(frame(spark, vibrations), NullRate("vibration_rms", allowed)) == {"null_rate_vibration_rms": passed}


@pytest.mark.parametrize(
    ("vibrations", "passed"),
    [
        ([-1.0, 0.0, 500.0], True),
        ([500.1], False),
        ([-1.1, 3.0], False),
        ([None, 3.0], True),
        ([None], True),
        ([], True),
    ],
)
def test_value_range(spark, vibrations, passed):
    rule = ValueRange("vibration_rms", -1.0, 500.0)
    assert results(frame(spark, vibrations), rule) == {"value_range_vibration_rms": passed}


def test_standard_battery(spark):
    found = results(frame(spark, [1.0]))
    assert set(found) == {
        "min_row_count",
        "null_rate_device_id",
        "null_rate_entry_id",
        "null_rate_recorded_at",
        "null_rate_vibration_rms",
        "null_rate_temperature_celsius",
        "null_rate_pressure_bar",
    }
    assert all(found.values())
    assert results(frame(spark, [1.0], device=None))["null_rate_device_id"] is False


def test_summary(spark):
    checks = quality.check(frame(spark, [600.0]), "t", quality.STANDARD_RULES + quality.PHYSICAL_RULES)
    assert quality.summarize(checks).collect() == [("t", 10, 9, 1)]


def test_observed_while_written(spark, path):
    df = frame(spark, [1.0, None])
    watched, seen = quality.watch(df, "watched")
    watched.write.parquet(path("out"))
    observed = quality.observed_results(spark, "t", seen.get)
    assert sorted(observed.collect()) == sorted(quality.check(df, "t").collect())


def test_one_pass(spark):
    plan = quality.check(frame(spark, [1.0]), "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
