import statistics

import pytest
from conftest import at
from pyspark.sql import functions as F

from gaugeworks.operators import alarms, metrics, percentiles
from gaugeworks.sources.schemas import METRIC
from gaugeworks.sources.tables import read_table


def rows(spark, *values):
    """(name, value, time[, dimensions]) rows."""
    full = [(v[0], float(v[1]), "Count", v[3] if len(v) > 3 else {}, at(v[2])) for v in values]
    return spark.createDataFrame(full, METRIC)


def daily(spark, *values):
    return spark.createDataFrame(
        values, "device_id string, date string, vibration_zscore double, is_at_risk boolean"
    ).withColumns({"date": F.to_date("date"), "_computed_at": F.lit("2024-01-02 07:00:00").cast("timestamp")})


def values_by_name(df):
    return {r["metric_name"]: r["value"] for r in df.collect()}


def test_snapshot(spark):
    table = daily(
        spark,
        ("d1", "2024-01-01", 3.0, True),
        ("d1", "2024-01-02", 2.6, True),
        ("d2", "2024-01-01", 2.7, True),
        ("d3", "2024-01-02", 1.0, False),
    )
    found = metrics.snapshot(spark.range(5), spark.range(4), spark.range(3), table, "2024-01-02 08:00:00")
    assert found.schema.names == METRIC.names
    assert values_by_name(found) == {
        "BronzeRowCount": 5.0,
        "SilverRowCount": 4.0,
        "GoldHourlyRowCount": 3.0,
        "GoldDailyRowCount": 4.0,
        "AtRiskDeviceCountAllTime": 2.0,
        "AtRiskDeviceCount": 1.0,
        "MaxVibrationZScore": 2.6,
        "GoldTableLastUpdate": 1704153600.0,
        "GoldTableLastComputed": 1704178800.0,
    }


def test_defaults_without_rows(spark):
    found = values_by_name(metrics.risk_metrics(daily(spark)).unionByName(metrics.freshness_metrics(daily(spark))))
    assert set(found.values()) == {0.0}


def test_ingest_counts_and_latencies(spark):
    counts = metrics.ingest_counts(spark.createDataFrame([("a",), ("a",), ("b",)], "device_id string")).collect()
    assert sorted((r["dimensions"]["DeviceId"], r["value"]) for r in counts) == [("a", 2.0), ("b", 1.0)]
    runs = spark.createDataFrame(
        [("Gold", None, at("2024-01-01T00:00:00"), at("2024-01-01T00:00:01.500000"))],
        "stage string, device_id string, started_at timestamp, finished_at timestamp",
    )
    (row,) = metrics.stage_latencies(runs).collect()
    assert (row["metric_name"], row["value"], row["dimensions"]) == ("GoldWriteLatencyMs", 1500.0, {"DeviceId": "ALL"})


def test_publish_appends(spark, path):
    for _ in range(2):
        metrics.publish(rows(spark, ("m", 1, "2024-01-01T00:00:00")), path("m"))
    assert read_table(spark, path("m")).count() == 2


def test_rollup(spark):
    found = metrics.rollup(
        rows(
            spark,
            ("m", 1, "2024-01-01T00:00:00", {"DeviceId": "a"}),
            ("m", 3, "2024-01-01T00:04:59", {"DeviceId": "b"}),
            ("m", 5, "2024-01-01T00:05:00"),
            ("n", 7, "2024-01-01T00:00:00"),
        ),
        300,
    ).orderBy("metric_name", "period_start")
    assert [tuple(r) for r in found.collect()] == [
        ("m", 300, at("2024-01-01T00:00:00"), 4.0, 2.0, 3.0, 1.0, 2, pytest.approx(2.98)),
        ("m", 300, at("2024-01-01T00:05:00"), 5.0, 5.0, 5.0, 5.0, 1, 5.0),
        ("n", 300, at("2024-01-01T00:00:00"), 7.0, 7.0, 7.0, 7.0, 1, 7.0),
    ]


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.99, 1.0])
@pytest.mark.parametrize("accuracy", [50, 400])
def test_percentile_band_is_exact(spark, monkeypatch, p, accuracy):
    """Groups far larger than the band: skewed, all equal, few values, tiny."""
    monkeypatch.setattr(percentiles, "ACCURACY", accuracy)
    monkeypatch.setattr(percentiles, "SLACK", 4 / accuracy)
    df = (
        spark.range(6000)
        .selectExpr("'wide' AS g", "cast(pmod(hash(id), 100000) AS double) AS v")
        .union(spark.range(3000).selectExpr("'same'", "5.0D"))
        .union(spark.range(3000).selectExpr("'few'", "cast(id % 3 AS double)"))
        .union(spark.range(1000).selectExpr("'steep'", "exp(id / 20.0D)"))
        .union(spark.range(7).selectExpr("'tiny'", "cast(id AS double)"))
        .union(spark.range(1).selectExpr("'null'", "cast(null AS double)"))
        .repartition(5)
    )
    groups = df.groupBy("g").agg(F.count("v").alias("n"), percentiles.band_sketch("v", p).alias("band"))
    found = percentiles.exact_percentile(df, groups, ["g"], "v", p, "q")
    expected = df.filter("v IS NOT NULL").groupBy("g").agg(F.percentile("v", p).alias("q"))
    assert {r["g"]: pytest.approx(r["q"], rel=1e-12) for r in expected.collect()} == {r["g"]: r["q"] for r in found.collect()}


def test_percentile_ranks_only_the_band(spark, monkeypatch):
    monkeypatch.setattr(percentiles, "ACCURACY", 100)
    monkeypatch.setattr(percentiles, "SLACK", 0.04)
    df = spark.range(10_000).selectExpr("'g' AS g", "cast(id AS double) AS v")
    band = df.agg(percentiles.band_sketch("v", 0.5)).first()[0]
    assert 4300 <= band[0] <= 5000 <= band[1] <= 5700


def test_dashboard_curves(spark):
    found = metrics.dashboard_curves(
        rows(
            spark,
            ("RecordsIngested", 2, "2024-01-01T10:00:00"),
            ("RecordsIngested", 3, "2024-01-01T10:01:00"),
            ("RecordsIngested", 9, "2024-01-01T06:00:00"),
            ("GoldWriteLatencyMs", 10, "2024-01-01T10:00:00"),
            ("GoldWriteLatencyMs", 20, "2024-01-01T10:00:01"),
            ("SilverRowCount", 4, "2024-01-01T09:30:00"),
            ("other", 1, "2024-01-01T10:00:00"),
        ),
        "2024-01-01 12:00:00",
    )
    assert sorted((r["metric_name"], r["statistic"], r["period_seconds"], r["value"]) for r in found.collect()) == [
        ("GoldWriteLatencyMs", "Average", 300, 15.0),
        ("GoldWriteLatencyMs", "p99", 300, pytest.approx(statistics.quantiles([10, 20], n=100, method="inclusive")[98])),
        ("RecordsIngested", "Sum", 300, 5.0),
        ("SilverRowCount", "Maximum", 3600, 4.0),
    ]


def states(spark, metric_rows, rule, start="2024-01-01 00:00:00", end="2024-01-01 00:20:00"):
    found = alarms.evaluate(metric_rows, alarms.rules_frame(spark, [rule]), start, end)
    return [(r["value"], r["breaching"], r["state"]) for r in found.orderBy("period_start").collect()]


def test_alarm_needs_consecutive_periods(spark):
    feed = rows(spark, ("m", 5, "2024-01-01T00:00:00"), ("m", 5, "2024-01-01T00:06:00"), ("m", 1, "2024-01-01T00:10:00"))
    rule = ("r", "m", "Maximum", 300, 2, alarms.ABOVE, 4.0, alarms.BREACHING, {})
    assert states(spark, feed, rule) == [
        (5.0, True, "OK"),
        (5.0, True, "ALARM"),
        (1.0, False, "OK"),
        (None, True, "OK"),
    ]


def test_missing_data_policies(spark):
    empty = rows(spark, ("other", 1, "2024-01-01T00:00:00"))
    for policy, state in ((alarms.BREACHING, "ALARM"), (alarms.NOT_BREACHING, "OK")):
        rule = ("r", "m", "Sum", 300, 1, alarms.BELOW, 1.0, policy, {})
        assert [s for _, _, s in states(spark, empty, rule)] == [state] * 4


def test_rule_dimensions(spark):
    feed = rows(
        spark,
        ("m", 1, "2024-01-01T00:00:00", {"DeviceId": "a", "Site": "x"}),
        ("m", 2, "2024-01-01T00:00:00", {"DeviceId": "b"}),
        ("m", 4, "2024-01-01T00:00:00"),
    )
    for dimensions, total in (({}, 7.0), ({"DeviceId": "a"}, 1.0), ({"DeviceId": "a", "Site": "y"}, None)):
        rule = ("r", "m", "Sum", 300, 1, alarms.AT_LEAST, 1.0, alarms.NOT_BREACHING, dimensions)
        assert states(spark, feed, rule)[0][0] == total


def test_a_rule_for_each_device_meets_its_own_rows_only(spark):
    feed = rows(spark, *[("m", k, "2024-01-01T00:00:00", {"DeviceId": f"d{k}"}) for k in range(40)])
    rules = [(f"r{k}", "m", "Sum", 300, 1, alarms.AT_LEAST, 20.0, alarms.NOT_BREACHING, {"DeviceId": f"d{k}"}) for k in range(40)]
    rules.append(("all", "m", "Average", 600, 1, alarms.ABOVE, 100.0, alarms.NOT_BREACHING, {}))
    found = alarms.evaluate(feed, alarms.rules_frame(spark, rules), "2024-01-01 00:00:00", "2024-01-01 00:10:00").collect()
    first = {r["rule"]: (r["value"], r["state"]) for r in found if str(r["period_start"]).endswith("00:00:00")}
    assert first["all"] == (19.5, "OK")
    assert all(first[f"r{k}"] == (float(k), "ALARM" if k >= 20 else "OK") for k in range(40))


@pytest.mark.parametrize(("place", "value"), [(2, "Median"), (5, "GreaterThan"), (7, "ignore")])
def test_unknown_rule_values_are_refused(spark, place, value):
    rule = ["r", "m", "Sum", 300, 1, alarms.BELOW, 1.0, alarms.BREACHING, {}]
    rule[place] = value
    with pytest.raises(ValueError, match=value):
        alarms.rules_frame(spark, [tuple(rule)])


def test_only_whole_periods_are_judged(spark):
    rule = ("r", "m", "Sum", 3600, 1, alarms.BELOW, 1.0, alarms.BREACHING, {})
    feed = rows(spark, ("m", 1, "2024-01-01T00:00:00"))
    assert states(spark, feed, rule, end="2024-01-01 00:20:00") == []
    assert len(states(spark, feed, rule, end="2024-01-01 02:20:00")) == 2


def test_default_rules(spark):
    rules = {r[0]: r for r in alarms.default_rules("2024-01-31 00:00:00")}
    assert len(rules) == 5
    assert rules["gold-stale"][1] == metrics.LAST_COMPUTED
    assert rules["gold-stale"][6] == 1706659200.0 - 7200
    assert rules["ingestion-stale"][7] == alarms.BREACHING
