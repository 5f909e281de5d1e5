import random
from datetime import timedelta

import numpy as np
import pytest
from conftest import at
from pyspark.sql import functions as F

from gaugeworks.operators import metrics, percentiles, pyramid
from gaugeworks.session import stage

FEED = "metric_name string, value double, ts timestamp"


def feed(spark, n=4_000):
    rng = random.Random(1)
    start = at("2024-01-01T00:00:00")
    rows = [(rng.choice("aab"), rng.choice([rng.random(), 5.0]), start + timedelta(seconds=rng.randrange(4 * 3600))) for _ in range(n)]
    rows += [(None, 1.0, start), ("a", None, start), ("none", None, start), ("a", 1.0, None), ("one", 3.0, start)]
    return spark.createDataFrame(rows, FEED)


def rows_of(df):
    found = {}
    for r in df.collect():
        found[r["metric_name"], r["period_seconds"], r["period_start"]] = tuple(
            None if r[c] is None else round(r[c], 9) for c in ("sum", "average", "maximum", "minimum", "sample_count", "percentile")
        )
    return found


def test_all_periods_equal_direct_rollups(spark):
    df = feed(spark).withColumn("unit", F.lit("")).withColumn("dimensions", F.create_map().cast("map<string,string>"))
    parts = stage(pyramid.base_parts(df), "parts")
    got = rows_of(pyramid.pyramid(df, parts, (300, 3600, 86400)))
    want = {}
    for seconds in (300, 3600, 86400):
        want |= rows_of(metrics.rollup(df.filter("ts IS NOT NULL"), seconds))
    assert got == want and len({k[1] for k in got}) == 3


def test_coarse_periods_do_not_read_the_metrics(spark, path):
    df = feed(spark)
    parts = stage(pyramid.base_parts(df), "parts")
    rolled = pyramid.pyramid(df, parts, (3600,), p=None)
    files = rolled.inputFiles()
    assert files and set(files) == set(parts.inputFiles())
    with pytest.raises(ValueError):
        pyramid.merged(parts, 500)


@pytest.mark.parametrize("slack", [pyramid.SLACK, 0.0])
def test_percentile_is_exact_when_only_the_band_is_ranked(spark, monkeypatch, slack):
    """With no slack the band often misses the rank; such groups are searched without one."""
    monkeypatch.setattr(percentiles, "ACCURACY", 10)
    monkeypatch.setattr(pyramid, "SKETCH_SIZE", 16)
    rng = np.random.default_rng(3)
    values = np.round(rng.normal(size=6_000), 3)
    start = at("2024-01-01T00:00:00")
    rows = [("m", float(v), start + timedelta(seconds=int(i) % 7200)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, FEED)
    parts = stage(pyramid.base_parts(df), "parts")
    got = pyramid.pyramid(df, parts, (3600, 86400), slack=slack).collect()
    for row in got:
        chosen = [v for _, v, t in rows if row["period_seconds"] == 86400 or t.hour == row["period_start"].hour]
        assert row["percentile"] == pytest.approx(np.quantile(chosen, 0.99), abs=1e-12)


def test_hourly_curves(spark):
    start = at("2024-01-01T00:00:00")
    rows = [("BronzeRowCount", float(i), start + timedelta(minutes=i)) for i in range(180)]
    df = spark.createDataFrame(rows, FEED)
    parts = stage(pyramid.base_parts(df), "parts")
    since, until = F.lit(start), F.lit(start + timedelta(hours=3))
    got = pyramid.stored_curves(df, parts, since, until).collect()
    assert sorted((r["period_seconds"], r["statistic"], r["value"]) for r in got) == [
        (3600, "Maximum", 59.0), (3600, "Maximum", 119.0), (3600, "Maximum", 179.0)
    ]
