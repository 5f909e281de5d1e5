"""Hourly Gold by watermark: closing, late readings, a cut run."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gaugeworks import settings
from gaugeworks.operators import rollups
from gaugeworks.streaming import gold

SCHEMA = "device_id string, entry_id long, recorded_at timestamp, " + ", ".join(f"{m} double" for m in settings.METRICS)


def at(text):
    return datetime.fromisoformat(f"2024-01-01T{text}")


class Feed:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.entry = spark, folder, 0

    def deliver(self, *readings):
        rows = []
        for device, time, value in readings:
            self.entry += 1
            rows.append((device, self.entry, time and at(time), *[value] * len(settings.METRICS)))
        self.spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{self.folder}/feed")

    def run(self):
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.folder}/feed")
        gold.run_hourly(stream, f"{self.folder}/gold", f"{self.folder}/checkpoint")

    def figures(self, df):
        return sorted(
            (r.device_id, r.window_start, r.reading_count, r[f"avg_{settings.METRICS[0]}"]) for r in df.collect()
        )

    def equals_batch(self):
        want = rollups.hourly(self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/feed"))
        return self.figures(gold.hourly_now(self.spark, f"{self.folder}/gold")) == self.figures(want)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def test_hours_close_and_late_readings_go_aside(spark, feed):
    feed.deliver(("a", "10:10:00", 1.0), ("a", "10:50:00", 3.0), ("b", "13:00:00", 5.0), ("b", None, 9.0))
    feed.run()
    closed = gold.closed_hours(spark, f"{feed.folder}/gold")
    assert feed.figures(closed) == [("a", at("10:00:00"), 2, 2.0)]  # the watermark is 11:00
    assert feed.equals_batch()
    # 10:30 is late by then, 11:30 is not; one late reading opens an hour that had none.
    feed.deliver(("a", "10:30:00", 8.0), ("a", "11:30:00", 4.0), ("c", "09:15:00", 7.0))
    feed.run()
    late = gold.late_readings(spark, f"{feed.folder}/gold")
    assert {(r.device_id, r.recorded_at) for r in late.collect()} == {("a", at("10:30:00")), ("c", at("09:15:00"))}
    assert feed.equals_batch()
    feed.deliver(("b", "20:00:00", 1.0))
    feed.run()
    assert gold.closed_hours(spark, f"{feed.folder}/gold").count() == 3
    assert feed.equals_batch()


def test_a_run_without_news_changes_nothing(spark, feed):
    feed.deliver(("a", "10:10:00", 1.0), ("a", "15:00:00", 2.0))
    feed.run()
    before = feed.figures(gold.closed_hours(spark, f"{feed.folder}/gold"))
    feed.run()
    assert feed.figures(gold.closed_hours(spark, f"{feed.folder}/gold")) == before and feed.equals_batch()


def test_a_cut_run_is_finished(spark, feed, monkeypatch):
    """The run fails once the batch is dealt, before the hours are aggregated, and once within the dealing."""
    feed.deliver(("a", "10:10:00", 1.0), ("b", "14:00:00", 5.0))
    with monkeypatch.context() as patch:
        patch.setattr(gold.rollups, "hourly", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            feed.run()
    feed.run()
    feed.deliver(("a", "10:20:00", 3.0), ("b", "18:00:00", 7.0))
    with monkeypatch.context() as patch:
        patch.setattr(gold, "newest", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="division"):
            feed.run()
    feed.run()
    assert feed.equals_batch()
    assert gold.late_readings(spark, f"{feed.folder}/gold").count() == 1


def test_every_reading_is_dealt_once(spark, feed):
    for k in range(3):
        feed.deliver(*((f"d{i % 5}", f"{(7 * i + 5 * k) % 24:02d}:{i % 60:02d}:00", float(i)) for i in range(40)))
        feed.run()
    dealt = gold.late_readings(spark, f"{feed.folder}/gold").unionByName(
        spark.read.parquet(f"{feed.folder}/gold/timely").drop("batch")
    )
    counts = dealt.agg(F.count("*"), F.count_distinct("entry_id")).head()
    assert tuple(counts) == (120, 120) and feed.equals_batch()
