import json
import os

import pytest
from conftest import at
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from gaugeworks.__main__ import main
from gaugeworks.operators import layout
from gaugeworks.operators import upsert as upsert_module
from gaugeworks.operators.cleanse import clean, latest_delivery
from gaugeworks.operators.rollups import daily, hourly, sentinel_to_null
from gaugeworks.operators.scoring import score_daily
from gaugeworks.operators.upsert import read_upserted, upsert
from gaugeworks.plans import gold, jobs
from gaugeworks.sources import landing, tables
from gaugeworks.sources.schemas import READING
from gaugeworks.sources.tables import read_if_exists, read_table, write_table
from gaugeworks.streaming import bronze as bronze_stream
from gaugeworks.streaming import delivery
from gaugeworks.streaming.silver import bronze_stream as new_bronze_files
from gaugeworks.streaming.silver import upsert_stream


def reading(device, entry, recorded, vibration=1.0):
    return (device, entry, recorded, vibration, 20.0, 1.0, 9, "2024-01-01T00:00:00Z")


def land(spark, where, *rows):
    landing.write_landing(spark.createDataFrame(list(rows), READING), where)


def test_bronze_takes_each_file_once(spark, path):
    def run():
        stream = bronze_stream.to_bronze(bronze_stream.landing_stream(spark, path("landing")))
        bronze_stream.write_bronze(stream, path("bronze"), path("checkpoint"))
        return read_table(spark, path("bronze"))

    land(spark, path("landing"), reading("d1", 1, "2024-01-15T14:30:00Z"), reading("d1", 2, "soon"))
    first = run()
    assert first.columns == [*READING.names, *bronze_stream.AUDIT, "_partition_date"]
    assert sorted(str(r["_partition_date"]) for r in first.collect()) == ["2024-01-15", "None"]
    assert first.select("_batch_id").distinct().count() == 1
    assert all("/year=" in r["_source_file"] for r in first.collect())
    assert run().count() == 2
    land(spark, path("landing"), reading("d2", 3, "2024-01-16T00:00:00Z"))
    third = run()
    assert third.count() == 3
    assert third.select("_batch_id").distinct().count() == 2


def test_stream_mode_is_checked(spark, path):
    land(spark, path("landing"), reading("d1", 1, "2024-01-15T14:30:00Z"))
    stream = bronze_stream.to_bronze(bronze_stream.landing_stream(spark, path("landing")))
    with pytest.raises(ValueError):
        bronze_stream.write_bronze(stream, path("bronze"), path("checkpoint"), "sometimes")


def test_continuous_bronze_keeps_running(spark, path):
    where = jobs.Locations.under(path("root"))
    land(spark, where.landing, reading("d1", 1, "2024-01-15T14:30:00Z"))
    query = jobs.run_bronze(spark, where, bronze_stream.CONTINUOUS)
    try:
        query.processAllAvailable()
        assert query.isActive
        assert read_table(spark, where.bronze).count() == 1
    finally:
        query.stop()


def test_contract_splits_the_stream(spark, path):
    where = jobs.Locations.under(path("root"))
    land(spark, where.landing, reading("d1", 1, "2024-01-15T14:30:00Z"))
    extra = json.dumps({"device_id": "d2", "entry_id": "2", "recorded_at": "x"})
    spark.createDataFrame([(extra,), ("{half",)], "value string").write.mode("append").text(f"{where.landing}/year=2024/month=01/day=01/hour=00")
    for _ in range(2):
        jobs.run_bronze(spark, where, check_contract=True)
    assert [r["device_id"] for r in read_table(spark, where.bronze).collect()] == ["d1"]
    bad = read_table(spark, where.quarantine).collect()
    assert sorted(tuple(r["violations"]) for r in bad) == [("not_json",), ("type:entry_id", "format:recorded_at")]
    assert {r["value"] for r in bad} == {extra, "{half"}


def test_delivery_writes_the_landing_layout(spark, path):
    write_table(spark.createDataFrame([reading("d1", 1, "2024-01-15T14:30:00Z", None)], READING), path("in"))
    stream = spark.readStream.schema(READING).parquet(path("in"))
    delivery.deliver(stream, path("landing"), path("checkpoint"), bronze_stream.AVAILABLE_NOW)
    (folder,) = [d for d, _, files in os.walk(path("landing")) if any(f.endswith(".json") for f in files)]
    assert [part.split("=")[0] for part in folder.split("/")[-4:]] == ["year", "month", "day", "hour"]
    assert landing.read_landing(spark, path("landing")).select(*READING.names).count() == 1


BRONZE = StructType([*READING.fields, StructField("_ingested_at", TimestampType())])


def bronze_rows(spark, *rows):
    return spark.createDataFrame([(*reading(*r[:-1]), at(r[-1])) for r in rows], BRONZE)


FIRST = [
    ("d1", 1, "2024-01-01T10:00:00Z", 1.0, "2024-01-01T11:00:00"),
    ("d1", 2, "2024-01-02T10:00:00Z", 2.0, "2024-01-02T11:00:00"),
    ("d1", 3, "2024-01-05T10:00:00Z", 4.0, "2024-01-05T11:00:00"),
    ("d2", 4, "2024-01-03T10:00:00Z", 5.0, "2024-01-03T11:00:00"),
    ("d2", 5, "2024-01-05T10:00:00Z", 5.0, "2024-01-05T11:00:00"),
]
SECOND = [
    ("d1", 2, "2024-01-02T10:00:00Z", 9.0, "2024-01-06T11:00:00"),  # corrected
    ("d2", 4, "2024-01-04T10:00:00Z", 6.0, "2024-01-06T11:00:00"),  # moved to another date
    ("d2", 9, "2024-01-03T23:00:00Z", 7.0, "2024-01-06T11:00:00"),  # late
]


def test_incremental_silver_equals_full(spark, path):
    seen = []
    for rows in (FIRST, SECOND, SECOND):
        write_table(bronze_rows(spark, *rows), path("bronze"))
        stream = new_bronze_files(spark, path("bronze"))
        upsert_stream(stream, path("silver"), path("checkpoint"), on_dates=lambda dates: seen.append(dates.collect()))
    full = latest_delivery(clean(bronze_rows(spark, *FIRST, *SECOND)))
    found = read_upserted(spark, path("silver")).drop("_silver_updated_at")
    assert sorted(found.collect()) == sorted(full.collect())
    assert sorted(str(r["date"]) for r in seen[1]) == ["2024-01-02", "2024-01-03", "2024-01-04"]


def without_times(df):
    return sorted(str(r) for r in df.drop("_computed_at", gold.HOURLY_PARTITION).collect())


@pytest.mark.parametrize("frame_rows", [2, 4])
@pytest.mark.parametrize("max_values", [0, 1000])
def test_refresh_equals_rebuild(spark, path, monkeypatch, frame_rows, max_values):
    of = gold.ChangedDates.of
    monkeypatch.setattr(gold.ChangedDates, "of", lambda dates: of(dates, max_values))
    upsert(latest_delivery(clean(bronze_rows(spark, *FIRST))), path("silver"))
    gold.rebuild(read_upserted(spark, path("silver")), path("hourly"), path("daily"), frame_rows)
    dates = upsert(latest_delivery(clean(bronze_rows(spark, *SECOND))), path("silver"), track_dates=True)
    silver = read_upserted(spark, path("silver"))
    gold.refresh(silver, path("hourly"), path("daily"), dates, frame_rows)
    readings = sentinel_to_null(silver)
    expected = score_daily(daily(readings), frame_rows)
    assert without_times(read_table(spark, path("daily")).select(*expected.columns)) == without_times(expected)
    expected = hourly(readings)
    assert without_times(read_table(spark, path("hourly")).select(*expected.columns)) == without_times(expected)


def test_refresh_with_undated_readings(spark, path):
    undated = [("d1", 7, "soon", 3.0, "2024-01-06T11:00:00"), ("d2", 8, "2024-01-06T00:00:00Z", 1.0, "2024-01-06T11:00:00")]
    upsert(latest_delivery(clean(bronze_rows(spark, *FIRST))), path("silver"))
    gold.rebuild(read_upserted(spark, path("silver")), path("hourly"), path("daily"))
    dates = upsert(latest_delivery(clean(bronze_rows(spark, *undated))), path("silver"), track_dates=True)
    silver = read_upserted(spark, path("silver"))
    gold.refresh(silver, path("hourly"), path("daily"), dates)
    expected = score_daily(daily(sentinel_to_null(silver)))
    assert without_times(read_table(spark, path("daily")).select(*expected.columns)) == without_times(expected)


def test_refresh_without_changes_is_a_no_op(spark, path):
    silver = latest_delivery(clean(bronze_rows(spark, *FIRST)))
    gold.rebuild(silver, path("hourly"), path("daily"))
    before = without_times(read_table(spark, path("daily")))
    gold.refresh(silver, path("hourly"), path("daily"), spark.createDataFrame([], "date date"))
    assert without_times(read_table(spark, path("daily"))) == before


def test_compaction_keeps_rows_and_lowers_the_file_count(spark, path):
    df = spark.range(400).select(
        (F.col("id") % 2).alias("day"), F.concat(F.lit("d"), F.col("id") % 5).alias("device_id"), F.col("id").alias("t")
    )
    df.repartition(8).write.partitionBy("day").parquet(path("t"))
    before = layout.file_layout(read_table(spark, path("t"))).first()
    layout.compact(spark, path("t"), "day", "t", "device_id", partitions=2)
    after = layout.file_layout(read_table(spark, path("t"))).first()
    assert before["files"] == 16 and after["files"] <= 4
    assert sorted(read_table(spark, path("t")).select(*df.columns).collect()) == sorted(df.collect())


@pytest.mark.parametrize("incremental", [False, True])
def test_all_jobs_twice(spark, path, incremental):
    where = jobs.Locations.under(path("root"))
    payloads = spark.createDataFrame(
        [(9, json.dumps({"feeds": [{"entry_id": 1, "created_at": "2024-01-15T14:30:00Z", "field1": "2"}]}))],
        "channel_id int, payload string",
    )
    jobs.run_landing(spark, payloads, where)
    jobs.run_all(spark, where, incremental=incremental)
    land(spark, where.landing, reading("device-001", 2, "2024-01-16T14:30:00Z", 6.0), reading("device-001", 1, "2024-01-15T14:30:00Z", 4.0))
    jobs.run_all(spark, where, incremental=incremental)

    silver = read_upserted(spark, where.silver)
    assert sorted((r["device_id"], r["entry_id"], r["vibration_rms"]) for r in silver.collect()) == [
        ("device-001", 1, 4.0),
        ("device-001", 2, 6.0),
        ("device-003", 1, 2.0),
    ]
    table = read_table(spark, where.daily)
    found = {(r["device_id"], str(r["date"])): round(r["vibration_zscore"], 4) for r in table.collect()}
    assert found == {("device-001", "2024-01-15"): 0.0, ("device-001", "2024-01-16"): 0.7071, ("device-003", "2024-01-15"): 0.0}
    assert read_table(spark, where.hourly).count() == 3
    reported = read_table(spark, where.metrics).groupBy("metric_name").agg(F.max("value").alias("v"))
    highest = {r["metric_name"]: r["v"] for r in reported.collect()}
    assert (highest["BronzeRowCount"], highest["SilverRowCount"], highest["GoldDailyRowCount"]) == (4.0, 3.0, 3.0)
    assert {"RecordsIngested", "BronzeWriteLatencyMs", "SilverWriteLatencyMs", "GoldWriteLatencyMs"} <= set(highest)
    checks = read_table(spark, where.quality)
    assert checks.filter("table_name = 'bronze_sensors' AND check_name = 'null_rate_pressure_bar' AND NOT passed").count() > 0
    assert checks.filter("table_name = 'silver_sensors' AND check_name LIKE 'value_range%' AND passed").count() > 0
    if incremental:
        assert read_if_exists(spark, where.pending_dates) is None


def test_command_line(spark, path):
    root = path("root")
    land(spark, f"{root}/inbox", reading("d1", 1, "2024-01-15T14:30:00Z"))
    main(["bronze", "--root", root, "--source-path", f"{root}/inbox"])
    main(["silver", "--root", root])
    main(["gold", "--root", root, "--skip-optimize", "--frame-rows", "14"])
    main(["metrics", "--root", root])
    assert read_table(spark, f"{root}/gold_sensors_daily").count() == 1
    assert read_table(spark, f"{root}/metrics").filter("metric_name = 'GoldTableLastUpdate'").count() == 1


def land_file(spark, folder, name, *rows):
    spark.createDataFrame(rows, READING).coalesce(1).write.json(f"{folder}/part={name}")


def gold_days(spark, ref):
    return sorted((r["device_id"], str(r["date"]), r["reading_count"]) for r in read_table(spark, ref).collect())


@pytest.mark.parametrize("incremental", [False, True])
def test_emptied_dates_leave_gold(spark, path, incremental):
    where = jobs.Locations.under(path("root"))
    land(spark, where.landing, reading("d1", 1, "2024-01-15T14:30:00Z", 1.0), reading("d1", 2, "2024-01-20T14:30:00Z", 2.0))
    jobs.run_all(spark, where, incremental=incremental)
    land(spark, where.landing, reading("d1", 1, "2024-01-16T14:30:00Z", 4.0))
    jobs.run_all(spark, where, incremental=incremental)
    assert gold_days(spark, where.daily) == [("d1", "2024-01-16", 1), ("d1", "2024-01-20", 1)]
    assert read_table(spark, where.hourly).count() == 2


def test_former_dates_survive_a_failed_swap(spark, path, monkeypatch):
    where = jobs.Locations.under(path("root"))
    land(spark, where.landing, reading("d1", 1, "2024-01-15T14:30:00Z", 1.0), reading("d1", 2, "2024-01-15T15:30:00Z", 1.0))
    jobs.run_all(spark, where, incremental=True)
    land(spark, where.landing, reading("d1", 1, "2024-01-17T14:30:00Z", 4.0))
    jobs.run_bronze(spark, where)
    real = upsert_module._write_blocks

    def lost_after_swap(df, target):
        real(df, target)
        if not target.endswith("/blocks"):
            raise RuntimeError("driver lost")

    monkeypatch.setattr(upsert_module, "_write_blocks", lost_after_swap)
    with pytest.raises(Exception, match="driver lost"):
        jobs.run_silver(spark, where, incremental=True)
    monkeypatch.undo()
    jobs.run_silver(spark, where, incremental=True)
    jobs.refresh_pending(spark, where)
    assert gold_days(spark, where.daily) == [("d1", "2024-01-15", 1), ("d1", "2024-01-17", 1)]


def test_a_swap_that_was_cut_is_finished(spark, path, monkeypatch):
    rows = [(f"d{i}", i, f"2024-01-01T1{i}:00:00Z", float(i), "2024-01-01T20:00:00") for i in range(5)]
    upsert(latest_delivery(clean(bronze_rows(spark, *rows))), path("silver"))
    real = upsert_module._write_blocks

    def cut(df, target):
        if not target.endswith("/blocks"):  # the old block is gone, the new one is not there yet
            tables.drop_partitions(spark, target, upsert_module.BLOCK, [0])
            raise RuntimeError("driver lost")
        real(df, target)

    monkeypatch.setattr(upsert_module, "_write_blocks", cut)
    with pytest.raises(RuntimeError):
        upsert(latest_delivery(clean(bronze_rows(spark, rows[0]))), path("silver"))
    monkeypatch.undo()
    upsert(latest_delivery(clean(bronze_rows(spark, rows[0]))), path("silver"))
    assert sorted(r["device_id"] for r in read_upserted(spark, path("silver")).collect()) == [f"d{i}" for i in range(5)]


def test_dates_left_during_a_refresh_stay_pending(spark, path, monkeypatch):
    where = jobs.Locations.under(path("root"))
    land(spark, where.landing, reading("d1", 1, "2024-01-15T14:30:00Z", 1.0))
    jobs.run_bronze(spark, where)
    jobs.run_silver(spark, where, incremental=True)
    real = jobs.run_gold

    def meanwhile(*args, **options):
        jobs.publish_dates(spark.createDataFrame([(at("2024-02-01").date(),)], "date date"), where)
        real(*args, **options)

    monkeypatch.setattr(jobs, "run_gold", meanwhile)
    jobs.refresh_pending(spark, where)
    assert [str(r["date"]) for r in read_table(spark, where.pending_dates).collect()] == ["2024-02-01"]


def test_every_batch_is_checked_beyond_the_progress_limit(spark, path):
    where = jobs.Locations.under(path("root"))
    for k in range(5):
        land_file(spark, where.landing, k, reading(None if k < 3 else "d1", k, "2024-01-15T14:30:00Z", 1.0))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        jobs.run_bronze(spark, where, maxFilesPerTrigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    checks = read_table(spark, where.quality)
    assert checks.filter("check_name = 'min_row_count'").count() == 5
    assert checks.filter("check_name = 'null_rate_device_id' AND NOT passed").count() == 3


def test_continuous_mode_reports_and_stops(spark, path):
    where = jobs.Locations.under(path("root"))
    land(spark, where.landing, reading("d1", 1, "2024-01-15T14:30:00Z", 1.0))
    running = jobs.run_bronze(spark, where, bronze_stream.CONTINUOUS)
    running.query.processAllAvailable()
    assert running.isActive
    running.stop()
    assert read_table(spark, where.quality).filter("check_name = 'min_row_count'").count() == 1


@pytest.mark.parametrize("files", [1, 10])
def test_null_ids_do_not_depend_on_batches(spark, path, files):
    where = jobs.Locations.under(path("root"))
    for k in range(3):
        land_file(spark, where.landing, k, reading("d1", None, f"2024-01-15T1{k}:30:00Z", float(k)), reading("d2", k, "2024-01-15T10:00:00Z", 1.0))
    jobs.run_bronze(spark, where)
    for _ in range(2):
        jobs.run_silver(spark, where, incremental=True, maxFilesPerTrigger=files)
    found = read_upserted(spark, where.silver)
    assert sorted(found.groupBy("device_id").count().collect()) == [("d1", 1), ("d2", 3)]
    jobs.run_silver(spark, where)
    assert read_upserted(spark, where.silver).count() == 4


def test_only_worn_partitions_are_compacted(spark, path):
    df = spark.range(600).select((F.col("id") % 3).alias("day"), F.col("id").alias("t"))
    df.filter("day < 2").repartition(8).write.partitionBy("day").parquet(path("t"))
    df.filter("day = 2").coalesce(1).write.mode("append").partitionBy("day").parquet(path("t"))
    worn = layout.fragmented(read_table(spark, path("t")), "day")
    before = {f for f in os.listdir(f"{path('t')}/day=2")}
    layout.compact(spark, path("t"), "day", "t", only=worn, partitions=1)
    assert sorted(worn) == [0, 1] and {f for f in os.listdir(f"{path('t')}/day=2")} == before
    assert layout.fragmented(read_table(spark, path("t")), "day") == []
    assert sorted(read_table(spark, path("t")).select("day", "t").collect()) == sorted(df.collect())


def test_command_line_refuses_what_a_job_does_not_know():
    for words in (["silver", "--continuous"], ["gold", "--check-contract"], ["bronze", "--dry-run"], ["landing"]):
        with pytest.raises(SystemExit):
            main([*words, "--root", "/nowhere"])


def test_all_passes_the_contract_on(spark, path):
    root = path("root")
    os.makedirs(f"{root}/landing")
    with open(f"{root}/landing/a.json", "w") as file:
        file.write(json.dumps({"device_id": "d1", "entry_id": 1, "recorded_at": "2024-01-15T14:30:00Z"}) + "\n{broken\n")
    main(["all", "--root", root, "--check-contract", "--max-files", "1", "--daily-table", f"{root}/by_day"])
    assert read_table(spark, f"{root}/bronze_sensors").count() == 1
    assert [r["value"] for r in read_table(spark, f"{root}/quarantine").collect()] == ["{broken"]
    assert read_table(spark, f"{root}/by_day").count() == 1
