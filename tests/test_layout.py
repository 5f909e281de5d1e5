import random
import shutil

import pytest
from conftest import at
from pyspark.sql import functions as F

from gaugeworks.operators import layout
from gaugeworks.session import list_folders, path_exists
from gaugeworks.sources.tables import read_table

SCHEMA = "day int, device string, t timestamp, n int"


def readings(spark, n=20_000):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        # One device holds a third of the rows.
        device = "device-000" if i % 3 == 0 else f"device-{rng.randrange(1, 400):03d}"
        day = rng.randrange(2)
        rows.append((day, device, at(f"2024-01-0{day + 1}T{rng.randrange(24):02d}:{rng.randrange(60):02d}:00"), i))
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("day", "device", "t", "n").collect())


def test_rank_is_a_binary_search(spark):
    values = [-5, 0, 3, 3, 7, 10, 99, None]
    df = spark.createDataFrame([(v,) for v in values], "v int").withColumn("b", F.array(*[F.lit(x) for x in (0, 3, 3, 4, 7, 8, 50)]))
    found = [r[0] for r in df.select(layout.rank_in(F.col("v"), F.col("b"), 3)).collect()]
    assert found == [0, 1, 3, 3, 5, 6, 7, 0]


@pytest.mark.parametrize("columns, bits", [(1, 5), (2, 4), (3, 3)])
def test_bits_are_interleaved(spark, columns, bits):
    rng = random.Random(columns)
    rows = [tuple(rng.randrange(1 << bits) for _ in range(columns)) for _ in range(50)]
    names = [f"c{j}" for j in range(columns)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    found = [r[0] for r in df.select(layout.interleaved([F.col(n) for n in names], bits)).collect()]
    want = [int("".join(str(row[j] >> bit & 1) for bit in reversed(range(bits)) for j in range(columns)), 2) for row in rows]
    assert found == want


def test_a_filter_on_either_column_reads_few_files(spark, path):
    df = readings(spark)
    df.repartition(40).write.partitionBy("day").parquet(path("t"))
    layout.compact(spark, path("t"), "day", "device", "t", partitions=128, zorder=True)
    layout.compact(spark, path("t"), "day", "device", "t", partitions=128, target=path("sorted"))
    table, by_device = read_table(spark, path("t")), read_table(spark, path("sorted"))
    assert rows_of(table) == rows_of(df)
    for day in (0, 1):
        one = table.filter(F.col("day") == day)
        shares = {}
        for column, value in (("device", "device-123"), ("t", at(f"2024-01-0{day + 1}T13:30:00"))):
            row = layout.files_to_read(one, column, value).first()
            assert row["files"] >= 40
            shares[column] = row["read"] / row["files"]
        assert shares["device"] <= 0.25 and shares["t"] <= 0.3
        # Sorted by one column after the other, most files span most times.
        row = layout.files_to_read(by_device.filter(F.col("day") == day), "t", at(f"2024-01-0{day + 1}T13:30:00")).first()
        assert row["read"] / row["files"] > 0.6


def test_nulls_and_a_null_partition(spark, path):
    rows = [(None, None, None, 1), (None, "d1", None, 2), (1, None, at("2024-01-01T00:00:00"), 3), (1, "d2", None, 4)]
    df = spark.createDataFrame(rows * 5, SCHEMA)
    df.repartition(4).write.partitionBy("day").parquet(path("t"))
    layout.compact(spark, path("t"), "day", "device", "t", zorder=True)
    key = lambda r: str(r)
    found = read_table(spark, path("t")).select("day", "device", "t", "n").collect()
    assert sorted(map(tuple, found), key=key) == sorted(map(tuple, df.collect()), key=key)


class Lost(Exception):
    pass


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_a_cut_swap_is_finished_by_the_next_run(spark, path, monkeypatch, moved):
    """The driver is lost after so many partitions were moved, once with an old folder already gone."""
    df = readings(spark, 600)
    df.repartition(6).write.partitionBy("day").parquet(path("t"))
    done = []

    def cut(spark_, new, old):
        if len(done) == moved:
            shutil.rmtree(old)
            raise Lost
        done.append(old)
        replace(spark_, new, old)

    replace = layout._replace_folder
    monkeypatch.setattr(layout, "_replace_folder", cut)
    if moved < 2:
        with pytest.raises(Lost):
            layout.compact(spark, path("t"), "day", "device", "t", partitions=2, zorder=True)
        assert path_exists(spark, path("t") + "/_compacted/ready")
    monkeypatch.setattr(layout, "_replace_folder", replace)
    layout.finish_swap(spark, path("t"))
    assert rows_of(read_table(spark, path("t"))) == rows_of(df)
    assert list_folders(spark, path("t")) == ["day=0", "day=1"]


def test_a_run_cut_before_it_was_ready_changes_nothing(spark, path, monkeypatch):
    df = readings(spark, 300)
    df.repartition(6).write.partitionBy("day").parquet(path("t"))

    def cut(*_):
        raise Lost

    monkeypatch.setattr(layout, "touch", cut)
    with pytest.raises(Lost):
        layout.compact(spark, path("t"), "day", "device", "t", zorder=True)
    before = rows_of(read_table(spark, path("t")))
    monkeypatch.undo()
    layout.finish_swap(spark, path("t"))
    assert before == rows_of(read_table(spark, path("t"))) == rows_of(df)
    assert not path_exists(spark, path("t") + "/_compacted")


def test_gold_finishes_a_cut_compaction_before_it_writes(spark, path, monkeypatch):
    """Otherwise the older copy would replace what the job has just written."""
    from gaugeworks.plans import gold, jobs

    where = jobs.Locations.under(path("root"))
    silver = spark.createDataFrame([("d1", 1, at("2024-01-01T10:00:00"), 1.0, 1.0, 1.0)],
                                   "device_id string, entry_id bigint, recorded_at timestamp, vibration_rms double, temperature_celsius double, pressure_bar double")
    gold.rebuild(silver, where.hourly, where.daily)

    def cut(*_):
        raise Lost

    monkeypatch.setattr(layout, "_replace_folder", cut)
    with pytest.raises(Lost):
        layout.compact(spark, where.hourly, gold.HOURLY_PARTITION, "device_id", "window_start", zorder=True)
    monkeypatch.undo()
    monkeypatch.setattr(jobs, "read_upserted", lambda *_: silver.withColumn("vibration_rms", F.lit(7.0)))
    jobs.run_gold(spark, where)
    assert [r["avg_vibration_rms"] for r in read_table(spark, where.hourly).collect()] == [7.0]
    assert not path_exists(spark, where.hourly + "/_compacted")
