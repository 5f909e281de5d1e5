import random
import time

import pytest
from conftest import at
from pyspark.sql import functions as F

from gaugeworks.operators import blocks
from gaugeworks.operators.blocks import Directory, Leaf, id_cuts, read_blocks, upsert_blocks
from gaugeworks.session import list_folders

SCHEMA = "device_id string, entry_id bigint, recorded_at timestamp, vibration_rms double"


def batch(spark, rows):
    return spark.createDataFrame([(d, e, at("2024-01-01T00:00:00"), float(v)) for d, e, v in rows], SCHEMA)


def contents(spark, path):
    return sorted(((r["device_id"], r["entry_id"], r["vibration_rms"]) for r in read_blocks(spark, path).collect()), key=str)


def sizes(spark, path):
    return [leaf.rows for leaf in Directory.load(spark, path).leaves]


def test_growth_after_a_first_batch_of_one_device(spark, path):
    """One device first, then many with the same ids, then updates across all: blocks keep to the limit."""
    rng = random.Random(4)
    model = {}
    batches = [
        [("d0", i, 1) for i in range(300)],
        [(f"d{d}", i, 2) for d in range(60) for i in range(20)],
        [(f"d{rng.randrange(60)}", i, 3) for i in rng.sample(range(400), 90)],
        [(f"d{d}", 7, 4) for d in range(400)],
    ]
    for rows in batches:
        upsert_blocks(batch(spark, rows), path("t"), limit=60)
        model.update({(d, e): float(v) for d, e, v in rows})
        assert contents(spark, path("t")) == sorted(((d, e, v) for (d, e), v in model.items()), key=str)
        assert max(sizes(spark, path("t"))) <= 60
    found = Directory.load(spark, path("t"))
    assert len(found.leaves) > 40 and any(leaf.depth for leaf in found.leaves)


def test_one_id_of_many_devices_is_split_by_hash(spark, path):
    upsert_blocks(batch(spark, [(f"d{i}", 5, i) for i in range(500)]), path("t"), limit=50)
    found = Directory.load(spark, path("t"))
    assert max(leaf.rows for leaf in found.leaves) <= 50 and max(leaf.depth for leaf in found.leaves) >= 3
    # Later ids are free of the hash split.
    assert [leaf.depth for leaf in found.leaves if leaf.low == 6] == [0]
    upsert_blocks(batch(spark, [(f"d{i}", 5, -1) for i in range(250)]), path("t"), limit=50)
    assert len(contents(spark, path("t"))) == 500
    assert sum(v == -1 for _, _, v in contents(spark, path("t"))) == 250


def test_blocks_without_a_hit_are_appended_to(spark, path):
    upsert_blocks(batch(spark, [("d1", i, 1) for i in range(0, 1000, 2)]), path("t"), limit=100)
    before = Directory.load(spark, path("t"))
    assert len(before.leaves) >= 6
    # Odd ids are new everywhere; two even ones hit two blocks.
    new = [("d1", i, 2) for i in range(1, 1000, 50)]
    done = upsert_blocks(batch(spark, new), path("t"), limit=200)
    assert (done.rewritten, done.split) == (0, 0) and done.touched >= 5
    done = upsert_blocks(batch(spark, [("d1", 10, 3), ("d1", 13, 3), ("d1", 800, 3)]), path("t"), limit=200)
    assert done.rewritten == 2 and done.split == 0
    rows = {(d, e): v for d, e, v in contents(spark, path("t"))}
    assert rows["d1", 10] == rows["d1", 13] == rows["d1", 800] == 3.0 and len(rows) == 500 + len(new) + 1
    # Old segments of all other blocks are the same ones.
    names = {s.name for s in Directory.load(spark, path("t")).segments()}
    assert len({s.name for s in before.segments()} - names) == 2


def test_filters_let_few_segments_pass(spark, path):
    upsert_blocks(batch(spark, [("d1", i, 1) for i in range(0, 20_000, 2)]), path("t"), limit=300)
    found = Directory.load(spark, path("t"))
    rows = blocks.routed(batch(spark, [("d1", i, 2) for i in range(1, 20_000, 500)]), found)
    held = {n: list(leaf.segments) for n, leaf in enumerate(found.leaves) if leaf.segments}
    possible = blocks.possible_segments(rows, held, path("t"), False)
    assert len(held) > 30 and len(possible) <= 3
    there = blocks.routed(batch(spark, [("d1", 4, 2), ("d1", 19_998, 2)]), found)
    assert len(blocks.possible_segments(there, held, path("t"), False)) >= 2


def test_many_keys_for_one_small_segment_are_shared_out(spark, path, monkeypatch):
    """All keys of a batch look into the one bitmap of a small table: no join may bring them into one group."""
    monkeypatch.setattr(blocks, "PROBES", 10)
    upsert_blocks(batch(spark, [("d1", i, 1) for i in range(20)]), path("t"), limit=10_000)
    found = Directory.load(spark, path("t"))
    held = {n: list(leaf.segments) for n, leaf in enumerate(found.leaves) if leaf.segments}
    for ids, hits in ((range(19, 400), 1), (range(1_000, 1_003), 0)):
        rows = blocks.routed(batch(spark, [("d1", i, 2) for i in ids]), found)
        incoming = {row["_leaf"]: row["count"] for row in rows.groupBy("_leaf").count().collect()}
        assert len(blocks.possible_segments(rows, held, path("t"), False, incoming)) >= hits
    monkeypatch.setattr(blocks, "PROBES", 1)
    upsert_blocks(batch(spark, [("d1", i, 2) for i in range(15, 60)]), path("t"), limit=10_000)
    assert contents(spark, path("t")) == [("d1", i, 1.0 if i < 15 else 2.0) for i in sorted(range(60), key=lambda i: str(("d1", i)))]


def test_untouched_folders_are_neither_listed_nor_read(spark, path):
    upsert_blocks(batch(spark, [("d1", i, 1) for i in range(1000)]), path("t"), limit=100)
    found = Directory.load(spark, path("t"))
    keep = found.leaves[-1].segments[0]
    for segment in found.segments():
        if segment != keep:  # a reader of these would fail
            blocks.delete_path(spark, f"{path('t')}/{segment.name}")
    done = upsert_blocks(batch(spark, [("d1", 999, 9), ("d1", 5000, 9)]), path("t"), limit=1000)
    assert (done.touched, done.rewritten) == (1, 1)


def test_many_segments_become_one(spark, path):
    for k in range(blocks.MAX_SEGMENTS + 2):
        upsert_blocks(batch(spark, [("d1", 100 * k, k)]), path("t"), limit=1000)
    assert max(len(leaf.segments) for leaf in Directory.load(spark, path("t")).leaves) <= blocks.MAX_SEGMENTS
    assert [v for _, _, v in contents(spark, path("t"))] == [float(k) for k in range(blocks.MAX_SEGMENTS + 2)]


@pytest.mark.parametrize("null_safe", [False, True])
def test_null_keys(spark, path, null_safe):
    rows = batch(spark, [("d1", None, 1), (None, 1, 2), ("d1", 1, 3), ("d2", None, 4)])
    upsert_blocks(rows, path("t"), null_safe=null_safe)
    done = upsert_blocks(rows, path("t"), null_safe=null_safe)
    assert len(contents(spark, path("t"))) == (4 if null_safe else 7)
    # Without matching nulls, nothing of the null block is rewritten.
    assert done.rewritten == (2 if null_safe else 1)


def test_rows_that_cannot_be_told_apart_stay_together(spark, path):
    upsert_blocks(batch(spark, [("d1", None, i) for i in range(200)]), path("t"), limit=20)
    assert len(contents(spark, path("t"))) == 200


def test_extreme_ids(spark, path):
    ids = [-(2**63), -(2**63) + 1, -1, 0, 2**63 - 2, 2**63 - 1, None]
    for k in range(2):
        upsert_blocks(batch(spark, [(f"d{i}", e, k) for e in ids for i in range(6)]), path("t"), limit=4, null_safe=True)
    assert len(contents(spark, path("t"))) == 6 * len(ids) and max(sizes(spark, path("t"))) <= 4


def test_an_empty_batch(spark, path):
    nothing = batch(spark, [])
    assert read_blocks(spark, path("t")) is None
    upsert_blocks(nothing, path("t"))
    assert read_blocks(spark, path("t")) is None
    upsert_blocks(batch(spark, [("d1", 1, 1)]), path("t"))
    upsert_blocks(nothing, path("t"))
    assert contents(spark, path("t")) == [("d1", 1, 1.0)]


class Lost(Exception):
    pass


@pytest.mark.parametrize("step", ["_write", "store", "delete"])
def test_a_cut_run_leaves_a_whole_table(spark, path, monkeypatch, step):
    first, second = [("d1", i, 1) for i in range(100)], [("d1", i, 2) for i in range(50, 150)]
    upsert_blocks(batch(spark, first), path("t"), limit=30)
    old, write = contents(spark, path("t")), blocks._write

    def cut(*args, **_):
        if step == "_write":
            write(*args)
        raise Lost

    with monkeypatch.context() as patch:
        if step == "store":
            patch.setattr(Directory, "store", cut)
        else:
            patch.setattr(blocks, "_write" if step == "_write" else "delete_path", cut)
        with pytest.raises(Lost):
            upsert_blocks(batch(spark, second), path("t"), limit=30)
    new = sorted([*(("d1", i, 1.0) for i in range(50)), *(("d1", i, 2.0) for i in range(50, 150))], key=str)
    assert contents(spark, path("t")) == (new if step == "delete" else old)
    assert blocks.vacuum(spark, path("t"))
    assert contents(spark, path("t")) == (new if step == "delete" else old)
    upsert_blocks(batch(spark, second), path("t"), limit=30)
    assert contents(spark, path("t")) == new
    assert blocks.vacuum(spark, path("t")) == []


def test_dates_of_replaced_rows(spark, path):
    def dated(day, ids):
        return spark.createDataFrame([("d1", i, at(f"2024-01-0{day}T00:00:00"), 1.0) for i in ids], SCHEMA)

    upsert_blocks(dated(1, range(10)), path("t"))
    seen = []
    done = upsert_blocks(dated(3, [4, 50]), path("t"), on_dates=lambda d: seen.append({str(r[0]) for r in d.collect()}))
    assert seen == [{"2024-01-01", "2024-01-03"}] == [{str(r[0]) for r in done.dates.collect()}]
    done = upsert_blocks(dated(4, [60]), path("t"), track_dates=True)
    assert {str(r[0]) for r in done.dates.collect()} == {"2024-01-04"}


def test_cuts():
    assert id_cuts(list(range(64)), 0, 63, 2, -10, 100) == [32]
    assert id_cuts([5] * 64, 5, 5, 3, 0, 100) == [5, 6]
    assert id_cuts([5] * 64, 5, 5, 3, 5, 6) == []
    assert id_cuts([5] * 40 + list(range(6, 30)), 5, 29, 2, 0, 100) == [5, 6]
    assert id_cuts(list(range(64)), 0, 63, 500, -1, 100) == list(range(1, 64))
    # Quantiles that rounding has moved outside, or made equal.
    assert id_cuts([2**63 - 1024] * 64, 2**63 - 3, 2**63 - 2, 2, 0, 2**63) == [2**63 - 3, 2**63 - 2]
    assert id_cuts([-(2**63)] * 64, 1 - 2**63, 1 - 2**63, 2, 1 - 2**63, -1) == [2 - 2**63]


def test_every_key_has_one_block(spark):
    """The boxes tile the key space: routing agrees with looking through all of them."""
    rng = random.Random(8)
    leaves = [Leaf(blocks.LOWEST), Leaf(blocks.LOWEST + 1), Leaf(10, 1, 0), Leaf(10, 2, 2), Leaf(10, 3, 6), Leaf(10, 3, 7), Leaf(11), Leaf(500)]
    found = Directory(1, sorted(leaves, key=blocks._order))
    rows = [(f"d{rng.randrange(50)}", rng.choice([None, -4, 9, 10, 10, 10, 11, 499, 500, 9000]), 0) for _ in range(300)]
    df = blocks.routed(batch(spark, rows), found).withColumn("h", blocks.hash_key())
    ends = found.ends()
    for row in df.collect():
        key = blocks.LOWEST if row.entry_id is None else row.entry_id
        holds = [n for n, leaf in enumerate(found.leaves)
                 if leaf.low <= key < ends[leaf.low] and row.h >> (blocks.HASH_BITS - leaf.depth) == leaf.prefix]
        assert holds == [row[blocks.LEAF]]


def test_old_directories_go(spark, path):
    for k in range(5):
        upsert_blocks(batch(spark, [("d1", k, k)]), path("t"))
    assert list_folders(spark, f"{path('t')}/{blocks.DIRECTORY}") == ["4", "5"]
    assert read_blocks(spark, path("t")).agg(F.count("*")).head()[0] == 5


def test_jobs_on_split_blocks_equal_those_on_fixed_blocks(spark, path, monkeypatch):
    """Both forms of the Silver table give the same Gold, in two incremental runs with late and changed readings."""
    import json
    import os

    from gaugeworks.plans import jobs
    from gaugeworks.sources.tables import read_table

    monkeypatch.setattr(blocks.upsert_blocks, "__defaults__", (25, *blocks.upsert_blocks.__defaults__[1:]))
    found = {}
    for split in (False, True):
        where = jobs.Locations.under(path(f"root{split}"))
        for run in (0, 1):
            os.makedirs(where.landing, exist_ok=True)
            with open(f"{where.landing}/{run}.json", "w") as file:
                for i in range(run * 40, run * 40 + 80):
                    # Ids 40 to 79 come twice, the second time on another day.
                    row = {"device_id": f"d{i % 3}", "entry_id": i, "recorded_at": f"2024-01-{10 + i // 40 + 3 * run}T10:00:00Z",
                           "vibration_rms": i + run, "temperature_celsius": 1.0, "pressure_bar": None,
                           "source_channel": 9, "ingested_at": f"2024-01-2{run}T00:00:00Z"}
                    file.write(json.dumps(row) + "\n")
            jobs.run_all(spark, where, incremental=True, split_blocks=split)
        silver = blocks.read_blocks(spark, where.silver) if split else read_table(spark, where.silver)
        assert silver.count() == 120
        found[split] = sorted(map(tuple, read_table(spark, where.daily).drop("_computed_at").collect()), key=str)
        assert blocks.has_directory(spark, where.silver) == split
    assert found[True] == found[False] and len(found[True]) == 9


def test_names_of_segments_are_cut_without_a_search_of_the_path(spark):
    """A search of the whole path for every stored row takes a time that grows with the square of its folders' names."""
    paths = ["file:/a b/c%20d/t/run-1-0a/_segment=7/part-0.parquet", f"s3://b/{'x' * 200}/run-12-ff/_segment=130/part-1-_segment=2.parquet"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select(blocks.segment_name(F.col("p")).alias("name"))
    assert [r["name"] for r in rows.collect()] == ["run-1-0a/_segment=7", "run-12-ff/_segment=130"]
    long = F.concat(F.lit(f"file:/{'y' * 4000}/run-1-0a/_segment="), F.col("id") % 3, F.lit("/part-0.parquet"))
    started = time.monotonic()
    names = spark.range(50_000).select(blocks.segment_name(long).alias("name")).distinct().collect()
    assert sorted(r["name"] for r in names) == [f"run-1-0a/_segment={i}" for i in range(3)]
    assert time.monotonic() - started < 20


def test_hit_segments_search_no_path(spark, path, monkeypatch):
    """The rows of stored segments pass no regular expression."""
    upsert_blocks(batch(spark, [("d1", 1, 1), ("d1", 2, 2)]), path("t"))
    directory = Directory.load(spark, path("t"))
    searched = []
    extract = F.regexp_extract
    monkeypatch.setattr(F, "regexp_extract", lambda *args: searched.append(args) or extract(*args))
    rows = batch(spark, [("d1", 2, 3), ("d1", 5, 3)])
    assert blocks.hit_segments(rows, directory.segments(), path("t"), False) == {s.name for s in directory.segments()}
    assert not searched
