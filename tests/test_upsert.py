import pytest
from conftest import at

from gaugeworks.operators import joins
from gaugeworks.operators.upsert import BLOCK, key_block, read_upserted, touched_target, upsert

SCHEMA = "device_id string, entry_id bigint, recorded_at timestamp, vibration_rms double"


def batch(spark, *rows):
    full = [(d, e, at(t), v) for d, e, v, t in (r if len(r) == 4 else (*r, "2024-01-01T00:00:00") for r in rows)]
    return spark.createDataFrame(full, SCHEMA)


def contents(df):
    return sorted(((r["device_id"], r["entry_id"], r["vibration_rms"]) for r in df.collect()), key=str)


def test_creates_then_updates_and_inserts(spark, path):
    upsert(batch(spark, ("d1", 1, 1.0), ("d1", 2, 2.0), ("d2", 1, 3.0)), path("s"), block_size=10)
    upsert(batch(spark, ("d1", 2, 9.0), ("d1", 3, 4.0)), path("s"))
    assert contents(read_upserted(spark, path("s"))) == [("d1", 1, 1.0), ("d1", 2, 9.0), ("d1", 3, 4.0), ("d2", 1, 3.0)]
    assert BLOCK not in read_upserted(spark, path("s")).columns


def test_rerun_changes_nothing(spark, path):
    for _ in range(3):
        upsert(batch(spark, ("d1", 1, 1.0), ("d1", 25, 2.0)), path("s"), block_size=10)
    assert contents(read_upserted(spark, path("s"))) == [("d1", 1, 1.0), ("d1", 25, 2.0)]


def test_only_touched_blocks_are_rewritten(spark, path):
    upsert(batch(spark, ("d1", 5, 1.0), ("d1", 15, 2.0), ("d1", 95, 3.0)), path("s"), block_size=10)

    def files():
        df = spark.read.parquet(path("s")).select("_metadata.file_path", BLOCK)
        return {(r[BLOCK], r["file_path"]) for r in df.collect()}

    before = files()
    upsert(batch(spark, ("d1", 16, 4.0)), path("s"), block_size=777)  # the stored size counts
    after = files()
    assert {b for b, _ in before - after} == {1}
    assert {b for b, _ in after} == {0, 1, 9}


def test_null_keys(spark, path):
    rows = batch(spark, ("d1", None, 1.0), ("d1", 1, 2.0))
    upsert(rows, path("s"))
    upsert(rows, path("s"))
    assert contents(read_upserted(spark, path("s"))) == [("d1", 1, 2.0), ("d1", None, 1.0), ("d1", None, 1.0)]
    for _ in range(2):
        upsert(rows, path("t"), null_safe=True)
    assert contents(read_upserted(spark, path("t"))) == [("d1", 1, 2.0), ("d1", None, 1.0)]


def test_blocks_of_extreme_ids(spark):
    ids = [0, 9, 10, -1, -10, -11, 2**53 + 1, 2**63 - 1, None]
    df = spark.createDataFrame([(i,) for i in ids], "entry_id bigint")
    found = [r[0] for r in df.select(key_block(10)).collect()]
    assert found == [-1 if i is None else i // 10 for i in ids]


@pytest.mark.parametrize("max_values", [0, 1, 100])
def test_pruning_by_list_or_join_gives_the_same(spark, path, max_values):
    upsert(batch(spark, *[("d1", e, float(e)) for e in range(50)]), path("s"), block_size=10)
    target = spark.read.parquet(path("s"))
    new = batch(spark, ("d1", 5, 0.0), ("d1", 47, 0.0)).withColumn(BLOCK, key_block(10))
    found = touched_target(target, new, max_values).select("entry_id").collect()
    assert sorted(r[0] for r in found) == [*range(10), *range(40, 50)]


def test_listed_blocks_prune_folders(spark, path):
    upsert(batch(spark, ("d1", 5, 1.0), ("d1", 15, 2.0)), path("s"), block_size=10)
    new = batch(spark, ("d1", 5, 0.0)).withColumn(BLOCK, key_block(10))
    plan = touched_target(spark.read.parquet(path("s")), new)._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({BLOCK}" in plan


def test_changed_dates_include_those_of_replaced_rows(spark, path):
    upsert(batch(spark, ("d1", 1, 1.0, "2024-01-01T05:00:00"), ("d1", 2, 1.0, "2024-01-09T05:00:00")), path("s"))
    moved = batch(spark, ("d1", 1, 1.0, "2024-01-03T05:00:00"))
    dates = upsert(moved, path("s"), track_dates=True).collect()
    assert sorted(str(r["date"]) for r in dates) == ["2024-01-01", "2024-01-03"]


def test_batch_may_read_the_table_itself(spark, path):
    upsert(batch(spark, ("d1", 1, 1.0), ("d1", 2, 2.0)), path("s"))
    doubled = read_upserted(spark, path("s")).selectExpr("device_id", "entry_id", "recorded_at", "vibration_rms * 2 AS vibration_rms")
    upsert(doubled, path("s"))
    assert contents(read_upserted(spark, path("s"))) == [("d1", 1, 2.0), ("d1", 2, 4.0)]


def test_joins_agree(spark):
    facts = spark.range(1000).selectExpr("CASE WHEN id % 3 > 0 THEN 7 ELSE id END AS k", "id AS v").repartition(6)
    dimension = spark.createDataFrame([(7, "a"), (7, "b"), (9, "c"), (9000, "d")], "k bigint, name string")
    plain = sorted(facts.join(dimension, ["k"]).collect())
    assert len(plain) > 1300
    assert sorted(joins.join_dimension(facts, dimension, ["k"]).collect()) == plain
    assert sorted(joins.join_dimension(facts, dimension, ["k"], max_rows=2).collect()) == plain
    assert sorted(joins.salted_join(facts, dimension, ["k"], salts=5).collect()) == plain


def test_salted_join_broadcasts_no_repeated_dimension(spark, tmp_path):
    spark.range(2000).selectExpr("id % 50 k", "id v").write.parquet(f"{tmp_path}/facts")
    spark.range(50).selectExpr("id k", "id * 2 w").write.parquet(f"{tmp_path}/dimension")
    facts, dimension = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("facts", "dimension"))
    joined = joins.salted_join(facts, dimension, ["k"])
    assert joined.count() == 2000
    assert "Broadcast" not in joined._jdf.queryExecution().toString()


def test_salted_join_takes_maps_at_any_depth(spark):
    facts = spark.range(40).selectExpr(
        "id % 3 AS k", "id AS v", "map('a', id) AS m", "named_struct('x', map('a', id), 'map', id) AS s",
        "array(map('a', id)) AS l", "array(named_struct('map', id)) AS variant",
    )
    dimension = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "k long, name string")
    got = joins.salted_join(facts, dimension, ["k"], salts=5)
    assert sorted((r.v, r.name) for r in got.collect()) == sorted(
        (v, name) for v in range(40) for k, name in ((0, "a"), (1, "b"), (1, "c")) if v % 3 == k
    )
    assert got.columns == [*facts.columns, "name"]
