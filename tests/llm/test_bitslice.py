import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import bitslice


def plain(vectors, queries, k):
    out = set()
    for q, a in queries:
        own = next((n for n, (i, b) in enumerate(vectors) if i == q and list(a) == list(b)), None)
        scores = [(-sum(int(x) * int(y) for x, y in zip(a, b)), i) for n, (i, b) in enumerate(vectors) if n != own]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, [int(x) for x in v]) for i, v in rows], "id long, whole array<long>")


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", 70)
    monkeypatch.setattr(bitslice, "QUERY_ROWS", 3)
    rng = np.random.default_rng(0)
    rows = [(i, rng.integers(-200, 200, 9)) for i in range(0, 400, 2)]
    rows += [(1001 + i, rows[5][1]) for i in range(40)]  # ties at the boundary
    df = frame(spark, rows)
    queries = [r for r in rows if r[0] % 50 == 0 or r[0] == 1003]
    for k in (1, 5, 300):
        got = {tuple(r) for r in bitslice.top(df, frame(spark, queries), k).collect()}
        assert got == plain(rows, queries, k)


def test_scores_from_bitmaps():
    rng = np.random.default_rng(2)
    for low, high in ((0, 1), (-1, 1), (-300, 300), (5, 6)):
        values = rng.integers(low, high + 1, (130, 6))
        bits = max(1, int(values.max() - values.min()).bit_length())
        slices = bitslice.slices_of(values - values.min(), bits)
        for query in rng.integers(-40, 40, (10, 6)):
            sums, shift = bitslice.scores(slices, query)
            rows, found = bitslice.best(sums, bitslice._ones(130), 130)
            want = values @ query
            shift += int(values.min()) * int(query.sum())
            assert sorted(rows.tolist()) == list(range(130))
            assert [v + shift for v in found] == want[rows].tolist()


def test_unusable_and_odd_vectors(spark):
    rows = [
        (1, [0.5, -0.5]), (2, None), (3, [0.1, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]),
        (6, [0.00390625, -0.001]), (7, []), (None, [1.0, 1.0]), (1, [0.5, -0.5]), (50, [1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.select(F.col("vec_id").alias("id"), bitslice.quantised(F.col("embedding")).alias("whole"), F.lit(1).alias("score"))
    assert {r.id: r.whole for r in df.collect() if r.whole is not None and r.id} == {
        1: [128, -128], 6: [1, -1], 7: [], 50: [256]
    }
    got = {tuple(r) for r in bitslice.top(df, df.where("id % 50 = 0"), 5).collect()}
    assert got == {(50, 1, 1, 32768), (50, 2, 1, 32768), (50, 3, 6, 256), (50, 4, 7, 0)}
    with pytest.raises(Exception, match="too large"):
        spark.createDataFrame([(1, [1e15])], "vec_id long, embedding array<double>").select(bitslice.quantised(F.col("embedding"))).collect()
    nothing = df.where("false")
    assert bitslice.top(nothing, nothing, 5).count() == 0 and bitslice.top(df, nothing, 5).count() == 0
    assert bitslice.top(df.where("id = 50"), df.where("id = 50"), 5).count() == 0


def test_repeated_queries_and_large_components(spark, monkeypatch):
    """Each row of a repeated id is a query with an answer of its own; no component is cut."""
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", 3)
    monkeypatch.setattr(bitslice, "QUERY_ROWS", 2)
    rows = [(50, [1, 2]), (50, [-3, 1]), (50, [1, 2]), (1, [70_000 * 256, 0]), (2, [200_000 * 256, 1]), (3, [-(2**40), 2**20]), (100, [256, 0])]
    queries = [r for r in rows if r[0] % 50 == 0]
    got = sorted(map(tuple, bitslice.top(frame(spark, rows), frame(spark, queries), 4).collect()))
    want = []
    for q, a in queries:
        want += plain(rows, [(q, a)], 4)
    assert got == sorted(want) and len(got) == 16
    assert (100, 1, 2, 200_000 * 256 * 256) in got and (100, 2, 1, 70_000 * 256 * 256) in got
