"""Exact top-k by inner product over a bit-sliced index (operator 3).

Components become whole numbers. The index holds blocks of ``BLOCK_ROWS`` vectors,
stored as bit slices: one bitmap for each dimension and each bit, over the rows of
the block in order of their ids. A query's scores for a whole block come from
bitmap arithmetic alone: every set bit of the query's component adds the slices of
that dimension, shifted, and slices of equal weight are added up three at a time
by carry-save adders until one is left for each bit of the score.

The best rows are selected from the most significant slice of the scores down.
Rows that are still equal after the last slice are the boundary; of these, the
smallest ids fill the places that are left, which makes the result exact.

Every block of queries meets every block of the index once; what they send on is
``k`` rows for each query, and those of a query are ranked together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.session import stage

SCALE = 256
BLOCK_ROWS = 1 << 16
#: Queries that meet a block at a time; the index is shuffled once for so many.
QUERY_ROWS = 2_048
#: With few blocks, queries are cut into more parts, of this many at least, for so many tasks.
FEWEST_QUERY_ROWS, TASKS = 96, 64
#: Doubles hold whole numbers exactly up to this one; beyond it a component is refused.
LARGEST = 1 << 53

# --- bitmap arithmetic ------------------------------------------------------------


def slices_of(values: np.ndarray, bits: int) -> np.ndarray:
    """(rows, dimensions) of numbers from 0 -> (dimensions, bits, rows / 64) bitmaps."""
    n, d = values.shape
    out = np.zeros((d, bits, -(-n // 64)), np.uint64)
    padded = np.zeros((d, out.shape[2] * 64), np.uint8)
    for b in range(bits):
        padded[:, :n] = (values >> b & 1).T
        out[:, b] = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
    return out


def added(columns: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Bitmaps by their weight -> the sum's bitmap of each weight, from 0."""
    out = []
    weight, last = 0, max(columns, default=-1)
    while weight <= last:
        parts = columns.pop(weight, [])
        if not parts:
            out.append(None)
            weight += 1
            continue
        column, carries = np.concatenate(parts), []
        while len(column) > 1:
            third = len(column) // 3
            if third:
                a, b, c, rest = column[:third], column[third : 2 * third], column[2 * third : 3 * third], column[3 * third :]
                x = a ^ b
                carries.append((a & b) | (x & c))
                column = np.concatenate([x ^ c, rest]) if len(rest) else x ^ c
            else:
                carries.append(column[:1] & column[1:])
                column = column[:1] ^ column[1:]
        out.append(column[0])
        if carries:
            columns.setdefault(weight + 1, []).extend(carries)
            last = max(last, weight + 1)
        weight += 1
    return out


def scores(slices: np.ndarray, query: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Bitmaps of each row's score, and what has to be added to get the inner product.

    A negative component takes the complement of its slices, so all sums are from 0 on.
    """
    d, bits, words = slices.shape
    query = query[:d].astype(np.int64)
    size, negative = np.abs(query), query < 0
    flip = np.where(negative, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    columns: dict[int, list[np.ndarray]] = {}
    for j in range(int(size.max(initial=0)).bit_length()):
        chosen = np.nonzero(size >> j & 1)[0]
        if not len(chosen):
            continue
        part = slices[chosen] ^ flip[chosen][:, None, None]
        for b in range(bits):
            columns.setdefault(j + b, []).append(part[:, b])
    return added(columns), -int(size[negative].sum()) * ((1 << bits) - 1)


def _ones(n: int) -> np.ndarray:
    out = np.full(-(-n // 64), 0xFFFFFFFFFFFFFFFF, np.uint64)
    if n % 64:
        out[-1] = (1 << n % 64) - 1
    return out


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.nonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))[0]


def best(sums: list[np.ndarray], candidates: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
    """The ``k`` rows with the highest sums and their sums; of equal ones, the first rows."""
    sure, equal = np.zeros_like(candidates), candidates
    for bitmap in reversed(sums):
        high = equal & bitmap if bitmap is not None else np.zeros_like(equal)
        there = int(np.bitwise_count(sure | high).sum())
        if there > k:
            equal = high
        else:
            sure, equal = sure | high, equal & ~high
            if there == k:
                break
    rows = _rows(sure)
    if len(rows) < k:  # the boundary
        rows = np.concatenate([rows, _rows(equal)[: k - len(rows)]])
    word, bit = rows // 64, (rows % 64).astype(np.uint64)
    values = [0] * len(rows)
    for weight, bitmap in enumerate(sums):
        if bitmap is not None:
            for i, on in enumerate((bitmap[word] >> bit & np.uint64(1)).tolist()):
                values[i] += on << weight
    return rows, values


# --- Spark ------------------------------------------------------------------------


def quantised(vector: Column) -> Column:
    """floor(256 * x) of each component; null for vectors that hold null or no finite number.

    A vector with a component of 2 ** 45 or more fails the job, as its scores may leave 64 bits.
    """

    def whole_number(x: Column) -> Column:
        scaled = x.cast("double") * SCALE
        return F.when(F.abs(scaled) < LARGEST, F.floor(scaled)).otherwise(F.raise_error(F.lit("a component is too large")).cast("long"))

    whole = F.transform(vector, whole_number)
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return F.when(usable, whole)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of numbers as rows; shorter ones are filled up with 0."""
    lists = column.combine_chunks()
    sizes = np.asarray(lists.value_lengths())
    flat = lists.flatten().to_numpy()
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def own_row(slices: np.ndarray, low: int, rows: np.ndarray, query: np.ndarray) -> int | None:
    """The first of ``rows`` whose vector is the query's; missing components are 0."""
    dimensions, bits, _ = slices.shape
    if query[dimensions:].any():
        return None
    wanted = np.zeros(dimensions, np.int64)
    wanted[: len(query)] = query[:dimensions]
    for row in rows.tolist():
        on = slices[:, :, row // 64] >> np.uint64(row % 64) & np.uint64(1)
        if (low + (on.astype(np.int64) << np.arange(bits)).sum(axis=1) == wanted).all():
            return row
    return None


def index(vectors: DataFrame, blocks: int) -> DataFrame:
    """``id`` and ``whole`` numbers -> one row of bitmaps for each block of rows."""

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        values = _matrix(rows.column("whole"))
        low = int(values.min(initial=0))
        bits = max(1, int(values.max(initial=0) - low).bit_length())
        slices = slices_of(values - low, bits)
        ids = rows.column("id").to_numpy()
        return pa.table(
            {
                "block": [rows.column("block")[0].as_py()], "low": pa.array([low], pa.int64()),
                "dimensions": pa.array([values.shape[1]], pa.int32()), "bits": pa.array([bits], pa.int32()),
                "ids": pa.array([ids.tobytes()], pa.binary()), "slices": pa.array([slices.tobytes()], pa.binary()),
            }
        )

    return (
        vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
        .groupBy("block")
        .applyInArrow(build, "block long, low long, dimensions int, bits int, ids binary, slices binary")
    )


def top(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` candidates of highest inner product for each query, ties to the smaller id.

    Both have ``id`` and ``whole`` (see :func:`quantised`). Rows with null in either
    take no part. A query's own row is no candidate: of the candidates with its id and
    vector, one is left out. Repeated rows are queries and candidates of their own, and
    each repeated query has an answer of its own. A missing component counts as 0. With fewer candidates all are returned, with none or an
    empty table no row. Other columns are not read.
    """
    vectors = vectors.select("id", F.col("whole").cast("array<long>").alias("whole")).where("id is not null and whole is not null")
    blocks = max(1, -(-vectors.count() // BLOCK_ROWS))
    built = stage(index(vectors, blocks), "slices")
    # Numbered in a stored table: ids may repeat.
    numbered = queries.select("id", F.col("whole").cast("array<long>").alias("whole"), F.monotonically_increasing_id().alias("query"))
    asked = stage(numbered.where("id is not null and whole is not null"), "queries")
    number = asked.count()
    parts = max(1, -(-number // QUERY_ROWS), min(-(-number // FEWEST_QUERY_ROWS), -(-TASKS // blocks)))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)))
    # Each block of the index meets each part of the queries.
    asked = asked.withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    met = built.withColumn("part", F.explode(F.expr(f"sequence(0L, {parts - 1}L)")))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if left.num_rows and right.num_rows:
            row = {name: left.column(name)[0].as_py() for name in left.column_names}
            ids = np.frombuffer(row["ids"], np.int64)
            slices = np.frombuffer(row["slices"], np.uint64).reshape(row["dimensions"], row["bits"], -1)
            everyone = _ones(len(ids))
            asked = zip(right.column("query").to_pylist(), right.column("id").to_pylist(), _matrix(right.column("whole")), strict=True)
            for number, one, query in asked:
                sums, shift = scores(slices, query)
                candidates = everyone
                own = own_row(slices, row["low"], np.arange(np.searchsorted(ids, one), np.searchsorted(ids, one, "right")), query)
                if own is not None:
                    candidates = everyone.copy()
                    candidates[own // 64] &= ~(np.uint64(1) << np.uint64(own % 64))
                shift += row["low"] * int(query[: row["dimensions"]].sum())
                rows, values = best(sums, candidates, k)
                out += [(number, one, int(ids[r]), v + shift) for r, v in zip(rows.tolist(), values, strict=True)]
        names = ("query", "query_id", "vec_id", "score")
        return pa.table({name: pa.array([x[i] for x in out], pa.int64()) for i, name in enumerate(names)})

    found = (
        met.groupBy("block", "part")
        .cogroup(asked.groupBy("block", "part"))
        .applyInArrow(search, "query long, query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
