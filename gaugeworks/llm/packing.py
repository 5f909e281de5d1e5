"""Best-fit packing into bins of several permitted lengths (operator 6).

Documents longer than the longest permitted length are cut into full bins and a
rest; pieces are numbered and dealt to shards by a hash of the number, and each
shard is packed by itself: best fit over pieces in falling order of length. Where no open bin has room, the size
to open is the one with the least expected cost per word: its cost over what it
will hold, which is the piece plus as much of the free room as the pieces still
to come can fill, less half the smallest of them. While much is to come the cheapest size per word wins, near
the end a size that fits. At last each bin is downsized to the shortest length
that holds its contents.

A shard holds about ``SHARD_PIECES`` pieces, so bins left half empty at the end
of a shard are few against those it fills, and no task holds more than a shard.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import word_count
from gaugeworks.session import stage

LENGTHS = (512, 1024, 2048, 4096)
#: Cost of a bin: a fixed part, in words, and one for each word of its length.
FIXED_COST = 16
SHARD_PIECES = 2_000


def cost(length: int) -> int:
    return FIXED_COST + length


def pack(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS) -> tuple[np.ndarray, list[int]]:
    """Bin of each piece, and each bin's final length. Pieces in falling order of size."""
    lengths = tuple(sorted(lengths))
    bins = np.zeros(len(sizes), np.int64)
    opened: list[int] = []
    room: dict[int, list[int]] = {}  # free words -> open bins with that much
    free: list[int] = []  # the keys of room, sorted
    left = int(sizes.sum())
    smallest = int(sizes[-1]) if len(sizes) else 0

    def held(free_room: int) -> float:
        """What pieces still to come are expected to put there."""
        return min(max(free_room - smallest / 2, 0) if free_room >= smallest else 0, left)

    for n, size in enumerate(sizes.tolist()):
        left -= size
        k = bisect_left(free, size)
        if k < len(free):
            at = free[k]
            chosen = room[at].pop()
            if not room[at]:
                del room[at], free[k]
            rest = at - size
        else:
            fits = [x for x in lengths if x >= size]
            length = min(fits, key=lambda x: (cost(x) / max(size + held(x - size), 1), x))
            chosen = len(opened)
            opened.append(length)
            rest = length - size
        if rest:
            if rest not in room:
                insort(free, rest)
                room[rest] = []
            room[rest].append(chosen)
        bins[n] = chosen
    fill = np.bincount(bins, sizes, len(opened)).astype(int) if opened else []
    return bins, [next(x for x in lengths if x >= f) for f in fill]


def packed(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """One row for each piece of each document, with its bin.

    ``doc_id``, ``piece`` (from 0), ``start`` and ``words`` of the piece in the
    document, ``shard``, ``bin``, ``position`` in the bin, ``capacity`` and ``fill``
    of the bin. Null and empty texts, and those without words, make one piece of no
    words, which fits any bin. Repeated rows are packed one by one and spread over
    shards, a null ``doc_id`` stays null, and an empty table gives no rows. Other
    columns are not read.
    """
    longest = max(lengths)
    pieces = (
        docs.select(F.col("doc_id").cast("long"), word_count(F.col("text")).alias("size"))
        .withColumn("piece", F.explode(F.expr(f"sequence(0L, greatest(size - 1, 0L) div {longest})")))
        .withColumn("start", F.col("piece") * longest)
        .withColumn("words", F.least(F.lit(longest), F.col("size") - F.col("start")))
        .select("doc_id", "piece", "start", "words", F.monotonically_increasing_id().alias("number"))
    )
    # Texts are read once; the number spreads equal rows over shards.
    pieces = stage(pieces, "pieces")
    shards = max(1, -(-pieces.count() // SHARD_PIECES))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards))).drop("number")

    def fill(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("words", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        words = shard.column("words").to_numpy()
        bins, capacity = pack(words, lengths)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(words[order])
        fill = np.bincount(bins, words, len(capacity)).astype(np.int64)
        position = np.zeros(len(words), np.int64)
        position[order] = ends - words[order] - (np.cumsum(fill) - fill)[bins[order]]
        for name, values in (
            ("bin", bins), ("position", position), ("capacity", np.array(capacity, np.int64)[bins]), ("fill", fill[bins])
        ):
            shard = shard.append_column(name, pa.array(values, pa.int64()))
        return shard

    schema = "doc_id long, piece long, start long, words long, shard long, bin long, position long, capacity long, fill long"
    return pieces.groupBy("shard").applyInArrow(fill, schema)
