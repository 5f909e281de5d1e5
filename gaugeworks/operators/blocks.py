"""Keyed upsert into blocks that split as they grow (SNK-5, JOIN-1).

A block is a box of the key space: a range of entry ids and, for a range that is down
to one id, a prefix of the device's hash. A stored directory lists all blocks; it is
the only thing a run reads of blocks it does not touch. A block whose rows outgrow the
limit is cut at quantiles of its ids, or, once ids cannot tell its rows apart, by more
bits of the hash, so neither a first batch of one device nor a sudden mass of devices
fixes anything for later.

The rows of a block lie in a few segments, each written by one run. Beside each
segment lies a Bloom filter of its keys. A batch is appended to a block as a new segment;
of the old ones only those that hold a key of the batch are rewritten. Filters name the
segments that may, and the key columns of these alone are read to be sure.

Runs write into folders of their own, which nobody reads until the next version
of the directory is complete; replaced segments go afterwards. A lost driver or executor
leaves the last complete version in force, and :func:`vacuum` drops what is unused. One
writer at a time.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks import settings
from gaugeworks.operators.joins import merge_rows
from gaugeworks.operators.layout import rank_in
from gaugeworks.session import delete_path, list_folders, path_exists, stage, staged

LEAF, SEGMENT = "_leaf", "_segment"
DIRECTORY, FILTERS = "_directory", "_filters"
#: Ids start above this; null ids lie in a range of their own.
LOWEST = -(2**63)
HIGHEST = 2**63
#: Bits of a device's hash, and how many of them a block's prefix may have: a range's table of prefixes has
#: ``2 ** MAX_DEPTH`` entries at most.
HASH_BITS, MAX_DEPTH = 30, 16
#: More segments than this in a block are made one, large ones excepted.
MAX_SEGMENTS = 8
#: Quantiles that one pass of a split takes, and bits of the hash it adds at most.
QUANTILES, SPLIT_BITS = 64, 6
#: Bits of a filter for each key, bits a key sets, and bits of one bitmap (fixed by Spark).
KEY_BITS, KEY_PLACES, BITMAP = 16, 3, 32_768
#: Keys that look into one copy of a bitmap, about; more keys get more copies.
PROBES = 100_000


# --- the directory --------------------------------------------------------------------


@dataclass(frozen=True)
class Segment:
    """Rows that one run wrote for one block: ``<path>/<run>/_segment=<number>``."""

    run: str
    number: int
    rows: int
    buckets: int

    @property
    def name(self) -> str:
        return f"{self.run}/{SEGMENT}={self.number}"


@dataclass(frozen=True)
class Leaf:
    """Ids from ``low`` up to the next leaf's, device hashes that begin with ``prefix`` of ``depth`` bits."""

    low: int
    depth: int = 0
    prefix: int = 0
    segments: tuple[Segment, ...] = ()

    @property
    def rows(self) -> int:
        return sum(segment.rows for segment in self.segments)


_ROW = "low bigint, depth int, prefix int, run string, number int, rows bigint, buckets int"


@dataclass
class Directory:
    """All blocks, sorted; one entry for each, whatever its size."""

    version: int = 0
    leaves: list[Leaf] = field(default_factory=lambda: [Leaf(LOWEST), Leaf(LOWEST + 1)])

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Directory:
        """The newest complete version; the empty directory for a table that does not exist."""
        root = f"{path.rstrip('/')}/{DIRECTORY}"
        versions = sorted((int(name) for name in list_folders(spark, root)), reverse=True)
        for version in versions:
            if path_exists(spark, f"{root}/{version}/_SUCCESS"):
                found: dict[tuple, list[Segment]] = defaultdict(list)
                for row in spark.read.schema(_ROW).json(f"{root}/{version}").collect():
                    segments = found[row["low"], row["depth"], row["prefix"]]
                    if row["run"] is not None:
                        segments.append(Segment(row["run"], row["number"], row["rows"], row["buckets"]))
                leaves = [Leaf(*box, tuple(sorted(held, key=lambda s: s.name))) for box, held in found.items()]
                return cls(version, sorted(leaves, key=_order))
        return cls()

    def store(self, spark: SparkSession, path: str) -> None:
        """Write this version; it counts once its ``_SUCCESS`` file is there."""
        rows = [
            (leaf.low, leaf.depth, leaf.prefix, *((s.run, s.number, s.rows, s.buckets) if s else (None,) * 4))
            for leaf in self.leaves
            for s in (leaf.segments or (None,))
        ]
        frame = spark.createDataFrame(rows, _ROW).coalesce(1)
        frame.write.mode("overwrite").json(f"{path.rstrip('/')}/{DIRECTORY}/{self.version}")

    def segments(self) -> list[Segment]:
        return [segment for leaf in self.leaves for segment in leaf.segments]

    def ends(self) -> dict[int, int]:
        """The id at which each range of ids ends."""
        lows = sorted({leaf.low for leaf in self.leaves})
        return dict(zip(lows, [*lows[1:], HIGHEST]))

    def leaf_number(self) -> Column:
        """The place in ``leaves`` of the block that a row's key lies in.

        The range by binary search, then a table of hash prefixes as long as the range's deepest block
        asks for. Both are arrays with an entry for each block.
        """
        lows = sorted({leaf.low for leaf in self.leaves})
        by_low: dict[int, list[int]] = defaultdict(list)
        for number, leaf in enumerate(self.leaves):
            by_low[leaf.low].append(number)
        depths, firsts, places = [], [], []
        for low in lows:
            depth = max(self.leaves[number].depth for number in by_low[low])
            table = [0] * (1 << depth)
            for number in by_low[low]:
                leaf = self.leaves[number]
                span = 1 << (depth - leaf.depth)
                table[leaf.prefix * span : (leaf.prefix + 1) * span] = [number] * span
            depths.append(depth)
            firsts.append(len(places))
            places += table
        at = rank_in(id_key(), _numbers(lows[1:]), max(len(lows).bit_length(), 1))
        depth = F.get(_numbers(depths), at).cast("int")
        slot = F.expr("0L") if not any(depths) else F.call_function("shiftright", hash_key(), F.lit(HASH_BITS) - depth)
        return F.get(_numbers(places), (F.get(_numbers(firsts), at) + slot).cast("int")).cast("int")


def _order(leaf: Leaf) -> tuple:
    return leaf.low, leaf.prefix << (HASH_BITS - leaf.depth)


def _numbers(values: list[int]) -> Column:
    """An array literal; the text is folded into one when the plan is optimised."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def id_key() -> Column:
    return F.coalesce(F.col("entry_id"), F.lit(LOWEST))


def hash_key() -> Column:
    """The first bits of this decide on the block."""
    return F.xxhash64("device_id").bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def routed(df: DataFrame, directory: Directory) -> DataFrame:
    return df.withColumn(LEAF, directory.leaf_number())


def _read(spark: SparkSession, path: str, segments: list[Segment]) -> DataFrame | None:
    """The rows of some segments; no other folder is listed."""
    if not segments:
        return None
    return spark.read.parquet(*[f"{path.rstrip('/')}/{segment.name}" for segment in segments])


def read_blocks(spark: SparkSession, path: str) -> DataFrame | None:
    """The whole table; None if there is none."""
    return _read(spark, path, Directory.load(spark, path).segments())


def has_directory(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/{DIRECTORY}")


# --- splitting ------------------------------------------------------------------------


def id_cuts(quantiles: list[int], first: int, last: int, pieces: int, low: int, end: int) -> list[int]:
    """Where to cut a range of ids, which go from ``first`` to ``last``, so that its pieces are of like size.

    An id that fills a piece by itself gets a range of its own, which can then be split by hash.
    Quantiles of ids beyond 2 ** 53 are not exact; where they give no cut, the range is halved.
    """
    times: dict[int, int] = defaultdict(int)
    values = [min(max(value, first), last) for value in quantiles]
    for value in values:
        times[value] += 1
    pieces = min(pieces, len(values))
    cuts = {values[len(values) * piece // pieces] for piece in range(1, pieces)}
    for value, n in times.items():
        if n >= max(2, len(values) // pieces):
            cuts |= {value, value + 1}
    within = sorted(cut for cut in cuts if low < cut < end)
    if not any(first < cut <= last for cut in within):
        # One side would be empty: single out the only id, or halve.
        halves = {first, first + 1} if first == last else {first + (last - first + 1) // 2}
        within = sorted(cut for cut in halves if low < cut < end)
    return within


def split_outgrown(keys: DataFrame, directory: Directory, limit: int, sizes: dict[int, int]) -> Directory:
    """The directory with the blocks in ``sizes`` (leaf number -> rows) cut until they keep to the limit.

    ``keys`` has the keys of these blocks' rows and of the batch. Each pass sends a few dozen quantiles
    for each block to cut to the driver. A block whose rows neither ids nor hashes tell apart stays whole.
    """
    parts = {directory.leaves[number]: rows for number, rows in sizes.items()}
    untouched = [leaf for leaf in directory.leaves if leaf not in parts]
    fractions = F.array(*[F.lit((i + 0.5) / QUANTILES) for i in range(QUANTILES)])
    stuck: set[Leaf] = set()
    while over := {leaf: rows for leaf, rows in parts.items() if rows > limit and leaf not in stuck}:
        current = Directory(0, sorted([*untouched, *parts], key=_order))
        ends, number = current.ends(), {leaf: at for at, leaf in enumerate(current.leaves)}
        found = routed(keys, current).filter(F.col(LEAF).isin([number[leaf] for leaf in over])).groupBy(LEAF).agg(
            F.percentile_approx(id_key(), fractions, 10_000).alias("ids"),
            F.min(id_key()).alias("first"),
            F.max(id_key()).alias("last"),
            (F.min(hash_key()) == F.max(hash_key())).alias("one_hash"),
        )
        seen = {row[LEAF]: row for row in found.collect()}
        for leaf, rows in over.items():
            pieces, more, row = max(-(-rows // limit), 2), [], seen[number[leaf]]
            if leaf.depth == 0 and ends[leaf.low] > leaf.low + 1:
                cuts = id_cuts(list(row["ids"]), row["first"], row["last"], pieces, leaf.low, ends[leaf.low])
                more = [Leaf(low) for low in [leaf.low, *cuts]] if cuts else []
            elif leaf.depth < MAX_DEPTH and not row["one_hash"]:
                bits = min(math.ceil(math.log2(pieces)), SPLIT_BITS, MAX_DEPTH - leaf.depth)
                more = [Leaf(leaf.low, leaf.depth + bits, (leaf.prefix << bits) + i) for i in range(1 << bits)]
            if more:
                del parts[leaf]
                parts.update(dict.fromkeys(more, 0))
            else:
                stuck.add(leaf)
        current = Directory(0, sorted([*untouched, *parts], key=_order))
        new = [at for at, leaf in enumerate(current.leaves) if leaf in parts]
        counted = routed(keys, current).filter(F.col(LEAF).isin(new)).groupBy(LEAF).count().collect()
        parts = dict.fromkeys(parts, 0) | {current.leaves[row[LEAF]]: row["count"] for row in counted}
    return Directory(directory.version, sorted([*untouched, *parts], key=_order))


# --- filters --------------------------------------------------------------------------


def _key_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("device_id"), F.col("entry_id"))


def _bucket(buckets: Column) -> Column:
    """All bits of a key lie in one bitmap, so one row of the filter decides."""
    return F.pmod(_key_hash(1), buckets).cast("int")


def _places() -> list[Column]:
    bits = _key_hash(2)
    return [F.call_function("shiftright", bits, F.lit(15 * i)).bitwiseAND(F.lit(BITMAP - 1)) for i in range(KEY_PLACES)]


def write_filters(keys: DataFrame, counts: dict[int, int], path: str) -> dict[int, int]:
    """Bloom filters of a run's segments, sorted by segment; returns their numbers of bitmaps.

    ``keys`` has the keys and the number of the segment of every row.
    """
    buckets = {number: max(1, -(-rows * KEY_BITS // BITMAP)) for number, rows in counts.items()}
    sizes = keys.sparkSession.createDataFrame(list(buckets.items()), f"{SEGMENT} int, _buckets int")
    placed = keys.join(F.broadcast(sizes), SEGMENT).select(
        SEGMENT, _bucket(F.col("_buckets")).alias("bucket"), F.explode(F.array(*_places())).alias("place")
    )
    maps = placed.groupBy(SEGMENT, "bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
    maps.hint("rebalance").sortWithinPartitions(SEGMENT, "bucket").write.parquet(path)
    return buckets


def _bit(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bitmap, (F.call_function("shiftright", place, F.lit(3)) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.call_function("shiftright", byte.cast("int"), place.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1


def possible_segments(
    rows: DataFrame, held: dict[int, list[Segment]], path: str, null_safe: bool, incoming: dict[int, int] | None = None
) -> list[Segment]:
    """Segments whose filter passes a key of ``rows``, which carry their leaf; ``held`` are the candidates by leaf,
    ``incoming`` the rows of each. A small segment that many rows look into has copies of its filter, so no task gets them all."""
    spark = rows.sparkSession
    names = {segment.name: segment for segments in held.values() for segment in segments}
    if not names:
        return []
    listed = [
        (leaf, s.run, s.number, s.buckets, -(-(incoming or {}).get(leaf, 1) // (s.buckets * PROBES)))
        for leaf, segments in held.items()
        for s in segments
    ]
    where = spark.createDataFrame(listed, f"{LEAF} int, _run string, {SEGMENT} int, _buckets int, _copies int")
    keys = rows.select(LEAF, *settings.KEYS) if null_safe else rows.select(LEAF, *settings.KEYS).filter(_complete())
    probes = keys.join(F.broadcast(where), LEAF).select(
        "_run", SEGMENT, _bucket(F.col("_buckets")).alias("bucket"), F.pmod(_key_hash(3), "_copies").cast("int").alias("_copy"),
        *[place.alias(f"_p{i}") for i, place in enumerate(_places())],
    )
    root = f"{path.rstrip('/')}/{FILTERS}"
    # A run's filters lie in one folder; of its files the row groups of other segments are skipped.
    maps = spark.read.parquet(*sorted({f"{root}/{segment.run}" for segment in names.values()}))
    numbers = sorted({segment.number for segment in names.values()})
    maps = maps.filter(F.col(SEGMENT).between(numbers[0], numbers[-1])).select(
        F.regexp_extract("_metadata.file_path", rf"{FILTERS}/([^/]+)/[^/]+$", 1).alias("_run"), SEGMENT, "bucket", "bits"
    )
    copied = where.select("_run", SEGMENT, F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy"))
    maps = maps.join(F.broadcast(copied), ["_run", SEGMENT])  # a row for each segment, and for each copy
    passed = probes.join(maps, ["_run", SEGMENT, "bucket", "_copy"])
    for i in range(KEY_PLACES):
        passed = passed.filter(_bit(F.col("bits"), F.col(f"_p{i}")))
    found = passed.select("_run", SEGMENT).distinct().collect()
    return [names[f"{row['_run']}/{SEGMENT}={row[SEGMENT]}"] for row in found]


def segment_name(file: Column) -> Column:
    """``<run>/_segment=<number>`` of a segment's file. It is taken for every stored row: a regular expression would search
    the whole path, in time that grows with the square of its folders' names."""
    return F.substring_index(F.substring_index(file, "/", -3), "/", 2)


def hit_segments(rows: DataFrame, possible: list[Segment], path: str, null_safe: bool) -> set[str]:
    """The segments that do hold a key of ``rows``; of the others only the key columns are read."""
    stored = _read(rows.sparkSession, path, possible)
    if stored is None:
        return set()
    found = _matched(stored.select(*settings.KEYS, segment_name(F.col("_metadata.file_path")).alias("_name")), rows, null_safe)
    return {row[0] for row in found.select("_name").distinct().collect()}


def _complete() -> Column:
    return F.col("device_id").isNotNull() & F.col("entry_id").isNotNull()


def _matched(stored: DataFrame, rows: DataFrame, null_safe: bool) -> DataFrame:
    """The stored rows whose key is in the batch."""
    keys = rows.select(*settings.KEYS)
    if not null_safe:
        return stored.filter(_complete()).join(keys.filter(_complete()), list(settings.KEYS), "left_semi")
    same = [F.col(f"s.{key}").eqNullSafe(F.col(f"b.{key}")) for key in settings.KEYS]
    return stored.alias("s").join(keys.alias("b"), same, "left_semi")


# --- upsert ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Upserted:
    """What a run did: blocks of the batch, segments written anew, segments left as they were, blocks cut."""

    touched: int
    rewritten: int
    kept: int
    split: int
    blocks: int
    dates: DataFrame | None = None


def upsert_blocks(
    batch: DataFrame,
    path: str,
    limit: int = settings.KEY_BLOCK_ROWS,
    null_safe: bool = False,
    track_dates: bool = False,
    on_dates: Callable[[DataFrame], None] | None = None,
) -> Upserted:
    """Insert or replace the rows of ``batch``, which holds each key once; blocks keep to ``limit`` rows.

    A key with a null never matches, and its rows are appended; ``null_safe=True`` treats nulls as
    equal. ``track_dates`` and ``on_dates`` are as in :func:`gaugeworks.operators.upsert.upsert`.
    The driver receives one count for each block that the batch touches.
    """
    spark = batch.sparkSession
    path = path.rstrip("/")
    directory = Directory.load(spark, path)
    with staged(batch, "blocks-batch") as rows:
        homed = routed(rows, directory)
        incoming = {row[LEAF]: row["count"] for row in homed.groupBy(LEAF).count().collect()}
        grown = {number: directory.leaves[number].rows + n for number, n in incoming.items()}
        outgrown = {number: n for number, n in grown.items() if n > limit}
        held = {number: list(directory.leaves[number].segments) for number in incoming}
        checked = {number: segments for number, segments in held.items() if segments}
        possible = possible_segments(homed, checked, path, null_safe, incoming)
        hit = hit_segments(rows, possible, path, null_safe)
        gone = []
        for number, segments in held.items():
            small = [s for s in segments if s.rows <= limit // 2] if len(segments) >= MAX_SEGMENTS else []
            gone += [s for s in segments if number in outgrown or s.name in hit or s in small]
        target = _read(spark, path, gone)
        dates = _changed_dates(rows, _read(spark, path, [s for s in gone if s.name in hit]), null_safe) if track_dates or on_dates else None
        if on_dates is not None:
            on_dates(dates)
        # What stays in its segment keeps its leaf; blocks to cut give up all of theirs.
        dropped = {segment.name for segment in gone}
        leaves = [replace(leaf, segments=tuple(s for s in leaf.segments if s.name not in dropped)) for leaf in directory.leaves]
        after = Directory(directory.version + 1, leaves)
        if outgrown:
            keys = rows.select(*settings.KEYS)
            moving = _read(spark, path, [s for number in outgrown for s in held[number]])
            if moving is not None:
                keys = keys.unionAll(moving.select(*settings.KEYS))
            after = split_outgrown(keys, after, limit, outgrown)
            after.version = directory.version + 1
        merged = rows if target is None else merge_rows(target, rows, null_safe=null_safe)
        _write(merged, after, path)
    after.store(spark, path)
    runs = {segment.run for segment in after.segments()}
    for folder in {s.name if s.run in runs else s.run for s in gone}:
        delete_path(spark, f"{path}/{folder}")
        delete_path(spark, f"{path}/{FILTERS}/{folder}")
    delete_path(spark, f"{path}/{DIRECTORY}/{directory.version - 1}")
    return Upserted(
        len(incoming), len(gone), len(directory.segments()) - len(gone), len(outgrown), len(after.leaves), dates
    )


def _write(merged: DataFrame, after: Directory, path: str) -> None:
    """Write new segments and their filters, and enter them into ``after``."""
    spark = merged.sparkSession
    run = f"run-{after.version}-{uuid.uuid4().hex[:12]}"
    (
        routed(merged, after)
        .withColumnRenamed(LEAF, SEGMENT)
        .hint("rebalance", SEGMENT)
        .sortWithinPartitions(SEGMENT, *settings.KEYS)
        .write.partitionBy(SEGMENT)
        .parquet(f"{path}/{run}")
    )
    if not list_folders(spark, f"{path}/{run}"):
        return
    keys = spark.read.parquet(f"{path}/{run}").select(*settings.KEYS, SEGMENT)
    counts = {row[SEGMENT]: row["count"] for row in keys.groupBy(SEGMENT).count().collect()}
    buckets = write_filters(keys, counts, f"{path}/{FILTERS}/{run}")
    for number, rows in counts.items():
        leaf = after.leaves[number]
        after.leaves[number] = replace(leaf, segments=(*leaf.segments, Segment(run, number, rows, buckets[number])))


def _changed_dates(rows: DataFrame, hit: DataFrame | None, null_safe: bool) -> DataFrame:
    times = rows.select("recorded_at")
    if hit is not None:
        times = times.unionByName(_matched(hit, rows, null_safe).select("recorded_at"))
    # Staged, because the replaced rows are gone after the write.
    return stage(times.select(F.to_date("recorded_at").alias("date")).distinct(), "changed-dates")


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Drop segments that no complete directory lists: what cut runs left behind. Not while a writer runs."""
    path = path.rstrip("/")
    used = {segment.name for segment in Directory.load(spark, path).segments()}
    dropped = []
    for run in list_folders(spark, path):
        if run.startswith("run-"):
            names = [f"{run}/{folder}" for folder in list_folders(spark, f"{path}/{run}")]
            stale = [name for name in names if name not in used]
            dropped += stale
            for gone in [run] if len(stale) == len(names) else stale:
                delete_path(spark, f"{path}/{gone}")
                delete_path(spark, f"{path}/{FILTERS}/{gone}")
    return dropped
