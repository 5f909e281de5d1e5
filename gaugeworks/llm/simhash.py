"""SimHash near-duplicates by bit-sliced comparison (operator 7).

Each text gets a fingerprint: bit i is set if it is set in over half of the
hashes of the text's word shingles. Equal fingerprints are folded into one node
first, so exact copies cost one aggregation, however many there are.

Candidates come from block keys. The bits are cut into ``blocks`` pieces, and two
fingerprints meet where they agree on two whole pieces. When no more than
``blocks - 2`` bits may differ, some two pieces must agree, and the search is exact.

Within a bucket, fingerprints are stored vertically: one bit plane holds a bit
of 64 candidates per machine word. Planes that differ from a query are added up
by carry-save counters, many distances at once, and a block is abandoned when
all of its counters have passed the radius. A bucket beyond ``BUCKET_ROWS`` is
cut into parts, and each pair of parts is a task's work of its own; what a
bucket returns is a spanning forest, never all of its pairs.
"""

from __future__ import annotations

from contextlib import ExitStack
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import columns, texts
from gaugeworks.llm.components import components
from gaugeworks.session import stage, staged

#: Rows of a bucket that one comparison takes; larger buckets are cut into parts.
BUCKET_ROWS = 4096
#: Up to this many rows, the pairs of a bucket are the lanes; beyond it, its rows are.
FEW = 24
#: Words of 64 lanes that a comparison works on at a time.
LANE_WORDS = 1 << 14
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints -----------------------------------------------------------------


def fingerprint(text: bytes, shingle: int, seeds: tuple[int, ...]) -> list[int]:
    """One signed 64-bit word for each seed; zero without words."""
    words = text.lower().split()  # lower() of bytes changes A-Z only
    if not words:
        return [0] * len(seeds)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(words) - shingle + 1)
    spans = list(zip(starts[:count].tolist(), ends[-count:].tolist(), strict=True))
    out = []
    for seed in seeds:
        votes = np.zeros(64, np.int64)
        for at in range(0, count, 1 << 16):
            part = spans[at : at + (1 << 16)]
            hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in part], np.uint64)
            votes += np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
        out.append(int.from_bytes(np.packbits(2 * votes > count).tobytes(), "big", signed=True))
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, seeds: tuple[int, ...] = (42,)) -> DataFrame:
    """``doc_id`` and ``print``, an array with a long for each seed. One pass, no shuffle."""

    def compute(batches):
        for ids, values in columns(batches):
            prints = [fingerprint(x, shingle, seeds) for x in values]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(prints, pa.list_(pa.int64()))], ["doc_id", "print"]
            )

    rows = texts(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(compute, "doc_id long, print array<long>")


# --- bit-sliced comparison --------------------------------------------------------


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """(n, words) -> (64 * words, n / 64 rounded up): plane p holds bit p of all n."""
    n = len(prints)
    bits = np.unpackbits(prints.astype(">u8").view(np.uint8).reshape(n, -1), axis=1)
    padded = np.zeros((bits.shape[1], -(-n // 64) * 64), np.uint8)
    padded[:, :n] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def lanes_of(mask: np.ndarray, n: int) -> np.ndarray:
    """Bits of packed lanes as booleans, along the last axis."""
    return np.unpackbits(mask.view(np.uint8), axis=-1, bitorder="little")[..., :n].astype(bool)


def _full(a, b, c):
    """Carry-save adder: sum and carry of three planes."""
    x = a ^ b
    return x ^ c, (a & b) | (x & c)


def _beyond(counters: list, radius: int, over):
    """Lanes whose count is above ``radius``."""
    above, equal = over, ~over
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal = equal & counters[k]
        else:
            above = above | (equal & counters[k])
            equal = equal & ~counters[k]
    return above


def within(differing, planes: int, radius: int, out: np.ndarray) -> np.ndarray | None:
    """Lanes with at most ``radius`` set bits over all planes; None if there are none.

    ``differing(p)`` gives plane p, ``out`` marks lanes that don't count.
    """
    size = max(3, radius.bit_length())
    zero = np.zeros_like(out)
    counters, over = [zero] * size, out
    for at in range(0, planes, 8):
        d = [differing(p) for p in range(at, at + 8)]
        ones, two_a = _full(counters[0], d[0], d[1])
        ones, two_b = _full(ones, d[2], d[3])
        twos, four_a = _full(counters[1], two_a, two_b)
        ones, two_a = _full(ones, d[4], d[5])
        ones, two_b = _full(ones, d[6], d[7])
        twos, four_b = _full(twos, two_a, two_b)
        fours, carry = _full(counters[2], four_a, four_b)
        counters = [ones, twos, fours, *counters[3:]]
        for k in range(3, size):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over = over | carry
        dead = _beyond(counters, radius, over)
        if (dead == ALL).all():
            return None  # the block is abandoned
    return ~dead


def _tail(n: int, shape: tuple) -> np.ndarray:
    """Marks the lanes behind the last of n."""
    out = np.zeros(shape, np.uint64)
    if n % 64:
        out[..., -1] = ALL << np.uint64(n % 64)
    return out


def near_pairs(prints: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Which of the pairs (left[i], right[i]) differ in at most ``radius`` bits; pairs are the lanes."""
    found = np.zeros(len(left), bool)
    for at in range(0, len(left), 64 * 128):
        i, j = left[at : at + 64 * 128], right[at : at + 64 * 128]
        planes = bit_planes(prints[i] ^ prints[j])
        near = within(lambda p, planes=planes: planes[p], len(planes), radius, _tail(len(i), planes[0].shape))
        if near is not None:
            found[at : at + len(i)] = lanes_of(near, len(i))
    return found


def near_rows(queries: np.ndarray, prints: np.ndarray, radius: int):
    """Yields (query, rows within the radius), for queries that have any; rows are the lanes."""
    planes = bit_planes(prints)
    width = planes.shape[1]
    step = max(1, LANE_WORDS // width)
    for at in range(0, len(queries), step):
        part = queries[at : at + step]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(len(part), -1), axis=1)
        flip = (np.uint64(0) - bits.astype(np.uint64)).T[:, :, None]
        near = within(
            lambda p, flip=flip: planes[p] ^ flip[p], len(planes), radius, _tail(len(prints), (len(part), width))
        )
        if near is None:
            continue
        for q in np.nonzero(near.any(axis=1))[0]:
            yield at + q, np.nonzero(lanes_of(near[q], len(prints)))[0]


class Forest:
    """Labels of the rows of one bucket; a link counts only if it joins two trees."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, one: int, others: np.ndarray) -> list[int]:
        labels, first = np.unique(self.label[others], return_index=True)
        new = labels != self.label[one]
        if not new.any():
            return []
        self.label[np.isin(self.label, labels[new])] = self.label[one]
        return others[first[new]].tolist()


def bucket_links(prints: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning links of one bucket; with rows on both sides, only those across."""
    forest, links = Forest(len(prints)), []
    if right.any():
        side = np.nonzero(right)[0]
        other = np.nonzero(~right)[0]
    else:
        side = other = np.arange(len(prints))
    for q, rows in near_rows(prints[other], prints[side], radius):
        one = int(other[q])
        links += [(one, x) for x in forest.join(one, side[rows])]
    return links


def few_links(prints: np.ndarray, starts: np.ndarray, sizes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within many small buckets that lie one after another."""
    left, right = [], []
    for size in np.unique(sizes):
        i, j = np.triu_indices(size, 1)
        at = starts[sizes == size][:, None]
        left.append((at + i).ravel())
        right.append((at + j).ravel())
    left, right = np.concatenate(left), np.concatenate(right)
    near = near_pairs(prints, left, right, radius)
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    links = []
    for a, b in zip(left[near].tolist(), right[near].tolist(), strict=True):
        x, y = top(a), top(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            links.append((a, b))
    return links


# --- candidates and groups --------------------------------------------------------


def block_keys(prints: Column, seeds: int, blocks: int) -> Column:
    """A key for each two pieces of each word: table number, then the bits of both."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    widest = max(b - a for a, b in zip(cuts, cuts[1:], strict=False))
    keys = []
    for word in range(seeds):
        value = prints[word]
        pieces = [F.shiftrightunsigned(value, a).bitwiseAND((1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
        for x, y in combinations(range(blocks), 2):
            number = F.lit(len(keys)).cast("long")
            keys.append(F.shiftleft(F.shiftleft(number, widest).bitwiseOR(pieces[x]), widest).bitwiseOR(pieces[y]))
    return F.array(*keys)


def links(nodes: DataFrame, seeds: int, blocks: int, radius: int) -> DataFrame:
    """``a`` and ``b``, ids of nodes whose prints are within the radius: a spanning forest of each bucket.

    ``nodes`` has ``id`` and ``print``, each print once.
    """
    keyed = nodes.select("id", *_words(seeds), F.explode(block_keys(F.col("print"), seeds, blocks)).alias("key"))
    # Few buckets are large, so this table is small, and Spark broadcasts it if it is.
    large = stage(
        keyed.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > BUCKET_ROWS), "large_buckets"
    )
    keyed = keyed.join(large.select("key", _parts()), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    return bucket_forests(keyed, seeds, radius)


def _words(seeds: int) -> list[Column]:
    return [F.col("print")[k].alias(f"print{k}") for k in range(seeds)]


def _parts() -> Column:
    return F.ceil(F.col("size") / BUCKET_ROWS).cast("int").alias("parts")


def key_links(nodes: DataFrame, seeds: int, radius: int) -> DataFrame:
    """Like :func:`links`, for nodes that meet where they share one of their ``keys``.

    Most keys are of one node. Keys and ids alone are shuffled to tell so; prints follow
    where nodes meet.
    """
    met = nodes.select("id", F.explode("keys").alias("key"))
    met = met.withColumn("size", F.count("*").over(Window.partitionBy("key"))).where("size > 1")
    keyed = met.select("id", "key", _parts()).join(nodes.select("id", *_words(seeds)), "id")
    return bucket_forests(keyed, seeds, radius)


def bucket_forests(keyed: DataFrame, seeds: int, radius: int) -> DataFrame:
    """Links of all buckets: ``keyed`` has a row for each node and ``key``, and ``parts`` that the bucket is cut into."""
    own = F.pmod(F.xxhash64("id"), "parts").cast("int")
    spread = (
        keyed.withColumn("own", own)
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .select(
            "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            F.expr("own > other").alias("right"), "id", *(f"print{k}" for k in range(seeds)),
        )
        # A part meets itself once.
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
    )

    def compare(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            names = [rows.column(c).to_numpy() for c in ("key", "low", "high")]
            change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1
            last = int(change[-1]) if len(change) else 0
            held = rows.slice(last).to_batches()[0]
            if last:
                yield work(rows.slice(0, last), np.concatenate(([0], change[:-1])), change)
        if held is not None and held.num_rows:
            yield work(pa.Table.from_batches([held]), np.array([0]), np.array([held.num_rows]))

    def work(rows, starts, ends):
        ids = rows.column("id").to_numpy()
        prints = np.stack([rows.column(f"print{k}").to_numpy() for k in range(seeds)], 1).view(np.uint64)
        right = rows.column("right").to_numpy()
        # The halves of a large bucket may be of one row each; only whole buckets are few.
        whole = rows.column("low").to_numpy()[starts] == rows.column("high").to_numpy()[starts]
        few = ((ends - starts) <= FEW) & whole
        some = few & (ends - starts > 1)
        found = few_links(prints, starts[some], (ends - starts)[some], radius) if some.any() else []
        for a, b in zip(starts[~few].tolist(), ends[~few].tolist(), strict=True):
            found += [(a + i, a + j) for i, j in bucket_links(prints[a:b], right[a:b], radius)]
        pair = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(ids[pair[:, 0]]), pa.array(ids[pair[:, 1]])], ["a", "b"])

    return spread.mapInArrow(compare, "a long, b long")


def groups(
    docs: DataFrame, shingle: int = 4, seeds: tuple[int, ...] = (42,), blocks: int = 6, radius: int = 4
) -> DataFrame:
    """``doc_id``, ``print`` and ``component_id``, the smallest id reachable over near prints.

    One row per row of ``docs``. Null and empty texts, and those without words,
    have print zero, which links like any other. Repeated rows share a node. Rows
    without ``doc_id`` get a print, take part in no link, and have a null
    ``component_id``. Only ``doc_id`` and ``text`` are read, so other columns may
    have any names. An empty table gives an empty result.
    """
    prints = stage(fingerprints(docs, shingle, seeds), "prints")
    nodes = stage(prints.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("id")), "nodes")
    found = components(links(nodes, len(seeds), blocks, radius))
    members = nodes.join(found, nodes["id"] == found["node"], "left").select(
        "print", F.coalesce("component", "id").alias("component_id")
    )
    return prints.join(members, "print", "left").select(
        "doc_id", "print", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


# --- near copies by the sets of their shingles ------------------------------------

#: The pipeline's stage: sets of five words in a row, of which similarity 0.8 or more links.
#: LIKE is that similarity as a fraction, so that the comparison is one of whole numbers.
SHINGLE, LIKE = 5, (4, 5)
#: Of the 128 bits of candidates, so many may differ. Sets of similarity 0.8 differ in 19 on
#: average, in 24 if they are of 4 and 5 shingles, unrelated ones in 64; the deviation is about 4.5.
CANDIDATE_RADIUS = 44
#: A shingle that this many of the sampled documents hold is taken late as a key.
SAMPLE_DOCS, FREQUENT = 4000, 8
#: Rows, shingles and bytes of text of a group of candidates that one comparison takes for either side.
PART_ROWS, PART_SHINGLES, PART_BYTES = 4096, 1 << 21, 1 << 24
#: Words of 64 bits that mark keys, so that most others need no join. Broadcast, 16 MB at most.
MARK_SLOTS = 1 << 20


def shingle_set(text: bytes) -> np.ndarray:
    """Hashes of the text's runs of ``SHINGLE`` words, each once and in order; shorter texts are one run."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(words) - SHINGLE + 1)
    spans = zip(starts[:count].tolist(), ends[-count:].tolist(), strict=True)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in spans), np.uint64, count))


def set_print(shingles: np.ndarray) -> list[int]:
    """128 bits of SimHash over the set, then a digest of the set, as signed words."""
    if not len(shingles):
        return [0, 0, 0]
    mixed = (shingles ^ (shingles >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    out = []
    for hashes in (shingles, mixed ^ (mixed >> np.uint64(29))):
        votes = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8)
            votes += np.unpackbits(part).reshape(-1, 64).sum(0, dtype=np.int64)
        out.append(int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big", signed=True))
    digest = xxhash.xxh64_intdigest(shingles.tobytes())
    return [*out, digest - (1 << 64) if digest >> 63 else digest]


def prefix(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first shingles of a set, in one order for all sets: two sets that are alike share one of them.

    The larger of two such sets has a fifth of its shingles outside the other at
    most, and the other way round, whatever the order. Frequent ones come last.
    """
    n = len(shingles)
    late = np.isin(shingles, frequent)
    return np.concatenate([shingles[~late], shingles[late]])[: n + 1 + -n * LIKE[0] // LIKE[1]] if n else shingles


def alike(sets: list[np.ndarray], right: np.ndarray) -> list[tuple[int, int]]:
    """Spanning links of sets of similarity ``LIKE`` or more; with sets on both sides, only those across."""
    sizes = np.array([len(x) for x in sets])
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    held = np.zeros(number.max() + 1, bool)
    forest, links = Forest(len(sets)), []
    for i in np.nonzero(~right)[0].tolist():
        if (forest.label == forest.label[i]).all():
            break
        own = number[starts[i] : starts[i] + sizes[i]]
        held[own] = True
        common = np.add.reduceat(held[number], starts, dtype=np.int64)
        held[own] = False
        near = common * sum(LIKE) >= LIKE[0] * (sizes + sizes[i])
        near &= right if right.any() else np.arange(len(sets)) != i
        links += [(i, x) for x in forest.join(i, np.nonzero(near)[0])] if near.any() else []
    return links


def _frequent(docs: DataFrame) -> np.ndarray:
    """Shingles that many documents of a bounded sample hold. They change the order of keys, not what is found."""
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    chosen = F.broadcast(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS))  # that many longs

    def each(batches):
        for (values,) in columns(batches, 200):
            found = [shingle_set(x) for x in values]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["shingle"])

    rows = texts(docs).join(chosen, "doc_id").select(F.col("text").cast("binary")).mapInArrow(each, "shingle long")
    often = rows.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT)
    return np.sort(often.select("shingle").toArrow().column("shingle").to_numpy().view(np.uint64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).view(np.int64)))


def document_key() -> Column:
    """A digest of id and text: rows that differ in either differ in it."""
    digits = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.unhex(F.md5(F.concat(digits, F.lit(":"), F.coalesce("text", F.lit("")))))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(document_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def _sketches(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``key``, ``doc_id``, ``bytes`` of the text, ``print`` and ``size`` of the set, and its prefix as ``shingles``."""

    def compute(batches):
        for keys, ids, values in columns(batches, 200):
            sets = [shingle_set(x) for x in values]
            prints = [set_print(x) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array([len(x) for x in values], pa.int64()),
                    pa.array(prints, pa.list_(pa.int64())), pa.array([len(x) for x in sets], pa.int64()),
                    _lists([prefix(x, frequent) for x in sets]),
                ],
                ["key", "doc_id", "bytes", "print", "size", "shingles"],
            )

    schema = "key binary, doc_id long, bytes long, print array<long>, size long, shingles array<long>"
    return _keyed(docs).mapInArrow(compute, schema)


def _marks(keys: DataFrame) -> DataFrame:
    """A bit for each key by its hash: at most ``MARK_SLOTS`` rows of two longs, whatever the number of keys."""
    h = F.xxhash64("key")
    rows = keys.select(F.pmod(h, F.lit(MARK_SLOTS)).alias("slot"), _bit(h).alias("bit"))
    return rows.groupBy("slot").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))


def _bit(h: Column) -> Column:
    return F.shiftrightunsigned(h, 40).bitwiseAND(63).cast("int")


def _with_mark(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Adds ``marked``: true for each key of ``marks`` and, by chance, for some others."""
    h = F.xxhash64("key")
    rows = rows.withColumn("slot", F.pmod(h, F.lit(MARK_SLOTS))).withColumn("bit", _bit(h))
    rows = rows.join(F.broadcast(marks), "slot", "left")
    return rows.withColumn("marked", F.coalesce(F.expr("getbit(bits, bit) = 1"), F.lit(False))).drop("slot", "bit", "bits")


def _alike_links(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``a`` and ``b``, nodes whose sets are alike: every pair within a component of ``members`` is compared or spanned."""
    sizes = members.groupBy("component").agg(
        F.greatest(
            F.ceil(F.count("*") / PART_ROWS), F.ceil(F.sum("size") / PART_SHINGLES), F.ceil(F.sum("bytes") / PART_BYTES)
        ).cast("int").alias("parts")
    )
    # Only texts of candidates leave the scan, and a few more; the join below is exact.
    wanted = _with_mark(_keyed(docs), _marks(members.select("key"))).where("marked")
    wanted = wanted.select("key", "text").dropDuplicates(["key"])
    # Both joins meet few rows with like keys: a component each, and a node each. Texts travel, their sets are larger.
    rows = members.select("id", "key", "component").join(sizes, "component").join(wanted.hint("merge"), "key")
    rows = (
        rows.withColumn("own", F.pmod(F.xxhash64("id"), "parts").cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .select(
            "component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            F.expr("own > other").alias("right"), "id", "text",
        )
    )

    def compare(group: pa.Table) -> pa.Table:
        ids, right = group.column("id").to_numpy(), group.column("right").to_numpy()
        found = alike([shingle_set(x.as_py()) for x in group.column("text")], right) if len(ids) > 1 else []
        pair = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": ids[pair[:, 0]], "b": ids[pair[:, 1]]})

    return rows.groupBy("component", "low", "high").applyInArrow(compare, "a long, b long")


def _grouped(docs: DataFrame) -> DataFrame:
    """``key`` and ``doc_id`` of each row, and of its group ``least``: the smallest ``doc_id`` (null last) and ``key``.

    Staged; what the steps before it wrote is deleted.
    """
    least = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "key")).alias("least")
    keys = F.first("shingles").alias("keys")
    with ExitStack() as held:
        with ExitStack() as brief:  # the sketches, and then the keys, take most of the room
            with staged(_sketches(docs, _frequent(docs)), "sketches") as sketches:
                prints = held.enter_context(staged(sketches.select("key", "doc_id", "print"), "prints"))
                nodes = sketches.groupBy("print").agg(least, F.first("size").alias("size"), F.max("bytes").alias("bytes"), keys)
                keyed = brief.enter_context(staged(nodes.withColumn("id", F.monotonically_increasing_id()), "keyed"))
            nodes = held.enter_context(staged(keyed.drop("keys"), "nodes"))
            loose = components(key_links(keyed, 2, CANDIDATE_RADIUS))
        members = nodes.join(loose, nodes["id"] == loose["node"]).select("id", "least.key", "size", "bytes", "component")
        members = held.enter_context(staged(members, "members"))
        found = components(_alike_links(docs, members))
        named = nodes.join(found, nodes["id"] == found["node"], "left")
        named = held.enter_context(staged(named.select("print", "least", F.coalesce("component", "id").alias("component")), "named"))
        first = named.groupBy("component").agg(F.min("least").alias("least"))
        named = named.select("print", "component").join(first, "component").select("print", "least")
        return stage(prints.join(named, "print").drop("print"), "grouped")


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``component_id``: the smallest id reachable over texts whose sets of five words in a row have a
    similarity of 0.8 or more.

    Texts with equal sets are one node. Nodes that share a shingle of their prefixes
    are candidates if their SimHashes are near, and candidates are grouped loosely;
    within such a group, all sets are compared. One row per row of ``docs``; rows
    without ``doc_id`` take part, and ``component_id`` is null where no row of a group
    has one. Null texts are empty, and all texts without words are one group. Other
    columns are not read. An empty table gives no rows.
    """
    return _grouped(docs).select("doc_id", F.col("least.doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of :func:`near_groups`: one with the smallest id, null last.

    Rows are told apart by id and text: different texts that share an id, or have
    none, are documents of their own, and equal rows are copies. Of several with the
    smallest id, the one with the smallest digest stays; where id and text repeat, any
    one of those rows. Null and empty texts are one group. All columns are kept, and an
    empty table stays empty. Texts are shuffled only where a row may go.
    """
    found = _grouped(docs)
    counted = found.groupBy("key", F.expr("key = least.key").alias("stays")).agg(F.count("*").alias("n"))
    counted = stage(counted, "decisions")
    rows = docs.select(F.struct(*docs.columns).alias("row"), document_key().alias("key"))
    rows = _with_mark(rows, _marks(counted.where("n > 1 or not stays").select("key")))
    doubtful = rows.where("marked").select("row", "key")
    # Merge joins: the plan is the same at any size, and a key that repeats can be split.
    once = doubtful.join(counted.where("stays and n = 1").select("key").hint("merge"), "key", "left_semi")
    often = doubtful.join(counted.where("stays and n > 1").select("key").hint("merge"), "key", "left_semi")
    kept = rows.where("not marked").select("row").unionAll(once.select("row"))
    return kept.unionAll(often.dropDuplicates(["key"]).select("row")).select("row.*")
