import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from plain import awkward, documents, empty, words
from pyspark.sql import functions as F

from gaugeworks.llm import mixing, packing


def plain_targets(sizes):
    """Source -> words, in order; weights 5, 2, 1, repeating."""
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sizes)}
    wanted, left, out = 1.5 * sum(sizes.values()), set(sizes), {}
    while left:
        rest, total = wanted - sum(out.values()), sum(weight[s] for s in left)
        above = [s for s in left if rest * weight[s] / total > 2 * sizes[s]]
        for s in above or list(left):
            out[s] = 2.0 * sizes[s] if above else rest * weight[s] / total
            left.discard(s)
    return out


def test_mix(spark):
    df = awkward(spark)
    rows = df.select("doc_id", "text", "source").collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(words(r.text))
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = plain_targets({s: sizes[s] for s in order})
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r.doc_id, len(words(r.text))) for r in rows)
    by_size = {sizes[s]: want[s] for s in order}
    for total, rows in {t: [r for r in got if r.source_size == t] for t in by_size}.items():
        assert rows[0].target == pytest.approx(by_size[total])
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 2 * mixing.BLOCK_WORDS
    again = mixing.mix(df.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.mix(empty(spark)).count() == 0


def test_permutation_is_one_to_one(spark):
    for size in (1, 2, 7, 64, 1000):
        df = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size).cast("long"), F.lit("k")).alias("p"))
        got = [r.p for r in df.collect()]
        assert sorted(got) == list(range(size))
    assert got != list(range(1000)) and abs(np.corrcoef(got, range(1000))[0, 1]) < 0.15


def test_slots_hold_every_draw_once(spark):
    sizes = spark.createDataFrame([("a", 9000), ("b", 300_000), (None, 5)], "source string, size long")
    sources = mixing.with_draws(mixing.targets(sizes))
    drawn = mixing.slots(sources).collect()
    places = sorted(r.shard * mixing.SHARD_SLOTS + r.slot for r in drawn)
    assert places == list(range(len(drawn)))
    for s in sources.collect():
        blocks = Counter(r.block for r in drawn if r.number == s.number)
        assert sum(blocks.values()) == s.draws and max(blocks.values()) <= 2
        assert max(blocks.values()) - min(blocks.get(b, 0) for b in range(s.blocks)) <= 1


def spark_hash(*values):
    """Spark's xxhash64 of long, int (as a pair with False) and string values."""
    seed = 42
    for value in values:
        raw = value.encode() if isinstance(value, str) else struct.pack("<i", value[0]) if isinstance(value, tuple) else struct.pack("<q", value)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_permuted(x, size, *key):
    for r in range(mixing.ROUNDS):
        other = (spark_hash((r,), *key) % size + size - x) % size
        if spark_hash(max(x, other), (r,), *key) & 1:
            x = other
    return x


def test_mix_follows_its_slots(spark, monkeypatch):
    """Shards, slots and words taken, recomputed without Spark; another slot map gives another mix."""
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 16)
    rows = [(i, " ".join(["w"] * (5 + 37 * i % 300)), f"s{i % 3}") for i in range(60)]
    df = documents(spark, rows)
    got = {r.doc_id: r for r in mixing.mix(df).collect()}
    sizes = mixing._sizes(df)
    sources = {r.number: r for r in mixing.with_draws(mixing.targets(sizes)).collect()}
    streams = {r.doc_id: r for r in mixing.placed(sizes, mixing.with_draws(mixing.targets(sizes))).collect()}
    places, counts = {}, Counter()
    for number, s in sources.items():
        for draw in range(s.draws):
            place = plain_permuted(s.first + draw, s.all_draws, "slots")
            block = plain_permuted(draw % s.blocks, s.blocks, (number,), "blocks")
            places.setdefault((number, block), []).append(place)
            counts[place // 16, number] += 1
    for doc_id, _, _ in rows:
        here = streams[doc_id]
        taken, first = 0, None
        for block in range(here.at // 64, (here.at + here.size - 1) // 64 + 1):
            words_in = min(here.at + here.size, 64 * block + 64) - max(here.at, 64 * block)
            for place in places.get((here.number, block), []):
                taken, first = taken + words_in, place if first is None else min(first, place)
        found = got[doc_id]
        assert (found.taken, found.shard, found.slot) == (taken, *((None, None) if first is None else divmod(first, 16)))
    drawn = mixing.slots(mixing.with_draws(mixing.targets(sizes)))
    assert {(r.shard, r.number): r.n for r in mixing.shard_counts(drawn).collect()} == counts
    # Every full shard is a draw from the sources at their shares, so no two sources come in one run.
    full = [s for s in {s for s, _ in counts} if sum(n for (t, _), n in counts.items() if t == s) == 16]
    assert len(full) >= 5 and all(len({n for (t, n) in counts if t == s}) > 1 for s in full)
    monkeypatch.setattr(mixing, "ROUNDS", mixing.ROUNDS - 1)
    other = {r.doc_id: r for r in mixing.mix(df).collect()}
    assert any((other[d].shard, other[d].slot) != (got[d].shard, got[d].slot) for d in got)


def test_mixed_documents_hold_what_the_mix_takes(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(20 + 13 * i)), f"s{i % 5}") for i in range(40)]
    df = documents(spark, rows)
    taken = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    got = mixing.mixed(df).collect()
    sizes = Counter()
    for r in got:
        own = r.text.split()
        sizes[r.doc_id] += len(own)
        assert r.n_chars == len(r.text) and set(own) <= set(rows[r.doc_id][1].split()) and len(set(own)) == len(own)
    assert sizes == {i: n for i, n in taken.items() if n}
    assert mixing.mixed(awkward(spark)).columns == awkward(spark).columns
    assert mixing.mixed(empty(spark)).count() == 0


def test_rows_alike_have_plans_of_their_own(spark):
    """Null and repeated ids: words taken in all are those the mix reports, each row's from its own text."""
    rows = [(None, " ".join(f"n{i}x{k}" for k in range(70)), "a") for i in range(30)]
    rows += [(7, " ".join(f"r{k}" for k in range(150)), "a")] * 25 + [(None, "one two three", None)] * 40
    rows += [(i, " ".join(f"w{i}x{k}" for k in range(90)), "b") for i in range(100, 130)]
    df = documents(spark, rows).repartition(6)
    got, taken = mixing.mixed(df).collect(), mixing.mix(df).collect()
    sizes, want = Counter(), Counter()
    for r in got:
        sizes[r.doc_id, r.source] += len(r.text.split())
    for r in taken:
        want[r.doc_id, r.source_size] += r.taken
    assert sorted(sizes.values()) == sorted(n for n in want.values() if n)
    used = Counter(w for r in got if r.source == "a" and r.doc_id is None for w in r.text.split())
    assert max(used.values()) <= 2 and len({w.split("x")[0] for w in used}) > 10
    copies = Counter(w for r in got if r.doc_id == 7 for w in r.text.split())
    assert max(copies.values()) <= 50 and sum(copies.values()) == sizes[7, "a"]
    numbered = mixing.with_copies(mixing._sizes(df, F.monotonically_increasing_id().alias("row"))).collect()
    assert sorted(r.copy for r in numbered if r.doc_id == 7) == list(range(25))
    assert sorted(r.copy for r in numbered if r.source is None) == list(range(40))


def test_pack_fits_and_downsizes():
    rng = np.random.default_rng(0)
    sizes = -np.sort(-rng.integers(0, 4097, 3000))
    bins, capacity = packing.pack(sizes)
    fill = np.bincount(bins, sizes)
    for f, c in zip(fill, capacity, strict=True):
        assert f <= c and all(x < f for x in packing.LENGTHS if x < c)
    # Several lengths cost no more than the best single one, packed alike.
    spent = sum(map(packing.cost, capacity))
    assert spent <= sum(map(packing.cost, packing.pack(sizes, (4096,))[1]))
    small = sizes[sizes <= 700]
    spent = sum(map(packing.cost, packing.pack(small)[1]))
    assert spent <= 1.001 * min(sum(map(packing.cost, packing.pack(small, (x,))[1])) for x in packing.LENGTHS if x >= 1024)
    assert packing.pack(np.array([10]))[1] == [512]


def plain_pack(sizes, lengths):
    """The same rule, looking at every open bin for each piece."""
    bins, open_bins, left = [], [], sum(sizes)  # an open bin: [length, room, when it last changed]
    for n, size in enumerate(sizes):
        left -= size
        fitting = [b for b in open_bins if b[1] >= size and b[1] > 0]
        if fitting:
            chosen = min(fitting, key=lambda b: (b[1], -b[2]))
        else:

            def per_word(length):
                room = length - size
                more = min(max(room - sizes[-1] / 2, 0) if room >= sizes[-1] else 0, left)
                return packing.cost(length) / max(size + more, 1)

            chosen = [min((x for x in lengths if x >= size), key=lambda x: (per_word(x), x)), 0, 0]
            chosen[1] = chosen[0]
            open_bins.append(chosen)
        chosen[1:] = [chosen[1] - size, n]
        bins.append(next(k for k, b in enumerate(open_bins) if b is chosen))
    return bins, [min(x for x in lengths if x >= length - room) for length, room, _ in open_bins]


@pytest.mark.parametrize("most", [5, 300, 4096])
def test_pack_equals_a_plain_packer(most):
    rng = np.random.default_rng(most)
    for n in (0, 1, 2, 40, 400):
        sizes = np.sort(rng.integers(1, most + 1, n))[::-1]
        bins, capacity = packing.pack(sizes)
        assert (bins.tolist(), capacity) == plain_pack(sizes.tolist(), packing.LENGTHS)


def test_equal_rows_spread_over_shards(spark):
    rows = spark.range(9000).selectExpr("1L AS doc_id", "'a b c' AS text")
    counts = [r["count"] for r in packing.packed(rows).groupBy("shard").count().collect()]
    assert sum(counts) == 9000 and len(counts) == 5 and max(counts) < 1.2 * packing.SHARD_PIECES


def test_packed(spark):
    df = awkward(spark)
    got = packing.packed(df).collect()
    want = Counter()
    for r in df.collect():
        want[r.doc_id] += len(words(r.text))
    held = Counter()
    for r in got:
        held[r.doc_id] += r.words
        assert r.start == r.piece * 4096 and 0 <= r.position and r.position + r.words <= r.fill <= r.capacity
    assert held == want
    bins = {}
    for r in got:
        bins.setdefault((r.shard, r.bin), []).append(r)
    for rows in bins.values():
        rows.sort(key=lambda r: (r.position, r.words))
        assert sum(r.words for r in rows) == rows[0].fill
        assert all(a.position + a.words == b.position for a, b in zip(rows, rows[1:]))
    assert packing.packed(empty(spark)).count() == 0
