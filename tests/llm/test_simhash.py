import random
import time
from collections import Counter

import numpy as np
import xxhash
from plain import awkward, documents, empty, sentence, words
from pyspark.sql import functions as F

from gaugeworks.llm import simhash
from gaugeworks.llm.components import components
from gaugeworks.session import stage


def plain_print(text):
    w = words(text)
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    """(id, print) pairs -> smallest id reachable."""
    ids = sorted({i for i, _ in rows})
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, p in rows:
        for j, q in rows:
            if (p ^ q).bit_count() <= 4:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_groups_equal_brute_force(spark):
    df = awkward(spark)
    got = simhash.groups(df).collect()
    rows = df.collect()
    assert len(got) == len(rows)
    prints = {(r.doc_id, plain_print(r.text)) for r in rows}
    assert {(r.doc_id, r.print[0] % 2**64) for r in got} == prints
    want = plain_groups([(i, p) for i, p in prints if i is not None])
    assert all(r.component_id == want.get(r.doc_id) for r in got)
    assert simhash.groups(empty(spark)).count() == 0


def test_chains_and_hubs_of_prints(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    prints = set(base.tolist())
    for p in base.tolist():  # chains: each step changes up to four bits
        for _ in range(12):
            for b in rng.integers(0, 64, rng.integers(1, 5)).tolist():
                p ^= 1 << b
            prints.add(p)
    rows = [(i, int(np.uint64(p).view(np.int64))) for i, p in enumerate(sorted(prints))]
    nodes = spark.createDataFrame([(i, [p]) for i, p in rows], "id long, print array<long>")
    found = {r.node: r.component for r in components(simhash.links(nodes, 1, 6, 4)).collect()}
    want = plain_groups([(i, p % 2**64) for i, p in rows])
    assert {i: found.get(i, i) for i, _ in rows} == want


def test_large_bucket_is_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 16)
    rng = random.Random(2)
    rows = [(i, [sum(1 << b for b in rng.sample(range(63), rng.randrange(4)))]) for i in range(150)]
    rows = [(min(i for i, q in rows if q == p), list(p)) for p in {tuple(q): 0 for _, q in rows} for p in [list(p)]]
    nodes = spark.createDataFrame(rows, "id long, print array<long>")
    found = {r.node: r.component for r in components(simhash.links(nodes, 1, 6, 4)).collect()}
    want = plain_groups([(i, p[0]) for i, p in rows])
    assert {i: found.get(i, i) for i, _ in rows} == want


def test_bit_sliced_distances():
    rng = np.random.default_rng(0)
    prints = np.repeat(rng.integers(0, 2**63, (1, 2), dtype=np.uint64), 150, 0)
    for row in prints:
        for b in rng.integers(0, 128, rng.integers(0, 40)):
            row[b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    distance = np.bitwise_count(prints[:, None] ^ prints[None]).sum(2)
    i, j = np.triu_indices(150, 1)
    for radius in (0, 1, 4, 7, 8, 22, 31):
        got = {(q, int(r)) for q, rows in simhash.near_rows(prints, prints, radius) for r in rows}
        assert got == set(zip(*np.nonzero(distance <= radius), strict=True))
        assert (simhash.near_pairs(prints, i, j, radius) == (distance[i, j] <= radius)).all()


def test_keep_one(spark):
    rng = random.Random(4)
    text = sentence(rng, 300).split(" ")
    near = list(text)
    near[100] = "changed"
    rows = [(5, " ".join(text)), (7, " ".join(near)), (9, " ".join(text)), (11, sentence(rng, 300)), (11, sentence(rng, 300))]
    rows += [rows[3], (None, "a"), (None, "a"), (None, sentence(rng, 300)), (None, " ".join(near)), (13, "b"), (None, "b")]
    kept = simhash.keep_one(documents(spark, rows)).collect()
    # Different texts of one id or of none stay, repeated ones and copies go, and an id comes before none.
    want = [rows[0], rows[3], rows[4], rows[6], rows[8], (13, "b")]
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(want, key=str)
    groups = sorted(((r.doc_id, r.component_id) for r in simhash.near_groups(documents(spark, rows)).collect()), key=str)
    assert groups == sorted([(5, 5), (7, 5), (9, 5), (11, 11), (11, 11), (11, 11), *[(None, None)] * 3, (None, 5), (13, 13), (None, 13)], key=str)
    assert simhash.keep_one(awkward(spark)).columns == awkward(spark).columns
    assert simhash.keep_one(empty(spark)).count() == 0


def test_only_rows_that_may_go_are_joined(spark):
    rng = random.Random(6)
    rows = [(i, sentence(rng, 40)) for i in range(300)] + [(300, "same words in all of these"), (301, "same words in all of these")]
    docs = documents(spark, rows)
    keyed = simhash._keyed(docs)
    marks = simhash._marks(keyed.where("doc_id >= 290"))
    marked = {r.doc_id for r in simhash._with_mark(keyed, marks).where("marked").collect()}
    assert set(range(290, 302)) <= marked and len(marked) < 20
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == list(range(301))


def shuffled_blocks(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for k in range(blocks.size()) if (name := blocks.apply(k).name()).startswith("shuffle_")}


def test_staging_frees_its_shuffle_files(spark):
    before = shuffled_blocks(spark)
    rows = stage(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.sum("id").alias("n")), "freed")
    ends = time.time() + 20
    while (left := shuffled_blocks(spark) - before) and time.time() < ends:
        time.sleep(0.2)  # they go in the background
    assert not left
    assert rows.agg(F.sum("n")).head()[0] == 5000 * 4999 // 2


def test_nodes_meet_where_they_share_a_key(spark, monkeypatch):
    """Forests over shared keys reach what all near pairs do, also where a bucket is cut into parts."""
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 32)
    rng = random.Random(11)
    rows = []
    for i in range(400):
        near = [p ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(4))) for p in (5, 7)] if i % 3 else [rng.getrandbits(63), 1]
        rows.append((i, near, [*rng.sample(range(300), 2), 1000 + i, *([7777] if i % 2 else [])]))
    want = []
    for i, p, k in rows:
        for j, q, other in rows[:i]:
            if sum((a ^ b).bit_count() for a, b in zip(p, q)) <= 6 and set(k) & set(other):
                want.append((i, j))
    nodes = spark.createDataFrame(rows, "id long, print array<long>, keys array<long>")
    links = simhash.key_links(nodes, 2, 6)
    assert {(max(r), min(r)) for r in links.collect()} <= set(want)
    reach = lambda df: {tuple(r) for r in components(df).select("node", "component").collect()}
    assert reach(links) == reach(spark.createDataFrame(want, "a long, b long")) and len(want) > 1000
    # A key of one node goes no further than its bucket: prints are not shuffled with it.
    plan = simhash.key_links(nodes, 2, 6)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window") :]
    assert "Generate explode" in below and "print0" not in below.split("Generate explode")[0]


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1200)] + [(5000, 5000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[k] == 1000 for k in range(1000, 1200)) and 5000 not in got


def five_words(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stage_equals_brute_force_over_word_sets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART_ROWS", 16)
    rng, line = random.Random(8), sentence(random.Random(9), 9)
    rows = []
    for k in range(60):  # texts around similarity 0.8, short ones as well, some with a line that all share
        text = sentence(rng, rng.choice([5, 8, 9, 12, 60, 250])).split(" ") + line.split(" ") * (k % 2)
        for _ in range(8):
            changed = list(text)
            for at in rng.sample(range(len(text)), rng.randrange(1 + len(text) // 30)):
                changed[at] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(changed[: len(changed) - rng.choice([0, 0, 1, 2])])))
    sets = [five_words(x) for _, x in rows]
    root, near, far = list(range(len(rows))), 0, 0
    for i in range(len(rows)):
        for j in range(i):
            like = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            near, far = near + (0.8 <= like < 0.85), far + (0.7 <= like < 0.8)
            if like >= 0.8 and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    assert near > 100 and far > 100
    got = {r.doc_id: r.component_id for r in simhash.near_groups(documents(spark, rows)).collect()}
    assert got == dict(enumerate(root))
    assert {r.doc_id for r in simhash.keep_one(documents(spark, rows)).collect()} == set(root)


def test_many_bytes_of_text_are_compared_in_parts(spark, monkeypatch):
    """Long texts of few shingles are cut into parts as well, and groups are the same."""
    rng = random.Random(12)
    text = sentence(rng, 40)
    rows = [(i, f"{text} " * 5 + f"end{i}") for i in range(30)] + [(100 + i, sentence(rng, 60)) for i in range(30)]
    docs = documents(spark, rows)
    groups = lambda: sorted(map(tuple, simhash.near_groups(docs).collect()))
    want = groups()
    assert Counter(c for _, c in want)[0] == 30
    monkeypatch.setattr(simhash, "PART_BYTES", 2_000)
    assert groups() == want
