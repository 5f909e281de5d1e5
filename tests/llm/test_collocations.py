import random
import re
from collections import Counter

import numpy as np
import pytest
from plain import DOCS, awkward, documents, empty

from gaugeworks.llm import collocations as co

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spoken(text):
    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
        yield re.findall("[^ \t]+", piece)


def plain(rows, at_least=10, top=2000):
    counts = {}
    for row in rows:
        f = counts.setdefault(row.lang or "und" if row.lang != "" else "", Counter())
        for words in spoken(row.text):
            for size in (1, 2, 3):
                f.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for gram, c in f.items() if len(gram) == 1)
        found = {gram: a for gram, a in f.items() if len(gram) > 1 and a >= at_least}
        ranked = []
        for gram, a in found.items():
            around = [b for other, b in found.items() if len(other) > len(gram) and gram in (other[:2], other[1:])]
            if any(100 * b >= 50 * a for b in around):
                continue
            value, k = min((10**6 * a * a // (f[gram[:k]] * f[gram[k:]]), k) for k in range(1, len(gram)))
            ranked.append((-value, -a, " ".join(gram).encode(), f[gram[:k]], f[gram[k:]]))
        for rank, (value, a, phrase, left, right) in enumerate(sorted(ranked)[:top]):
            out.append((lang, rank + 1, phrase.decode(), -a, left, right, n, -value))
    return sorted(out)


def got(docs, **limits):
    return sorted(tuple(r) for r in co.phrases(docs, **limits).collect())


def corpus(spark, n=400, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["New", "york", "ÉTÉ", "\x01x", "a\xa0b", "-"]
    rows = []
    for i in range(n):
        text = "".join(
            rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!", " New York City ", " the end of "])
            for _ in range(rng.randrange(80))
        )
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None, "und", ""]), "s", 0))
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize(
    "limits",
    [
        {},
        {"range_bytes": 3_000, "gather": 2_000, "shard_words": 97},
        {"at_least": 2, "range_bytes": 200, "gather": 700, "top": 30},
    ],
)
def test_equals_plain_counts(spark, limits):
    docs = corpus(spark)
    assert got(docs.repartition(5), **limits) == plain(docs.collect(), limits.get("at_least", 10), limits.get("top", 2000))


def test_ranges_dealt_further(spark, monkeypatch):
    """More ranges than the sample can bound, and more local tops than one task compares."""
    monkeypatch.setattr(co, "SAMPLE_DOCS", 2)
    monkeypatch.setattr(co, "SAMPLE_PAIRS", 3)
    monkeypatch.setattr(co, "TOPS", 4)
    docs = corpus(spark)
    texts = docs.selectExpr("coalesce(lang, 'und') AS lang", "coalesce(text, '') AS text")
    ranges = co.ranges_of(texts, 500)
    assert ranges.deals > 1 and all(len(bounds) <= 12 for bounds in ranges.bounds.values())
    assert got(docs, range_bytes=500, gather=3_000, at_least=3, top=25) == plain(docs.collect(), 3, 25)


def test_hot_phrase_and_repeated_rows(spark):
    docs = documents(spark, [(i % 7, "of the people, by the people. of the people") for i in range(900)] + [(9, "b c")])
    assert got(docs, range_bytes=500, gather=1_000) == plain(docs.collect())


def test_awkward_rows(spark):
    docs = awkward(spark)
    want = plain(docs.select("doc_id", "text", "lang").collect())
    assert got(docs) == want and got(docs.repartition(3), range_bytes=1_000) == want
    assert got(empty(spark)) == []
    assert got(documents(spark, [(1, ""), (2, None), (3, " .,;\t")])) == []


def counts_of(grams):
    words = sorted({w for gram in grams for w in gram})
    number = {w: i + 1 for i, w in enumerate(words)}
    rows = sorted(([number[w] for w in gram] + [0] * (3 - len(gram)), n) for gram, n in grams.items())
    path = np.array([r[0] for r in rows], np.int64).reshape(-1, 3)
    return co.Counts(words, path, np.array([r[1] for r in rows], np.int64))


def random_grams(seed, n):
    rng = random.Random(seed)
    words = [bytes([97 + i]) * (1 + i % 3) for i in range(12)]
    return {tuple(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 3]))): rng.choice([1, 1, 1, 2, 2**40]) for _ in range(n)}


def grams_of(counts):
    return {tuple(counts.words[i - 1] for i in p if i): int(w) for p, w in zip(counts.path.tolist(), counts.weight)}


def test_automata_keep_paths_and_merge_states():
    for seed in range(20):
        grams = random_grams(seed, 200)
        assert grams_of(co.unpacked(co.packed(counts_of(grams)))) == grams
    # Every pair leads to the same two endings: one state instead of 900, one first word's state instead of 30.
    words = [b"%03d" % i for i in range(30)]
    same = {(a, b, c): 1 for a in words for b in words for c in words[:2]}
    _, root, middle_lengths, middle, last_lengths, last = co.pickle.loads(co.packed(counts_of(same)))
    assert len(root) // 8 == 30 and len(middle_lengths) // 4 == 1 and len(last_lengths) // 4 == 1 and len(last) // 12 == 2


def test_union_sums_and_prefixes_count():
    some = [random_grams(seed, 150) for seed in range(6)]
    whole = co.united([counts_of(grams) for grams in some])
    want = Counter()
    for grams in some:
        want.update(grams)
    assert grams_of(whole) == want
    asked = sorted({gram[:2] for gram in want} | {(b"zz",), (b"a", b"zz")})
    # One word alone counts by its own path, two words by the range they begin.
    total = [want[g] if len(g) == 1 else sum(n for gram, n in want.items() if gram[:2] == g) for g in asked]
    assert co.composed(whole, [b" ".join(g) for g in asked]) == total
    kept = co.pruned(whole, 5)
    pairs = [g for g in asked if len(g) == 2]
    again = co.composed(kept, [b" ".join(g) for g in pairs])
    assert again == [n if n >= 5 else 0 for n in (sum(v for k, v in want.items() if k[:2] == g) for g in pairs)]


def test_products_beyond_64_bits():
    a = 3 * 10**9
    assert co.SCALE * a * a > 2**63
    assert next(iter(co._candidates(counts_of({(b"a", b"b"): a}), 10)))[1] == a
