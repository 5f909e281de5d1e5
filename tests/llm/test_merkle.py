import hashlib
import random
import zlib

import pytest
from plain import DOCS, awkward, documents, empty, sentence
from pyspark.sql import functions as F

from gaugeworks.llm import merkle

LOWER = str.maketrans(merkle.UPPER, merkle.LOWER)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    cells = [None if v is None else str(v) for v in (row.doc_id, row.source, row.lang, row.n_chars, text)]
    return sha(*("-" if c is None else f"{len(c.encode())}:{c}" for c in cells))


def climb(digests):
    """The root and, for each digest, the (left, right) siblings up to it."""
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 8]) for i in range(0, len(below), 8)])
    paths = []
    for at in range(len(digests)):
        sides = []
        for level in levels[:-1]:
            first = at // 8 * 8
            sides.append(("".join(level[first:at]), "".join(level[at + 1 : first + 8])))
            at //= 8
        paths.append(sides)
    return levels[-1][0], paths


def plain(rows):
    """doc_id, leaf, subroot, root, proof, folded root, verified of each row."""
    trees = {}
    for row in rows:
        digest = now = leaf(row, row.text)
        if row.doc_id is not None and row.text is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
            now = leaf(row, row.text.translate(LOWER))
        trees.setdefault(row.lang, []).append((row.doc_id is not None, row.doc_id or 0, digest, now))
    langs = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {lang: climb([r[2] for r in sorted(trees[lang])]) for lang in langs}
    root, tops = climb([built[lang][0] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        subroot, paths = built[lang]
        for (known, doc_id, digest, now), path in zip(sorted(trees[lang]), paths):
            path = path + top
            for left, right in path:
                now = sha(left, now, right)
            proof = sha(*(left + right for left, right in path))
            out.append((doc_id if known else None, digest, subroot, root, proof, now, now == root))
    return sorted(out, key=str)


def got(docs):
    return sorted((tuple(r) for r in merkle.manifest(docs, merkle.tampered_leaf(docs)).collect()), key=str)


def rows_of(n, langs, seed=0):
    rng = random.Random(seed)
    return [(i, sentence(rng, 5).title(), rng.choice(langs), f"s{i % 3}", i) for i in range(n)]


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (8, ["en"]), (9, ["en", None]), (1300, ["en", "en", "de", None, "é", ""])])
def test_equals_plain_trees(spark, n, langs):
    docs = spark.createDataFrame(rows_of(n, langs), DOCS).repartition(5)
    assert got(docs) == plain(docs.collect())


def test_more_languages_than_a_parent_holds(spark):
    docs = spark.createDataFrame(rows_of(700, [f"l{i}" for i in range(70)]), DOCS)
    assert got(docs) == plain(docs.collect())


def test_several_layers_of_blocks(spark, monkeypatch):
    """Blocks of 8 nodes: five layers for 5,000 leaves, as 512 ** 5 rows would have."""
    monkeypatch.setattr(merkle, "LIFT", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    docs = spark.createDataFrame(rows_of(5_000, ["en"] * 9 + ["de"]), DOCS).repartition(7)
    assert got(docs) == plain(docs.collect())


def test_awkward_rows(spark):
    docs = awkward(spark)
    made = got(docs)
    assert made == plain(docs.select("doc_id", "text", "lang", "source", "n_chars").collect())
    assert made == got(docs.repartition(3).orderBy(F.desc("text")))
    assert got(empty(spark)) == []


def test_untouched_rows_verify_and_changed_ones_do_not(spark):
    docs = documents(spark, [(i, f"Text {i}") for i in range(40)])
    for row in merkle.manifest(docs).collect():
        assert row.verified and row.folded_root == row.root
    changed = {r.doc_id for r in merkle.manifest(docs, merkle.tampered_leaf(docs)).collect() if not r.verified}
    assert changed == {i for i in range(40) if zlib.crc32(str(i).encode()) % 3 == 0}


def test_states_are_resumed():
    """A parent's states hash what is left of each slot, and folding adds nothing left of it."""
    children = [sha(str(i)) for i in range(5)]
    parent = merkle.Parent(children)
    assert parent.digest == sha(*children)
    for slot, state in enumerate(parent.states):
        assert state.hexdigest() == sha(*children[:slot])
        left, right = parent.siblings(slot)
        assert merkle.resumed(state, "new", right) == sha(left, "new", right)
        assert state.hexdigest() == sha(*children[:slot])
