import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from plain import awkward, documents, empty, sentence, words
from pyspark.sql import functions as F

from gaugeworks.llm import attribution, gru, licenses, minhash, scoring, toxicity


# --- toxicity ---------------------------------------------------------------------


def labelled(spark, n=400):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        text, toxic = sentence(rng, rng.randrange(20, 120)), int(i % 4 == 0)
        if toxic:
            parts = text.split(" ")
            parts.insert(rng.randrange(len(parts)), rng.choice(["grumpf", "Grump7", "grуmpfish", "ZONKED", "z0nked"]))
            text = " ".join(parts)
        elif i % 30 == 0:  # the word stays a sign, the phrase does not
            text += " the grumpf festival was nice"
        rows.append((i, text))
        labels.append((i, 1, toxic))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.scored(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    again = toxicity.scored(docs.repartition(5), labels.repartition(3)).collect()
    assert {r.doc_id: round(r.score, 9) for r in again} == {r.doc_id: round(r.score, 9) for r in got}


def test_matching_folds_and_spares():
    entries = [("idio", True, 2.0), ("idiot", True, 5.0), ("ass", False, 3.0)]
    machine = toxicity.automaton(toxicity.Model(entries, ["wise ass", "ass ociated"], (0, 0, 0)))
    found = lambda text: sorted(toxicity.hits(toxicity.folded_words(text), machine).values())
    assert found("You 1DІOT, 1di0ts") == [5.0, 5.0]
    assert found("an ass, a class, assume") == [3.0]
    assert found("he is a wise ass") == [] and found("ass wise ass") == [3.0]
    assert found("") == [] and found("vidiot") == [] and found("id​iot") == [5.0]


def test_toxicity_of_awkward_rows(spark):
    docs, labels = labelled(spark, 100)
    odd = spark.createDataFrame([(None, 1, 1), (3, None, None), (99999, 1, 1), (1, 0, 1), (1, 0, 0)], labels.schema)
    got = toxicity.scored(awkward(spark), labels.unionAll(odd)).collect()
    assert len(got) == awkward(spark).count() and all(r.score is not None for r in got)
    assert toxicity.scored(empty(spark), labels).count() == 0
    none = toxicity.scored(docs, labels.where("false")).collect()
    assert {r.predicted for r in none} == {0}
    assert toxicity.keep_harmless(awkward(spark), labels).columns == awkward(spark).columns


# --- attribution ------------------------------------------------------------------


def test_attribution_equals_brute_force(spark):
    texts = ["one two\nthree\n\n\n four", "äöü 語語\n🙂🙂 x\r\n\n", "\n", "no line feed", "a\n\n\n\n\nb" * 30]
    spans = attribution.encoder(attribution.VOCABULARY)
    got = {}
    for r in attribution.attributed(documents(spark, list(enumerate(texts)))).collect():
        got.setdefault(r.doc_id, {})[r.section] = (r.start, r.stop, r.n_tokens, r.n_crossing)
    for i, text in enumerate(texts):
        tokens, sections = spans(text), attribution.lines(text)
        assert "".join(text[a:b] for a, b in sections) == text
        held, crossing = Counter(), Counter()
        for a, b in zip(tokens.start.tolist(), tokens.end.tolist(), strict=True):
            overlap = [min(b, d) - max(a, c) for c, d in sections]
            best = overlap.index(max(overlap))
            held[best] += 1
            crossing[best] += sum(x > 0 for x in overlap) > 1
        assert got[i] == {k: (*s, held[k], crossing[k]) for k, s in enumerate(sections)}
        assert sum(held.values()) == len(tokens.start)
    assert any(x[3] for doc in got.values() for x in doc.values())


def test_tokens_cover_the_text():
    spans = attribution.encoder(attribution.VOCABULARY)
    for text in ("", "plain words", "語 and 🙂!", "é" * 9):
        tokens = spans(text)
        covered = set()
        for a, b in zip(tokens.start.tolist(), tokens.end.tolist(), strict=True):
            covered |= set(range(a, b))
        assert covered == set(range(len(text)))


def test_tokens_outside_of_sections_and_ties():
    tokens = attribution.Tokens(np.array([0, 3, 5, 9]), np.array([3, 5, 9, 12]))
    section, crossing = attribution.allot(tokens, [(0, 4), (4, 7), (11, 20)])
    assert section.tolist() == [0, 0, 1, 2] and crossing.tolist() == [False, True, True, True]
    assert attribution.allot(tokens, [])[0].tolist() == [-1] * 4
    gap = attribution.allot(tokens, [(9, 12)])
    assert gap[0].tolist() == [-1, -1, -1, 0] and not gap[1].any()


def test_attribution_of_awkward_rows(spark):
    got = attribution.attributed(awkward(spark)).collect()
    want = Counter()
    for r in awkward(spark).collect():
        want[r.doc_id] += len(attribution.lines(r.text or ""))
    assert Counter(r.doc_id for r in got) == +want
    assert attribution.attributed(empty(spark)).count() == 0
    some = attribution.attributed(documents(spark, [(1, "ab cd ef")]), sections=lambda text: [(0, 2)]).collect()
    every = len(attribution.encoder(attribution.VOCABULARY)("ab cd ef").start)
    assert {(r.section, r.start, r.n_tokens) for r in some} == {(-1, None, every - 1), (0, 0, 1)}


# --- licences ---------------------------------------------------------------------


def test_licenses(spark):
    rng = random.Random(3)
    notices = {
        0: ("This project is licensed under the Apache License, Version 2.0.", "apache-2.0"),
        1: ("Released under the MIT License.", "mit"),
        2: ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"),
        3: ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
        4: ("Hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including", "mit"),
        5: ("The driver's license was renewed under the new terms.", ""), 6: ("All rights reserved by the public.", ""),
    }
    rows = [(i, "\n".join(sentence(rng, 12) for _ in range(4))) for i in range(7, 120)]
    rows += [(i, f"{sentence(rng, 9)}\n{x}\n{sentence(rng, 9)}") for i, (x, _) in notices.items()]
    rows.append((200, notices[1][0] + "\n" + notices[0][0] + "\n" + notices[1][0]))
    got = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert {i: r.families for i, r in got.items() if r.families} == {
        **{i: f for i, (_, f) in notices.items() if f}, 200: "apache-2.0,mit"
    }
    assert got[200].n_confirmed == 3


def test_licenses_learn_from_every_document(spark):
    """Rare words of documents last in hash order, which a sample of 800 leaves out, have weights."""
    ids = spark.range(900).orderBy(F.xxhash64("id"), "id").toPandas()["id"].tolist()
    rows = [(i, "some common words here") for i in ids[:850]] + [(i, f"quarfle number {i}") for i in ids[850:]]
    model = licenses.fit(documents(spark, rows))
    seen = licenses.hashing().transform(spark.createDataFrame([(["quarfle"],)], "terms array<string>"))
    place = int(seen.head()["features"].indices[0])
    assert model.regression.coefficientMatrix.toArray()[0, place] > 0


def test_licenses_have_one_weight_a_feature_on_the_corpus(spark):
    """Passes over the corpus tell notices from the rest; only notices have a family to tell apart."""
    rng = random.Random(5)
    rows = [(i, "\n".join(sentence(rng, 12) for _ in range(3))) for i in range(200)]
    rows += [(300 + i, f"Released under the {name}.") for i, name in enumerate(("MIT License", "LGPL", "Apache License 2.0"))]
    kept = licenses.stored(licenses.lines(documents(spark, rows)))
    model = licenses.fit_lines(kept)
    assert model.regression.coefficientMatrix.numRows == 1
    assert model.kinds.numClasses == len(licenses.NAMES)
    notices = licenses._by_notice(model, kept.where("doc_id >= 300")).collect()
    assert len(notices) == 3 and all(r["_notice"] > 0.5 for r in notices)
    found = {r.doc_id: r for r in licenses.predicted(model, kept).collect()}
    assert {i: r.family for i, r in found.items()} == {300: "mit", 301: "lgpl", 302: "apache-2.0"}
    assert all(r["_notice"] >= found[r.doc_id].probability > 1 - r["_notice"] for r in notices)


def test_licenses_parts_by_hash_are_those_by_text(spark):
    """Hashes only say which paragraphs may have parts of a template: words, pairs, and the last word alone."""
    texts = ["LGPL", "the GPLv2", "under the mit license now", "MIT", "of the", "nothing here", "...", "word " * 300 + "mit license"]
    known = {part for _, parts in licenses._known(spark) for part in parts}
    rows = licenses.lines(documents(spark, list(enumerate(texts)))).collect()
    for r in rows:
        w = re.findall(r"[^\W_]+", texts[r.doc_id].lower())
        assert set(r.parts) == {x for x in [*w, *map(" ".join, zip(w, w[1:]))] if x in known}
        assert r.unrelated == (r.doc_id in (3, 4, 5, 6))
        assert list(r.features.indices) == sorted(set(r.features.indices))
        assert len(r.features.indices) == len(r.features["values"]) <= len({*w, *zip(w, w[1:])})
    assert len(rows) == len(texts)


def test_licenses_of_awkward_rows(spark):
    got = licenses.scan(awkward(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter({r.doc_id for r in awkward(spark).collect()})
    assert {r.families for r in got} == {""}
    assert licenses.scan(empty(spark)).count() == 0


# --- MinHash ----------------------------------------------------------------------


def shingles(text):
    w = words((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_estimate_likeness(spark):
    rng = random.Random(11)
    rows = []
    for i in range(150):
        w = sentence(rng, rng.choice([3, 8, 30, 90, 400])).split(" ")
        rows.append((3 * i + 1, " ".join(w)))
        for k in rng.sample(range(len(w)), len(w) // 40):
            w[k] = "changed"
        rows.append((3 * i + 2, " ".join(w)))
    rng.shuffle(rows)
    got = {r.doc_id: r for r in minhash.with_edits(documents(spark, rows)).collect()}
    text, ids = dict(rows), sorted(dict(rows))
    errors = []
    for i, following in zip(ids, ids[1:] + ids[:1], strict=True):
        n = len(text[i]) // 4
        edited = text[i][: len(text[i]) - n] + text[following][:n]
        assert got[i].edited_sha256 == __import__("hashlib").sha256(edited.encode()).hexdigest()
        assert got[i].n_chars == len(text[i])
        errors += [got[i].near_edited - jaccard(text[i], edited), got[i].near_next - jaccard(text[i], text[following])]
        assert (got[i].fingerprint == got[following].fingerprint) == (got[i].near_next == 1.0)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06
    assert {len(r.fingerprint) for r in got.values()} == {2 * minhash.BINS}


def test_next_of_a_repeated_id_is_one_text(spark):
    """The edit and ``near_next`` go by the same text of the next id, one that may have no words."""
    rng = random.Random(5)
    same = {i: [sentence(rng, 60) for _ in range(3)] for i in (2, 4)}
    rows = [(i, t) for i in same for t in same[i]] + [(i - 1, t) for i in same for t in same[i]] + [(6, " "), (5, " ")]
    got = minhash.with_edits(documents(spark, rows)).collect()
    by_id = {i: [r for r in got if r.doc_id == i] for i in range(1, 7)}
    for i in (1, 3):
        assert sorted(r.near_next for r in by_id[i])[-1] == 1.0 and sorted(r.near_next for r in by_id[i])[-2] < 0.5
        (like,) = [r for r in by_id[i] if r.near_next == 1.0]
        (text,) = [t for t in same[i + 1] if hashlib.sha256((t[: len(t) - len(t) // 4] + t[: len(t) // 4]).encode()).hexdigest() == like.edited_sha256]
        assert text in same[i + 1]
    assert [r.near_next for r in by_id[5]] == [1.0] and [r.near_next for r in by_id[4]] == [0.0] * 3


def test_fingerprints_of_awkward_rows(spark):
    df = awkward(spark)
    got = minhash.with_edits(df).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in df.collect())
    by_text = {}
    texts = {r.doc_id: r.text or "" for r in df.collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            assert by_text.setdefault(" ".join(texts[r.doc_id].split()), r.fingerprint) == r.fingerprint
    assert {r.near_next for r in got if r.doc_id is None} == {None}
    assert {r.fingerprint for r in got if r.doc_id in (30, 31, 32)} == {""}
    assert minhash.with_edits(empty(spark)).count() == 0
    one = minhash.with_edits(documents(spark, [(1, "a b c d e f g h")])).collect()[0]
    assert one.near_next == 1.0


# --- language model ---------------------------------------------------------------


def corpus(spark):
    """Two languages whose words never mix, with a strong order of words."""
    rng = random.Random(9)
    rows = []
    for i in range(400):
        words = [f"{'xy'[i % 2]}{k}" for k in range(30)]
        k, text = rng.randrange(30), []
        for _ in range(rng.randrange(5, 80)):
            text.append(words[k])
            k = (k + 1) % 30 if rng.random() < 0.9 else rng.randrange(30)
        rows.append((i, " ".join([*text, f"rare{i}"])))
    return documents(spark, rows)


def test_scores(spark):
    df = corpus(spark)
    got = scoring.scored(df).collect()
    text = {r.doc_id: r.text for r in df.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in text}
    count = Counter(w for i, t in text.items() if not held[i] for w in scoring.tokens(t))
    n, v = sum(count.values()), len(count)
    for r in got:
        own = scoring.tokens(text[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), n)
        assert r.n_known == sum(count[w] > 0 for w in own)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own))
    mine = [r for r in got if r.held_out]
    assert sum(r.score for r in mine) > 0.7 * sum(r.base_score for r in mine)
    again = scoring.scored(df).collect()
    assert {r.doc_id: round(r.score, 4) for r in again} == {r.doc_id: round(r.score, 4) for r in got}


def test_words_beyond_the_vocabulary_are_joined(spark, monkeypatch):
    df = corpus(spark)
    whole = {r.doc_id: r for r in scoring.scored(df).collect()}
    monkeypatch.setattr(scoring, "VOCABULARY", 20)
    for r in scoring.scored(df).collect():
        assert r.base_score == pytest.approx(whole[r.doc_id].base_score) and r.n_known == whole[r.doc_id].n_known


def small_model():
    v = scoring.Vocabulary([f"w{i}".encode() for i in range(300)], np.arange(300, 0, -1), 60_000, 500)
    layout, fixed, class_share, word_share = scoring._layout(v, np.arange(300) % 2)
    net = gru.fresh(layout, class_share, word_share)
    return v, layout, fixed, net


def test_probabilities_add_up_to_one():
    v, layout, fixed, net = small_model()
    state = np.full((1, gru.HIDDEN), 0.3, np.float32)
    every = np.arange(len(v.words) + 1)
    logs, _ = gru.outputs(net, layout, np.repeat(state, len(every), 0), every)
    assert np.exp(logs + fixed).sum() == pytest.approx(1, abs=1e-4)


def test_state_is_carried_across_windows():
    _, layout, _, net = small_model()
    rng = np.random.default_rng(0)
    documents = [rng.integers(0, 301, n) for n in (1, 7, 48, 49, 150, 500)]
    want = []
    for d in documents:
        h, x, total = np.zeros((1, gru.HIDDEN), np.float32), np.array([layout.start]), 0.0
        for w in d:
            h, _ = gru.step(net, x, h)
            total += gru.outputs(net, layout, h, np.array([w]))[0][0]
            x = layout.inputs[[w]]
        want.append(total)
    for window, batch in ((48, 256), (5, 2), (1000, 3)):
        assert gru.log_likelihoods(net, layout, documents, batch, window) == pytest.approx(want, rel=1e-4)


def test_gradients():
    _, layout, _, net = small_model()
    rng = np.random.default_rng(1)
    states, words = rng.normal(size=(40, gru.HIDDEN)).astype(np.float32), rng.integers(0, 301, 40)
    grads = gru.Net(*(np.zeros_like(x) for x in net))
    _, back = gru.outputs(net, layout, states, words, grads)
    loss = lambda n, s: -gru.outputs(n, layout, s, words)[0].astype(float).sum()
    for _ in range(5):
        i, j = rng.integers(40), rng.integers(gru.HIDDEN)
        moved = states.copy()
        moved[i, j] += 1e-2
        assert loss(net, moved) - loss(net, states) == pytest.approx(1e-2 * back[i, j], abs=2e-3)
        k = rng.integers(layout.classes)
        other = net._replace(to_class=net.to_class.copy())
        other.to_class[j, k] += 1e-2
        assert loss(other, states) - loss(net, states) == pytest.approx(1e-2 * grads.to_class[j, k], abs=1e-2)


def test_scores_of_awkward_rows(spark):
    got = scoring.scored(awkward(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in awkward(spark).collect())
    assert all(r.score < 0 for r in got) and {r.n_tokens for r in got if r.doc_id in (30, 31, 32)} == {1}
    assert scoring.scored(empty(spark)).count() == 0


def test_copies_are_averaged_by_their_words():
    rng = np.random.default_rng(0)
    nets, words = rng.normal(size=(40, 7)), rng.integers(1, 900, 40)
    rows = [scoring._copy(i, int(w), net) for i, (w, net) in enumerate(zip(words, nets))]
    want = (nets * words[:, None]).sum(0) / words.sum()
    table = pa.Table.from_batches(rows)
    at_once = scoring._averaged(table).to_pylist()[0]
    assert at_once["words"] == words.sum() and at_once["net"] == pytest.approx(want, abs=1e-6)
    shuffled = table.take(pa.array(rng.permutation(40)))
    assert scoring._averaged(shuffled).to_pylist()[0]["net"] == at_once["net"]
    # In levels of 16 it is the same.
    level = pa.concat_tables([scoring._averaged(table.slice(at, 16)) for at in range(0, 40, 16)])
    assert level.num_rows == 3 and scoring._averaged(level).to_pylist()[0]["net"] == pytest.approx(want, abs=1e-6)


def test_every_training_word_trains_the_network(spark, monkeypatch):
    monkeypatch.setattr(scoring, "CHUNK_WORDS", 500)
    docs = corpus(spark).unionAll(documents(spark, [(None, "x1 x2"), (7, None)]))
    model = scoring.fit(docs, scoring.counts(docs))
    assert model.trained == model.vocabulary.all_words > 500


def test_more_copies_than_one_task_averages(spark, monkeypatch):
    """With levels of two copies the network is the same but for rounding."""
    docs = documents(spark, [(i, sentence(random.Random(i), 60)) for i in range(400)])
    monkeypatch.setattr(scoring, "SHARE", 1)
    want = {r.doc_id: r.score for r in scoring.scored(docs).collect()}
    monkeypatch.setattr(scoring, "FAN", 2)
    got = {r.doc_id: r.score for r in scoring.scored(docs).collect()}
    assert got == pytest.approx(want, rel=1e-4) and len(set(got.values())) > 300


def test_tokens_of_a_batch_are_those_of_each_text():
    every = ["", " ", "  A\x0bb C\x0c\x0d", "x", "x ", "\ttab\nnew  Two\x1c\x1d", "Ä\xa0y\x85z q İΣ", "\x00 \x00"]
    for chosen in (every, every[:1], []):
        found, starts = scoring._tokens(pa.array(chosen, pa.string()))
        want = [scoring.tokens(x) for x in chosen]
        assert found.to_pylist() == sum(want, [])
        assert starts.tolist() == [sum(map(len, want[:i])) for i in range(len(want))]
        numbers = scoring._documents(pa.array(chosen, pa.string()), scoring._numbering([b"x", b"", b"b"]))
        assert [d.tolist() for d in numbers] == [[{"x": 0, "": 1, "b": 2}.get(w, 3) for w in d] for d in want]


def numbered(spark, docs):
    words = scoring.vocabulary(scoring.counts(docs), scoring.VOCABULARY).words
    return words, scoring._numbered(docs, words)


def test_words_are_grouped_by_all_documents(spark):
    """Also words of the last of many documents, of one without an id, and of a long one have their language's group."""
    rng = random.Random(13)
    common = [[f"{x}{k}" for k in range(20)] for x in "xy"]
    text = lambda i, n, *more: " ".join([*rng.choices(common[i % 2], k=n), *more])
    rows = [(i, text(i, 30, f"own{i % 2}{i // 100}")) for i in range(2600)]
    rows += [(None, text(0, 30, "noid")), (None, text(0, 30, "noid")), (9000, text(1, 150_000, "long", "long"))]
    words, every = numbered(spark, documents(spark, rows))
    group = dict(zip(words, scoring._word_groups(every, len(words), 2)))
    assert {group[f"x{k}".encode()] for k in range(20)} == {group[b"x0"]} != {group[b"y0"]}
    assert {group[f"own0{k}".encode()] for k in range(26)} | {group[b"noid"]} == {group[b"x0"]}
    assert {group[f"own1{k}".encode()] for k in range(26)} | {group[b"long"]} == {group[b"y0"]}


def test_places_of_words_are_those_of_their_documents(spark, monkeypatch):
    monkeypatch.setattr(scoring, "MARKS", 12)
    rng = random.Random(14)
    rows = [(i, sentence(rng, rng.randrange(1, 60))) for i in range(300)] + [(300, None), (None, "a b c")]
    docs = documents(spark, rows)
    words, every = numbered(spark, docs)
    number = {w.decode(): k for k, w in enumerate(words)}
    own = [[number[w] for w in scoring.tokens(t or "")] for _, t in rows]
    x = np.sqrt([[d.count(k) for k in range(12)] for d in own])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)
    x -= x.mean(0)
    _, axes = np.linalg.eigh(x.T @ x)
    x = x @ axes[:, -scoring.AXES :]
    want = np.array([sum(x[i] for i, d in enumerate(own) if k in d) for k in range(len(words))])
    got, seen = scoring._places(every, len(words))
    assert seen.tolist() == [sum(k in d for d in own) for k in range(len(words))]
    assert np.abs(got) == pytest.approx(np.abs(want), abs=2e-2)  # an axis may point either way
    again, _ = scoring._places(scoring._numbered(docs.repartition(7), words), len(words))
    assert (again == got).all()


def test_streams_hold_every_word():
    _, layout, _, _ = small_model()
    documents = [np.arange(5), np.arange(100, 170), np.arange(200, 228)]
    inputs, words, begins = gru.streams(documents, layout, 4)
    assert words.shape == (4, 26) and words.ravel().tolist() == [*np.concatenate(documents), 0]
    assert np.nonzero(begins.ravel())[0].tolist() == [0, 5, 75, 103]
    assert inputs.ravel()[[0, 5, 75, 103]].tolist() == [layout.start] * 4
    assert (inputs.ravel()[1:5] == layout.inputs[:4]).all()
