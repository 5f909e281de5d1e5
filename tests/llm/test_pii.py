import hashlib
import random
import re

import numpy as np
from plain import awkward, documents, empty

from gaugeworks.llm import pii

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    good = (
        lambda m: True, lambda m: all(int(x) <= 255 for x in m.split(".")),
        lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m)), lambda m: 9 <= len(digits(m)) <= 15,
    )
    found = [(m.start(), m.end(), k) for k in range(4) for m in re.finditer(PATTERNS[k], text) if good[k](m[0])]
    return sorted(found, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(0)
    pieces = ["a", "b.c", "@", "@@", ".", "..", "-", "+", "+1", " ", "(", ")", "1", "22", "255", "256", "0.0.0.0",
              "4111111111111111", "4111 1111 1111 1111", "x@y.z", "é", "\n", "_", "%", "+49 (30) 123-4567", "999"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + "(" * 200_000, "1 " * 100_000, "a@" * 100_000):
        pii.base_spans(text)


def corpus(spark):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        phone = f"+1 ({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
        rows.append((i, f"Call the office at {phone} before noon. Version 2.{i} has {rng.randrange(99)} pages."))
    number = "(555) 867-5309"
    rows.append((500, f"Reach us at +1 {number} now.\n" + "some words in between " * 50 + f"\nAgain: {number} today."))
    return documents(spark, rows)


def test_field_adds_a_number_seen_before_with_its_prefix(spark):
    rows = {r.doc_id: r for r in pii.marked(corpus(spark)).collect()}
    text = {r.doc_id: r.text for r in corpus(spark).collect()}
    found = rows[500]
    spans = [(k, text[500][int(a) : int(b)]) for k, a, b in (s.split(":") for s in found.spans.split(","))]
    assert ("phone", "(555) 867-5309") in spans and ("phone", "+1 (555) 867-5309") in spans
    assert found.n_phone == 1 and found.n_added == 1
    assert all(r.n_added == 0 for i, r in rows.items() if i != 500)


def test_evidence_reaches_every_occurrence(spark):
    number = "(555) 867-5309"
    bare = (f"Again: {number} today. " + "some words in between " * 5) * 50
    many = corpus(spark).unionAll(documents(spark, [(501, f"{bare}Reach us at +1 {number} now. {bare}")]))
    rows = {r.doc_id: r for r in pii.marked(many).collect()}
    assert rows[501].n_phone == 1 and rows[501].n_added == 100
    assert rows[500].n_added == 1 and all(r.n_added == 0 for i, r in rows.items() if i < 500)


def test_many_bare_repeats_do_not_outvote_evidence():
    text = "x 8675309 " * 50 + "+1 (555) 867-5309 " + "x (555) 867-5309 " * 50
    graph = pii.graph_of(text, pii.base_spans(text))
    zero = pii.learn(np.zeros((0, pii.SLOTS), int), *(np.zeros(0, int),) * 3, np.zeros((0, pii.LABELS)))
    away = np.zeros_like(zero.unary)
    away[:, pii.OUTSIDE] = 0.05  # of each feature
    p = pii.marginals(graph, zero._replace(unary=away))[graph.label < 0]
    assert (p[50:].argmax(1) == 3).all() and np.ptp(p[50:, 3]) < 1e-3


def test_messages_make_repeated_tokens_agree():
    text = "+1 (555) 867-5309 " + "word " * 20 + "(555) 867-5309"
    graph = pii.graph_of(text, pii.base_spans(text))
    zero = pii.learn(np.zeros((0, pii.SLOTS), int), *(np.zeros(0, int),) * 3, np.zeros((0, pii.LABELS)))
    apart = zero._replace(skip=np.zeros_like(zero.skip))
    alone, linked = pii.marginals(graph, apart), pii.marginals(graph, zero)
    assert np.allclose(alone[-1], 1 / pii.LABELS) and linked[-1].argmax() == 3 and linked[-1, 3] > 0.8


def test_marginals_are_exact_on_a_tree():
    text = "1a 2b 3c x 1a"
    graph = pii.graph_of(text, [])
    rng = np.random.default_rng(1)
    w = pii.Weights(rng.normal(size=(pii.BUCKETS, pii.LABELS)) / 3, rng.normal(size=(5, 5)), np.diag(rng.normal(size=5)))
    unary = w.unary[graph.features].sum(1)
    edges = [(a, b, w.chain) for a, b in graph.chain] + [(a, b, w.skip) for a, b in graph.skip]
    want = np.zeros_like(unary)
    for labels in np.ndindex(*(5,) * len(unary)):
        p = np.exp(sum(unary[i, x] for i, x in enumerate(labels)) + sum(m[labels[a], labels[b]] for a, b, m in edges))
        for i, x in enumerate(labels):
            want[i, x] += p
    assert len(edges) == 3
    assert np.allclose(pii.marginals(graph, w), want / want.sum(1, keepdims=True), atol=1e-3)


def test_awkward_rows(spark):
    df = awkward(spark)
    got = pii.marked(df).collect()
    assert len(got) == df.count()
    assert {r.base_sha256 for r in got} == {hashlib.sha256(b"").hexdigest()} and {r.spans for r in got} == {""}
    assert pii.marked(empty(spark)).count() == 0


def test_redacted_documents(spark):
    df = documents(spark, [(1, "mail a.b@c.de or 10.0.0.1, card 4111 1111 1111 1111!"), (2, None), (3, "")])
    got = {r.doc_id: r for r in pii.without_personal_data(df).collect()}
    assert got[1].text == "mail [email] or [ip], card [card]!" and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[3].text == ""
    assert pii.without_personal_data(awkward(spark)).columns == awkward(spark).columns
