"""Personal data by patterns and a skip-chain conditional random field (operator 1).

Base spans come from four patterns, checked as their kind demands. They stay as
they are. A conditional random field over the tokens of the document adds spans
the patterns miss, such as a number written without its prefix.

Nodes are the tokens that hold a digit or ``@``; every other token is known to be
outside, so the chain falls apart there and nothing is lost by leaving it out.
Chain edges join neighbouring nodes. Skip edges join tokens that are equal, or
whose digits are equal, wherever in the document they stand: each occurrence is
linked to one that a base span marks, or to the first one if none is marked. So a
token that occurs n times has n - 1 edges, not n * n, and no two occurrences are
more than two links apart. Loopy belief propagation passes messages along both
kinds until they settle; tokens of base spans are evidence, which no message
changes, so it reaches the last occurrence as strongly as the first.

Weights are learnt by pseudo-likelihood from base spans of a bounded sample
(``TRAIN_DOCS`` documents in hash order, ``TRAIN_NODES`` nodes); marking reads
every text whole.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import columns, texts

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
LABELS = len(KINDS) + 1

#: Documents and nodes that the weights are learnt from, at most.
TRAIN_DOCS, TRAIN_NODES = 2_000, 40_000
BUCKETS = 1 << 12
#: Messages settle when none changes by more than SETTLED; loops that never do end after ROUNDS.
ROUNDS, DAMPING, SETTLED = 500, 0.5, 1e-5
#: A token is marked if its kind is at least so likely.
SURE = 0.9
#: How much more likely linked tokens agree, before anything is learnt.
AGREEMENT = 3.0
#: Log-odds that the tokens of base spans get for their kind.
EVIDENCE = 8.0

Span = tuple[int, int, int]  # start, end, kind

# --- base spans -------------------------------------------------------------------

# Each pattern takes time in proportion to the text. Digits are taken whole, since a
# match that starts or stops inside a run of digits can't differ from one that doesn't.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+$")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")


def emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done, 0
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    double = sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])
    return (double + sum(map(int, digits[::-2]))) % 10 == 0


def _card(digits: str) -> bool:
    return 12 <= len(digits) <= 19 and luhn(digits)


def _ip(found: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in found.split("."))


def base_spans(text: str) -> list[Span]:
    """Of each kind leftmost first and not overlapping; by start, then kind."""
    out = list(emails(text)) if "@" in text else []
    out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if _ip(m[0])]
    out += [(m.start(), m.end(), 2) for m in CARD.finditer(text) if m.end() - m.start() >= 12 and _card(NOT_DIGIT.sub("", m[0]))]
    if "+" in text:
        out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


# --- nodes and edges --------------------------------------------------------------

TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
NODE = re.compile(r"[0-9@]")
EDGE_SIGNS = ".,;:!?\"'<>[]{}*#$&|"
RUN = re.compile(r"[0-9]+|[^\W\d_]+")


class Graph(NamedTuple):
    """The nodes of one document or of several, one after another."""

    start: np.ndarray
    end: np.ndarray
    label: np.ndarray  # of base spans, -1 elsewhere
    features: np.ndarray  # (nodes, feature slots)
    chain: np.ndarray  # (edges, 2)
    skip: np.ndarray


def shape(token: str, exact: bool) -> str:
    """Runs of digits and letters by their kind, and their lengths if ``exact``."""
    return RUN.sub(lambda m: ("9" if m[0][0].isdigit() else "a") * (len(m[0]) if exact and m[0][0].isdigit() else 1), token)[:40]


SLOTS = 9


def _features(core: str, before: str, after: str) -> list[int]:
    digits = len(NOT_DIGIT.sub("", core))
    names = (
        "bias", f"x{shape(core, True)}", f"s{shape(core, False)}", f"n{min(digits, 20)}", f"@{'@' in core}",
        f"b{before}", f"a{after}", f"p{core[:1]}{core[-1:]}" if not core[:1].isalnum() else "p", f"v{core.count('.')}",
    )
    return [zlib.crc32(x.encode()) % BUCKETS for x in names]


def _skip_edges(found: list[int], label: list[int]) -> Iterator[tuple[int, int]]:
    """One edge for each occurrence but one: to the marked one before it, or the first marked one, or the first."""
    hub = next((n for n in found if label[n] >= 0), found[0])
    for n in found:
        if n != hub:
            yield min(hub, n), max(hub, n)
        if n > hub and label[n] >= 0:
            hub = n


def graph_of(text: str, base: list[Span]) -> Graph | None:
    """None if no token has a digit or ``@``."""
    if not NODE.search(text):
        return None
    tokens = [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(text)]
    nodes = [i for i, t in enumerate(tokens) if NODE.search(t[2])]
    start, end, label, features, chain = [], [], [], [], []
    seen: dict[str, list[int]] = {}
    k = 0
    for n, i in enumerate(nodes):
        a, b, token = tokens[i]
        left = len(token) - len(token.lstrip(EDGE_SIGNS))
        core = token.strip(EDGE_SIGNS) or token
        a, b = (a + left, a + left + len(core)) if core is not token else (a, b)
        while k < len(base) and base[k][1] <= a:
            k += 1
        label.append(next((s[2] for s in base[k : k + 4] if s[0] < b and s[1] > a), -1))
        start.append(a)
        end.append(b)
        near = [shape(tokens[j][2], True) if 0 <= j < len(tokens) else "" for j in (i - 1, i + 1)]
        features.append(_features(core, *near))
        if n and nodes[n - 1] == i - 1:
            chain.append((n - 1, n))
        digits = NOT_DIGIT.sub("", core)
        for key in {f"t{core.lower()}", f"d{digits}" if len(digits) >= 7 else f"t{core.lower()}"}:
            seen.setdefault(key, []).append(n)
    skip = sorted({edge for found in seen.values() if len(found) > 1 for edge in _skip_edges(found, label)})
    pairs = [np.array(x, np.int64).reshape(-1, 2) for x in (chain, skip)]
    return Graph(np.array(start), np.array(end), np.array(label), np.array(features), *pairs)


def joined(graphs: list[Graph]) -> tuple[Graph, np.ndarray]:
    """One graph of many, and where each begins. Nothing links two documents."""
    at = np.cumsum([0, *(len(g.start) for g in graphs)])
    parts = [np.concatenate([getattr(g, f) for g in graphs]) for f in Graph._fields[:4]]
    edges = [np.concatenate([getattr(g, f) + a for g, a in zip(graphs, at, strict=False)]) for f in Graph._fields[4:]]
    return Graph(*parts, *edges), at


# --- model ------------------------------------------------------------------------


class Weights(NamedTuple):
    unary: np.ndarray  # (BUCKETS, LABELS)
    chain: np.ndarray  # (LABELS, LABELS)
    skip: np.ndarray


def _scores(w: Weights, features, left, right, skips):
    """Scores of each node's labels given the labels around it; LABELS stands for none."""
    pad = lambda m: np.vstack([m, np.zeros(LABELS)])
    return w.unary[features].sum(1) + pad(w.chain)[left] + pad(w.chain.T)[right] + skips @ w.skip


def learn(features, label, left, right, skips, passes: int = 25, rate: float = 0.3) -> Weights:
    """Pseudo-likelihood by AdaGrad over shuffled blocks of nodes, drawn to agreement of linked tokens."""
    prior = Weights(np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), AGREEMENT * np.eye(LABELS))
    w = Weights(*(x.copy() for x in prior))
    sums = Weights(*(np.full(x.shape, 1e-6) for x in w))
    random = np.random.default_rng(0)
    for _ in range(passes if len(label) else 0):
        order = random.permutation(len(label))
        for at in range(0, len(order), 512):
            i = order[at : at + 512]
            z = _scores(w, features[i], left[i], right[i], skips[i])
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(i)), label[i]] -= 1
            grads = [np.zeros_like(x) for x in w]
            np.add.at(grads[0], features[i].ravel(), np.repeat(p, features.shape[1], 0))
            for side, turned in ((left[i], False), (right[i], True)):
                has = side < LABELS
                part = np.zeros((LABELS, LABELS))
                np.add.at(part, side[has], p[has])
                grads[1] += part.T if turned else part
            grads[2] += skips[i].T @ p
            for x, s, g, to in zip(w, sums, grads, prior, strict=True):
                g = g / len(i) + 1e-4 * (x - to)
                s += g * g
                x -= rate * g / np.sqrt(s)
    # Agreement along a skip edge holds in both directions.
    return w._replace(skip=(w.skip + w.skip.T) / 2)


def marginals(g: Graph, w: Weights) -> np.ndarray:
    """Label probabilities of each node by loopy sum-product with damping, until the messages settle.

    A message is computed again only while what it follows from still changes.
    """
    unary = w.unary[g.features].sum(1)
    known = g.label >= 0
    unary[known] = EVIDENCE * np.eye(LABELS)[g.label[known]]
    edges = np.concatenate([g.chain, g.skip])
    belief = unary
    if len(edges):
        m = len(edges)
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
        is_chain = np.arange(m) < len(g.chain)
        forth = np.where(is_chain[:, None, None], w.chain, w.skip)
        pair = np.concatenate([forth, forth.transpose(0, 2, 1)])
        message = np.zeros((2 * m, LABELS))
        moving = ~known[target]  # evidence takes no messages
        for _ in range(ROUNDS):
            i = np.nonzero(moving)[0]
            if not len(i):
                break
            out = (belief[source[i]] - message[back[i]])[:, :, None] + pair[i]
            top = out.max(1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
            new -= new.max(1, keepdims=True)
            message[i] = DAMPING * message[i] + (1 - DAMPING) * new
            change = np.zeros(2 * m)
            change[i] = np.abs(new - message[i]).max(1)
            belief = unary.copy()
            np.add.at(belief, target, message)
            unsettled = change > SETTLED
            stirred = np.zeros(len(unary), bool)
            stirred[target[unsettled]] = True
            moving = (unsettled | stirred[source]) & ~known[target]
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _fits(kind: int, text: str) -> bool:
    """A run that the field marks must have the form of its kind, if loosely."""
    digits = len(NOT_DIGIT.sub("", text))
    if kind == 0:
        return "@" in text.strip("@")
    if kind == 1:
        return text.count(".") == 3 and digits >= 4
    letters = any(x.isalpha() for x in text)
    return not letters and (12 <= digits <= 19 if kind == 2 else 7 <= digits <= 15)


def added_spans(text: str, base: list[Span], g: Graph, p: np.ndarray) -> list[Span]:
    """Runs of neighbouring nodes that are surely of one kind and touch no base span."""
    label = np.where(p[:, :OUTSIDE].max(1) >= SURE, p[:, :OUTSIDE].argmax(1), OUTSIDE)
    label[g.label >= 0] = OUTSIDE
    follows = set(map(tuple, g.chain.tolist()))
    out: list[Span] = []
    run: list[int] = []
    for n in [*np.nonzero(label != OUTSIDE)[0].tolist(), -1]:
        if run and (n < 0 or label[n] != label[run[-1]] or (run[-1], n) not in follows):
            a, b, kind = int(g.start[run[0]]), int(g.end[run[-1]]), int(label[run[0]])
            if _fits(kind, text[a:b]):
                out.append((a, b, kind))
            run = []
        run.append(n)
    taken = sorted(base)
    ends = np.array([s[1] for s in taken])
    # Base spans of one kind don't overlap, so few begin between the first that ends behind and the last before.
    return [s for s in out if not any(t[0] < s[1] and t[1] > s[0] for t in taken[_first(ends, s[0]) :][:8])]


def _first(ends: np.ndarray, start: int) -> int:
    behind = np.maximum.accumulate(ends) if len(ends) else ends
    return int(np.searchsorted(behind, start, side="right"))


def find(values: Iterable[str], w: Weights) -> list[tuple[list[Span], list[Span]]]:
    """Base and added spans of each text; the documents' graphs run side by side."""
    values = list(values)
    bases = [base_spans(x) for x in values]
    graphs = [graph_of(x, b) for x, b in zip(values, bases, strict=True)]
    have = [i for i, g in enumerate(graphs) if g is not None]
    added: dict[int, list[Span]] = {}
    if have:
        whole, at = joined([graphs[i] for i in have])
        p = marginals(whole, w)
        for k, i in enumerate(have):
            added[i] = added_spans(values[i], bases[i], graphs[i], p[at[k] : at[k + 1]])
    return [(b, added.get(i, [])) for i, b in enumerate(bases)]


# --- Spark ------------------------------------------------------------------------


def train(docs: DataFrame) -> Weights:
    """Weights from a bounded sample of ``docs``; zero, so nothing is added, if it has no nodes."""
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    chosen = F.broadcast(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS))  # that many longs

    def nodes(batches):
        for _, values in columns(batches):
            rows = []
            for text in values:
                if (g := graph_of(text, base_spans(text))) is None:
                    continue
                label = np.where(g.label < 0, OUTSIDE, g.label)
                left, right = np.full(len(label), LABELS), np.full(len(label), LABELS)
                left[g.chain[:, 1]], right[g.chain[:, 0]] = label[g.chain[:, 0]], label[g.chain[:, 1]]
                skips = np.zeros((len(label), LABELS))
                np.add.at(skips, (g.skip[:, 1], label[g.skip[:, 0]]), 1)
                np.add.at(skips, (g.skip[:, 0], label[g.skip[:, 1]]), 1)
                # What a marked token's unmarked like is, is not known.
                skips[label != OUTSIDE, OUTSIDE] = 0
                # A token that no pattern marks, though its like elsewhere is marked, teaches neither way.
                clear = (label != OUTSIDE) | (skips[:, :OUTSIDE].sum(1) == 0)
                rows += np.column_stack([g.features, label, left, right, skips])[clear].astype(int).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], ["row"])

    seen = texts(docs).join(chosen, "doc_id").mapInArrow(nodes, "row array<int>")
    table = seen.orderBy(F.xxhash64("row"), "row").limit(TRAIN_NODES).toArrow()
    if not table.num_rows:
        return learn(np.zeros((0, SLOTS), int), *(np.zeros(0, int),) * 3, np.zeros((0, LABELS)))
    rows = table.column("row").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    return learn(rows[:, :SLOTS], rows[:, SLOTS], rows[:, SLOTS + 1], rows[:, SLOTS + 2], rows[:, SLOTS + 3 :].astype(float))


def named(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def marked(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts and digest of the base spans, and all spans, of every row of ``docs``.

    Null and empty texts have no spans; their digest is that of the empty string.
    Repeated rows give repeated results, a null ``doc_id`` stays null, an empty
    table gives no rows. Other columns are not read.
    """
    w = train(docs)

    def mark(batches):
        for ids, values in columns(batches, 500):
            found = find(values, w)
            counts = np.array([[sum(s[2] == k for s in base) for k in range(OUTSIDE)] for base, _ in found])
            every = [named(sorted(b + a, key=lambda s: (s[0], s[2], s[1]))) for b, a in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    *(pa.array(counts[:, k], pa.int64()) for k in range(OUTSIDE)),
                    pa.array([hashlib.sha256(named(b).encode()).hexdigest() for b, _ in found]),
                    pa.array(every, pa.string()),
                    pa.array([len(a) for _, a in found], pa.int64()),
                ],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    schema = f"doc_id long, {counts}, base_sha256 string, spans string, n_added long"
    return texts(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(mark, schema)


def redact(text: str, spans: list[Span]) -> str:
    """Each span becomes ``[kind]``; of spans that overlap, one mark stands for all."""
    out, done = [], 0
    for a, b, kind in sorted(spans):
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind]}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redacted(text: Column, w: Weights) -> Column:
    """The text without its personal data; null stays null."""

    @F.pandas_udf("string")
    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            out = []
            for at in range(0, len(part), 500):
                values = part.iloc[at : at + 500].tolist()
                found = find([x or "" for x in values], w)
                out += [x and redact(x, base + added) for x, (base, added) in zip(values, found, strict=True)]
            yield pd.Series(out, dtype=object)

    return clean(text)


def without_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with redacted texts and their new lengths; all columns are kept.

    Each row is redacted by itself, whether its id is null or repeated; a null text
    stays null, and an empty table stays empty. ``n_chars`` is counted anew where the
    table has it.
    """
    out = docs.withColumn("text", redacted(F.col("text"), train(docs)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
