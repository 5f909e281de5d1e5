"""Toxicity by a weighted lexicon and an Aho-Corasick automaton (operator 8).

Texts are lower-cased and folded first: letters of other scripts that look like
Latin ones, full-width forms, and digits or signs that stand for letters become
the letters they imitate, and invisible characters go. Of the folded text, the
runs of letters are the words, joined by single spaces.

The lexicon holds stems, found where a word begins, and whole words. Of the
entries that fit at one word the heaviest counts. Exception phrases of two words
cancel what begins inside them. The weights found are summed up, related to the
number of words, and turned into a probability.

All of that is learnt from labelled rows. Their number is bounded
(``SAMPLE`` per class, taken in hash order), so the fit costs the same at any
size; scoring reads every text. The support of an entry is counted over groups
of texts, not texts: copies of one text would make each of its words look toxic.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import columns, fold_of, texts
from gaugeworks.session import stage

#: Labelled texts of either class that the fit uses at most.
SAMPLE = 3_000
#: Entries, and exception phrases, that the lexicon has at most.
ENTRIES = 2_000
STEMS = range(4, 9)
#: An entry needs so many groups, so large a log ratio, and so large a G statistic.
MIN_SUPPORT, MIN_WEIGHT, MIN_G = 3, 2.5, 16.0
#: A phrase is an exception from so many harmless groups on, without a toxic one.
MIN_EXCEPTION = 3
THRESHOLD = 0.3

# Letters of other scripts and signs, and the Latin letters they look like.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ł": "l", "ø": "o",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i",
}
FOLD = {ord(k): v for k, v in LOOKALIKES.items()}
FOLD |= {0xFF01 + k: FOLD.get(0x21 + k, chr(0x21 + k).lower()) for k in range(94)}  # full-width forms
FOLD |= dict.fromkeys((0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF))  # invisible
LETTERS = re.compile(r"[^\W\d_]+")


class Model(NamedTuple):
    """Entries ``(text, is_stem, weight)``, exception phrases, and the logistic curve."""

    entries: list[tuple[str, bool, float]]
    exceptions: list[str]
    curve: tuple[float, float, float]


# --- matching ---------------------------------------------------------------------


def folded_words(text: str) -> list[str]:
    return LETTERS.findall(text.lower().translate(FOLD))


def automaton(model: Model) -> ahocorasick.Automaton | None:
    found: dict[str, tuple[int, float]] = {}
    for text, is_stem, weight in model.entries:
        pattern = f" {text}" if is_stem else f" {text} "
        found[pattern] = (len(pattern), weight)
    for phrase in model.exceptions:
        found[f" {phrase} "] = (len(phrase) + 2, 0.0)
    out = ahocorasick.Automaton()
    for pattern, payload in found.items():
        out.add_word(pattern, payload)
    if not len(out):
        return None
    out.make_automaton()
    return out


def hits(words: list[str], machine) -> dict[int, float]:
    """Offset in the joined words -> weight, without what exceptions cancel."""
    if machine is None or not words:
        return {}
    found: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight) in machine.iter(f" {' '.join(words)} "):
        start = end - length + 1
        if not weight:
            spared.append((start, end))
        elif weight > found.get(start, 0.0):
            found[start] = weight
    for a, b in spared:  # the closing blank opens the next word
        for start in [x for x in found if a <= x < b]:
            del found[start]
    return found


def evidence(text: str, machine) -> tuple[float, float]:
    """Weight found, and weight found per thousand words, both on a log scale."""
    words = folded_words(text)
    total = sum(hits(words, machine).values())
    return math.log1p(total), math.log1p(1000 * total / max(1, len(words)))


def probability(x: tuple[float, float], curve: tuple[float, float, float]) -> float:
    z = curve[0] + curve[1] * x[0] + curve[2] * x[1]
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def score(text: Column, model: Model) -> Column:
    """Probability, 0 to 1, that a text is toxic; a null text counts as empty."""

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = automaton(model)
        for part in parts:
            yield pd.Series([probability(evidence(x or "", machine), model.curve) for x in part], dtype="float64")

    return scored(text)


# --- learning ---------------------------------------------------------------------


def _group_of(words: list[str]) -> int:
    """Equal for most near copies: the least hash of the three-word shingles."""
    shingles = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    return min(xxhash.xxh64_intdigest(x) for x in shingles) >> 1


def _grouped(batches):
    for ids, values, toxic in columns(batches):
        groups = [_group_of(folded_words(x)) for x in values]
        yield pa.RecordBatch.from_pydict({"text": values, "toxic": pa.array(toxic, pa.int32()), "group": groups})


def _entries_of(words: set[str]) -> set[str]:
    out = {f"w{x}" for x in words if len(x) >= 3}
    for n in STEMS:
        out |= {f"s{x[:n]}" for x in words if len(x) >= n}
    return out


def _counted(features):
    """A mapInArrow function: how many texts of either class have each feature."""

    def count(batches):
        found: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for values, toxic in columns(batches):
            for text, y in zip(values, toxic, strict=True):
                for x in features(text):
                    found[x][y] += 1
            if len(found) > 200_000:
                yield batch(found)
                found.clear()
        yield batch(found)

    def batch(found):
        counts = list(found.values())
        return pa.RecordBatch.from_pydict(
            {
                "feature": pa.array(list(found), pa.string()),
                "clean": pa.array([c[0] for c in counts], pa.int64()),
                "toxic": pa.array([c[1] for c in counts], pa.int64()),
            }
        )

    return count


def _totals(rows: DataFrame, features) -> DataFrame:
    counts = rows.select("text", "toxic").mapInArrow(_counted(features), "feature string, clean long, toxic long")
    return counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _lexicon(single: DataFrame) -> list[tuple[str, bool, float]]:
    class_sizes = {r["toxic"]: r["n"] for r in single.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    harmless, harmful = class_sizes.get(0, 0), class_sizes.get(1, 0)
    if not harmless or not harmful:
        return []
    seen = F.col("clean") + F.col("toxic")
    expected = seen * harmful / (harmful + harmless)

    def part(count: Column, want: Column) -> Column:
        return F.when(count > 0, count * F.log(count / want)).otherwise(0.0)

    g = 2 * (part(F.col("toxic"), expected) + part(F.col("clean"), seen - expected))
    weight = F.log((F.col("toxic") + 0.5) / (harmful + 1)) - F.log((F.col("clean") + 0.5) / (harmless + 1))
    best = (
        _totals(single, lambda text: _entries_of(set(folded_words(text))))
        .where(F.col("toxic") >= MIN_SUPPORT)
        .select("feature", weight.alias("weight"), g.alias("g"))
        .where((F.col("weight") >= MIN_WEIGHT) & (F.col("g") >= MIN_G))
        .orderBy(F.desc("g"), "feature")
        .limit(ENTRIES)
        .collect()
    )
    return [(r["feature"][1:], r["feature"][0] == "s", r["weight"]) for r in best]


def _phrases(model: Model):
    """Two-word phrases around the hits of a text."""

    def phrases(text: str) -> set[str]:
        words = folded_words(text)
        found = hits(words, automaton(model))
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        out = set()
        for k in np.searchsorted(starts, sorted(found)).tolist():
            out |= {" ".join(words[a : a + 2]) for a in (k - 1, k) if 0 <= a < len(words) - 1}
        return out

    return phrases


def _curve(rows: list, prior: float) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, weighted so that ``prior`` of the rows are toxic."""
    y = np.array([r["toxic"] for r in rows], float)
    share = y.mean() if len(y) else 0.0
    if not 0 < share < 1:
        return (math.log(prior / (1 - prior)), 0.0, 0.0)
    x = np.array([[1.0, r["total"], r["density"]] for r in rows])
    w = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    ridge = np.diag([1e-6, 0.05, 0.05])
    b = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (w * p * (1 - p))[:, None]).T @ x + ridge
        b = b + np.clip(np.linalg.solve(h, x.T @ (w * (y - p)) - ridge @ b), -5, 5)
    return tuple(float(v) for v in b)


def fit(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = ()) -> Model:
    """Learn lexicon, exception phrases and curve from the rows of ``labels``.

    ``labels`` has ``doc_id`` and ``toxic``; rows with null in either are left out,
    and the larger label of an id with several counts. Without rows of both
    classes the lexicon is empty and each text scores the share of toxic rows, or
    0.0 without any. ``exceptions`` are added to those learnt.
    """
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    rows, harmful = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).head()
    if not rows:
        return Model([], [], (-500.0, 0.0, 0.0))
    picked = [
        known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for y in (0, 1)
    ]
    # At most 2 * SAMPLE rows of two numbers are broadcast.
    chosen = F.broadcast(picked[0].unionAll(picked[1]))
    sample = stage(
        texts(docs)
        .join(chosen, "doc_id")
        .select("doc_id", "text", "toxic")
        .mapInArrow(_grouped, "text string, toxic int, group long"),
        "toxicity",
    )
    single = sample.groupBy("group", "toxic").agg(F.min("text").alias("text"))
    entries = _lexicon(single)
    model = Model(entries, list(exceptions), (0.0, 0.0, 0.0))
    if entries:
        harmless = (
            _totals(single, _phrases(model))
            .where((F.col("toxic") == 0) & (F.col("clean") >= MIN_EXCEPTION))
            .orderBy(F.desc("clean"), "feature")
            .limit(ENTRIES)
            .collect()
        )
        learnt = [" ".join(folded_words(x)) for x in exceptions] + [r["feature"] for r in harmless]
        model = model._replace(exceptions=learnt)

    def measured(batches):
        machine = automaton(model)
        for values, toxic in columns(batches):
            x = np.array([evidence(t, machine) for t in values]).reshape(-1, 2)
            yield pa.RecordBatch.from_pydict(
                {"toxic": pa.array(toxic, pa.int32()), "total": pa.array(x[:, 0]), "density": pa.array(x[:, 1])}
            )

    seen = sample.select("text", "toxic").mapInArrow(measured, "toxic int, total double, density double").collect()
    prior = min(max(harmful / rows, 1e-6), 1 - 1e-6)
    return model._replace(curve=_curve(seen, prior))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    Learns from labelled rows outside fold 2 of 4. Null and empty texts have no
    hits and get the curve's value there. Repeated rows are scored alike, an empty
    table gives no rows, other columns are not read.
    """
    learn = labels.select("doc_id", "toxic").where(fold_of(4) != 2)
    model = fit(docs, learn)
    return (
        texts(docs)
        .select("doc_id", (fold_of(4) == 2).alias("held_out"), score(F.col("text"), model).alias("score"))
        .withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
    )


def keep_harmless(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all columns.

    Null texts score as empty ones. Repeated rows score alike, so all of them stay or
    go; null ids count as fold 0 and meet no label. An empty table stays empty.
    """
    model = fit(docs, labels.select("doc_id", "toxic").where(fold_of(4) != 2))
    return docs.where(score(F.col("text"), model) < THRESHOLD)
