"""Language-model scores of whole documents (operator 5).

Counts come from every training document. Words beyond the ``VOCABULARY`` most
frequent ones are looked up by a join, never broadcast.

Words of the vocabulary are grouped by the company they keep: the documents a word
occurs in are described by their most frequent words, and words with similar
documents form a group, which in practice is a language or a register. Each group
makes two classes of the output: its most frequent words, which have vectors, and
the rest, which are spread by their counts. All words beyond the vocabulary make
one more class, spread by counts plus one, so that unseen words have a share.

Words are grouped by all training documents, and the network learns from all of them, each
once. It does so in rounds that grow: in a round, each partition trains a copy on its documents
of that round, a chunk of words at a time, and the copies are averaged, weighted by their words,
for the next round to start from.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm import gru
from gaugeworks.llm.common import fold_of, texts
from gaugeworks.session import stage, staged

#: Words that are shipped to the tasks, at most.
VOCABULARY = 200_000
GROUPS, GROUP_WORDS = 16, 96
#: Frequent words that describe a document, and the main axes of their counts.
MARKS, AXES = 256, 8
#: Sums over documents are of whole numbers of this part, so that they don't depend on the order.
GRAIN = 1 << 16
#: Sixteenths of the training documents that a round trains on.
ROUNDS = (1, 1, 2, 4, 8)
#: One of so many training documents trains the network: all do.
SHARE = 1
#: Words that a task trains on at a time, streams they are laid in at most, and windows in a row at least.
CHUNK_WORDS, CHUNK_STREAMS, CHUNK_WINDOWS = 200_000, 256, 32
RATE = 0.1
#: Copies of the network that one task averages.
FAN = 16
#: Distinct words a task counts before it hands them on.
COUNT_ROWS = 400_000
END = ""  # no word is empty


def tokens(text: str) -> list[str]:
    """Words in lower case (A-Z only), then the end."""
    return [*(w.decode() for w in text.encode().lower().split()), END]


def _parts(batches: Iterable[pa.RecordBatch], rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    """A few rows of each Arrow batch at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The :func:`tokens` of all texts in a row, and where each text's begin."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    # A space at the end makes one empty word after the others; an empty text is that word already.
    ended = pc.if_else(pc.equal(pc.binary_length(trimmed), 0), trimmed, pc.binary_join_element_wise(trimmed, "", " "))
    lists = pc.ascii_split_whitespace(ended)
    return lists.flatten(), np.cumsum([0, *pc.list_value_length(lists).to_numpy()])[:-1]


# --- counts -----------------------------------------------------------------------


def counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all of ``docs``; tasks add up first what they read."""

    def count(batches):
        found, size = [], 0
        for part in _parts(batches):
            words, _ = _tokens(part.column(0))
            found.append(pa.Table.from_struct_array(pc.value_counts(words)).rename_columns(["word", "n"]))
            size += found[-1].num_rows
            if size > COUNT_ROWS:
                found = [added(found)]
                size = found[0].num_rows
                if size > COUNT_ROWS // 2:
                    yield from found[0].to_batches()
                    found, size = [], 0
        if found:
            yield from added(found).to_batches()

    def added(found):
        sums = pa.concat_tables(found).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return sums.select(["word", "n_sum"]).rename_columns(["word", "n"])

    rows = texts(docs).select("text").mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


class Vocabulary(NamedTuple):
    """The most frequent words in order, their counts, and what all words and those beyond add up to."""

    words: list[bytes]
    n: np.ndarray
    all_words: int
    all_types: int

    @property
    def beyond(self) -> int:
        """The number that stands for every other word."""
        return len(self.words)

    def base(self) -> np.ndarray:
        """log10 of the add-one probability of each word; 0 for those beyond, which a join supplies."""
        return np.append(np.log10((self.n + 1) / (self.all_words + self.all_types + 1)), 0.0)


def vocabulary(counted: DataFrame, size: int) -> Vocabulary:
    all_words, all_types = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
    least = 0
    if all_types > size:
        least = counted.agg(F.percentile_approx("n", 1 - size / all_types, 100_000)).head()[0]
    # The filter keeps about ``size`` rows, so that few are sorted.
    top = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(size).toArrow()
    words = top.column("word").cast(pa.binary()).to_pylist()
    return Vocabulary(words, top.column("n").to_numpy(), all_words, all_types)


# --- groups and layout ------------------------------------------------------------


def _described(documents: list[np.ndarray], marks: int) -> np.ndarray:
    """The mix of most frequent words of each document, in whole ``GRAIN`` parts."""
    counts = np.stack([np.bincount(d[d < marks], minlength=marks) for d in documents]).astype(float)
    root = np.sqrt(counts)
    root /= np.maximum(np.linalg.norm(root, axis=1, keepdims=True), 1e-6)
    return np.rint(root * GRAIN)


def _axes(numbered: DataFrame, marks: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of the descriptions of all documents, and the main axes around it."""
    upper = np.triu_indices(marks)

    def moments(batches):
        sums = np.zeros(1 + marks + len(upper[0]), np.int64)
        for documents in _lists(batches):
            x = _described(documents, marks)
            # At most 2,000 products of 32 bits: exact in a double.
            sums += np.concatenate([[len(x)], x.sum(0), (x.T @ x)[upper]]).astype(np.int64)
        at = np.nonzero(sums)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["at", "n"])

    rows = numbered.mapInArrow(moments, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(1 + marks + len(upper[0]))
    sums[rows.column("at").to_numpy()] = rows.column("n").to_numpy()
    documents, mean = sums[0], sums[1 : marks + 1] / max(sums[0], 1) / GRAIN
    products = np.zeros((marks, marks))
    products[upper] = sums[marks + 1 :] / GRAIN**2
    products += np.triu(products, 1).T
    _, axes = np.linalg.eigh(products - documents * np.outer(mean, mean) + 1e-9 * np.eye(marks))
    return mean, axes[:, -AXES:]


def _places(numbered: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word number, the sum of the places of the documents it occurs in, and how many they are."""
    marks = min(MARKS, size)
    mean, axes = _axes(numbered, marks)
    width = axes.shape[1]

    def places(batches):
        sums = np.zeros((size, width + 1), np.int64)  # the last column counts
        last = np.zeros(size + 1, np.int32)
        for documents in _lists(batches):
            at = np.rint((_described(documents, marks) - mean * GRAIN) @ axes).astype(np.int64)
            steps = np.arange(max(map(len, documents)), dtype=np.int32)
            for d, v in zip(documents, np.column_stack([at, np.ones(len(at), np.int64)]), strict=True):
                last[d] = steps[: len(d)]
                own = d[last[d] == steps[: len(d)]]  # each word once, where it comes last
                sums[own[own < size]] += v
        word = np.nonzero(sums[:, -1])[0]
        for low in range(0, len(word), 10_000):
            some = word[low : low + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), *map(pa.array, sums[some].T.copy())], names)

    names = ["word", *(f"x{k}" for k in range(width)), "seen"]
    rows = numbered.mapInArrow(places, ", ".join(f"{x} long" for x in names))
    rows = rows.groupBy("word").agg(*(F.sum(x).alias(x) for x in names[1:])).toArrow()  # a row for each word of the vocabulary
    word, sums = rows.column("word").to_numpy(), np.zeros((size, width + 1))
    sums[word] = np.stack([rows.column(x).to_numpy() for x in names[1:]], 1)
    return (sums[:, :-1] / GRAIN).astype(np.float32), sums[:, -1].astype(np.float32)


def _word_groups(numbered: DataFrame, size: int, groups: int) -> np.ndarray:
    """A group for each word number, by all the documents it occurs in."""
    if size == 0:
        return np.zeros(size, int)
    place, seen = _places(numbered, size)
    # Words that few documents hold stay near the mean.
    place /= (seen + 0.5)[:, None]
    weight = np.sqrt(seen + 0.1)
    centres = place[np.argsort(-weight)[:1]]
    for _ in range(min(groups, size) - 1):  # the next centre is the word that is farthest, by weight
        far = np.min([((place - c) ** 2).sum(1) for c in centres], axis=0) * weight
        centres = np.vstack([centres, place[far.argmax()]])
    for _ in range(12):
        nearest = np.argmin([((place - c) ** 2).sum(1) for c in centres], axis=0)
        for k in range(len(centres)):
            if (mine := nearest == k).any():
                centres[k] = np.average(place[mine], axis=0, weights=weight[mine])
    return nearest


class Model(NamedTuple):
    vocabulary: Vocabulary
    layout: gru.Layout
    fixed: np.ndarray  # log of each word's share in a class that spreads by counts
    net: gru.Net
    trained: int  # words that the copies of the network learnt from


def _layout(v: Vocabulary, group: np.ndarray) -> tuple[gru.Layout, np.ndarray, np.ndarray, np.ndarray]:
    """Layout, logs of fixed shares, and the shares that the first biases come from."""
    size, n = len(v.words), v.n.astype(float)
    rank = np.zeros(size, int)
    for g in np.unique(group):
        mine = np.nonzero(group == g)[0]  # the most frequent first
        rank[mine] = np.arange(len(mine))
    top = rank < GROUP_WORDS
    last = 2 * GROUPS
    word_class = np.append(2 * group + ~top, last).astype(np.int64)
    order = np.argsort(word_class[:size], kind="stable")
    order = order[top[order]]
    own = np.full(size + 1, -1)
    own[order] = np.arange(len(order))
    first = np.searchsorted(word_class[order], np.arange(last + 2))
    inputs = np.where(own >= 0, own, len(order) + word_class)
    layout = gru.Layout(word_class, own, inputs, first, len(order) + last + 2)
    beyond = v.all_words - int(v.n.sum())
    sums = np.bincount(word_class, np.append(n, beyond + 1.0), last + 1)
    within = np.append(n, 1.0) / np.maximum(sums[word_class], 1)
    fixed = np.where(own >= 0, 0.0, np.log(within))
    fixed[-1] = 0.0  # a join supplies it
    return layout, fixed, sums / sums.sum(), within[order]


def _numbering(words: list[bytes]) -> Callable[[pa.Array], np.ndarray]:
    """From tokens to their numbers in ``words``; all others share the next number."""
    known = pa.array(words, pa.binary()).cast(pa.string())

    def number(found: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(found, value_set=known.cast(found.type)), len(words)).to_numpy().astype(np.int64)

    return number


def _documents(texts: pa.Array, number: Callable[[pa.Array], np.ndarray]) -> list[np.ndarray]:
    """Each text as word numbers, the end as the last one."""
    found, starts = _tokens(texts)
    return np.split(number(found), starts[1:]) if len(starts) else []


def _numbered(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """``h``, a hash of id and text, and ``d``, the numbers of the text's words as bytes of 32-bit integers; dealt by ``h``."""

    def numbers(batches):
        number = _numbering(words)
        for part in _parts(batches):
            values = [d.astype(np.int32).tobytes() for d in _documents(part.column(1), number)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values, pa.binary())], ["h", "d"])

    rows = texts(docs).select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(numbers, "h long, d binary")
    # Hash order makes the network the same in each run.
    return rows.select(F.xxhash64("h", "d").alias("h"), "d").repartition("h").sortWithinPartitions("h", "d")


def _lists(batches: Iterable[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The word numbers of a few documents at a time."""
    for part in _parts(batches):
        yield [np.frombuffer(d.as_buffer(), np.int32) for d in part.column("d")]


def fit(docs: DataFrame, counted: DataFrame) -> Model:
    """Vocabulary, groups and network from the training documents, all of them."""
    v = vocabulary(counted, VOCABULARY)
    every = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(SHARE)) == 0)
    with staged(_numbered(every, v.words), "numbered") as numbered:
        layout, fixed, class_share, word_share = _layout(v, _word_groups(numbered.select("d"), len(v.words), GROUPS))
        net, trained, low = gru.fresh(layout, class_share, word_share), 0, 0
        copies = numbered.rdd.getNumPartitions()
        for sixteenths in ROUNDS:
            part = F.pmod("h", F.lit(16))
            mine = numbered.where((part >= low) & (part < low + sixteenths)).select("d")
            net, words = _round(mine, net, layout, copies)
            trained, low = trained + words, low + sixteenths
    return Model(v, layout, fixed, net, trained)


def _round(numbered: DataFrame, net: gru.Net, layout: gru.Layout, copies: int) -> tuple[gru.Net, int]:
    """The average of the copies that partitions train on ``numbered``, from ``net`` on, and the words they learnt from."""

    def train(batches):
        own, sums, seen = net, gru.squares(net), 0
        for documents in _chunks(d for part in _lists(batches) for d in part):
            size = sum(map(len, documents))
            rows = max(1, min(CHUNK_STREAMS, size // (gru.WINDOW * CHUNK_WINDOWS)))
            own = gru.train(own, layout, documents, passes=1, rate=RATE, sums=sums, rows=rows)
            seen += size
        if seen:
            yield _copy(TaskContext.get().partitionId(), seen, own.flat())

    trained = numbered.mapInArrow(train, _COPY)
    # Whole copies are averaged, a few at a time, level by level; a few come to the driver.
    while copies > FAN:
        trained = trained.withColumn("slot", F.expr(f"slot div {FAN}")).groupBy("slot").applyInArrow(_averaged, _COPY)
        copies = -(-copies // FAN)
    left = trained.toArrow()
    if left.num_rows:
        net = net.filled(_averaged(left).column("net")[0].values.to_numpy().astype(float))
    return net, sum(left.column("words").to_pylist())


def _chunks(documents: Iterable[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Documents in order, in lists of about ``CHUNK_WORDS`` words."""
    held, size = [], 0
    for document in documents:
        held.append(document)
        size += len(document)
        if size >= CHUNK_WORDS:
            yield held
            held, size = [], 0
    if held:
        yield held


_COPY = "slot long, words long, net array<float>"


def _copy(slot: int, words: int, net: np.ndarray) -> pa.RecordBatch:
    """A copy of the network, and how many words it has learnt from."""
    values = [pa.array([slot], pa.int64()), pa.array([words], pa.int64()), pa.array([net.astype(np.float32)], pa.list_(pa.float32()))]
    return pa.RecordBatch.from_arrays(values, ["slot", "words", "net"])


def _averaged(copies: pa.Table) -> pa.Table:
    """One copy for several, each weighing as its words; in the order of words and values, so reruns agree."""
    nets = [x.values.to_numpy() for x in copies.column("net")]
    words = copies.column("words").to_pylist()
    order = sorted(range(len(words)), key=lambda i: (words[i], nets[i].tobytes()))
    total = sum(nets[i].astype(float) * words[i] for i in order)
    return pa.Table.from_batches([_copy(copies.column("slot")[0].as_py(), sum(words), total / max(sum(words), 1))])


# --- scores -----------------------------------------------------------------------


def scored(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Both scores are log10 probabilities of the whole text and its end: of add-one
    word counts, and of the network. Null and empty texts have the end only. Without
    training documents every word is unseen and both scores are 0. Repeated rows are
    scored alike, a null ``doc_id`` is in fold 0 and stays null, an empty table gives
    no rows. Other columns are not read.
    """
    training = docs.where(fold_of(7) != 2)
    counted = stage(counts(training), "counts")
    model = fit(training, counted)
    v = model.vocabulary
    base, fixed, beyond = v.base(), model.fixed, v.beyond
    spread = v.all_words - int(v.n.sum()) + v.all_types - len(v.words) + 1  # words and types beyond, and one more

    def score(batches):
        number = _numbering(v.words)
        for part in _parts(batches):
            ids, held, values = part.columns
            found, starts = _tokens(values)
            numbers = number(found)
            documents = np.split(numbers, starts[1:])
            logs = gru.log_likelihoods(model.net, model.layout, documents)
            total = lambda x: np.add.reduceat(x, starts)
            rare = np.nonzero(numbers == beyond)[0]
            words = found.take(pa.array(rare)).to_pylist()
            ends = np.searchsorted(rare, [*starts, len(numbers)]).tolist()
            others = [list(Counter(words[i:j]).items()) for i, j in zip(ends, ends[1:])]
            n_tokens = np.diff([*starts, len(numbers)])
            pairs = pa.array(others, pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [
                    ids, held, pa.array(n_tokens), pa.array(n_tokens - np.diff(ends)),
                    pa.array(total(base[numbers])), pa.array((logs + total(fixed[numbers])) / math.log(10)), pairs,
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "others"],
            )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
        "others array<struct<word: string, times: long>>"
    )
    rows = docs.select("doc_id", "text", (fold_of(7) == 2).alias("held_out"))
    rows = texts(rows, "held_out").select(F.col("doc_id").cast("long"), "held_out", "text")
    rows = stage(rows.mapInArrow(score, schema).withColumn("row", F.monotonically_increasing_id()), "scores")

    # Words beyond the vocabulary: none is frequent, so no key of this join is hot.
    other = rows.select("row", F.explode("others").alias("o")).select("row", "o.word", "o.times")
    n = F.coalesce("n", F.lit(0))
    looked_up = other.join(counted, "word", "left").select(
        "row",
        F.when(n > 0, F.col("times")).otherwise(0).alias("n_known"),
        (F.col("times") * F.log10((n + 1) / F.lit(float(v.all_words + v.all_types + 1)))).alias("base_score"),
        (F.col("times") * F.log10((n + 1) / F.lit(float(spread)))).alias("score"),
    )
    known = rows.select("row", "n_known", "base_score", "score")
    sums = known.unionByName(looked_up).groupBy("row").agg(
        F.sum("n_known").cast("long").alias("n_known"), F.sum("base_score").alias("base_score"), F.sum("score").alias("score")
    )
    return rows.select("row", "doc_id", "held_out", "n_tokens").join(sums, "row").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(v.all_words).cast("long").alias("train_tokens"), "base_score", "score"
    )
