"""Phrases whose words stay together, counted with weighted acyclic automata.

* Each task turns some text at a time into the sorted n-grams that begin there and
  builds automata from them, a state being frozen, and merged with an equal one, as
  soon as the n-grams leave its prefix. A path carries the number of its occurrences.
* A shard's n-grams are cut into prefix ranges: bounds are pairs of words, so that a
  frequent first word is spread over several ranges. Automata of one range meet in
  one group, are united, and the weights of equal paths summed. What a phrase counts
  is the sum of the weights in the range of paths that begin with it.
* Paths below the threshold are folded into their prefix. For the parts of its
  phrases each range asks the ranges that own them, once for each part: the parts
  asked for are composed with the owner's automaton, and the counts return to the
  range that asked. A frequent word costs one line for each range that asks, not one
  for each phrase. The same message carries the count of the longest phrase around a
  part, which decides whether the part is covered.

Bounds come from a bounded sample and change balance only. Groups grow with neither
the corpus nor a hot word: the number of ranges follows the size of a language, and
beyond what the sample can bound, ranges are dealt further by a hash of the prefix.

Null texts are empty; a null language is ``und``. Ids are not used, repeated rows count
each time, ties are broken by the phrase. Languages without words, and an empty
table, have no rows. Other columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.session import stage

#: Words in a phrase, fewest occurrences of a candidate, phrases returned for a language.
LONGEST, AT_LEAST, TOP = 3, 10, 2_000
SCALE = 1_000_000
#: A candidate with 100 * f(longer) >= COVERED * f(candidate) is covered.
COVERED = 50
#: Bytes of text that a task gathers before it builds automata, and words of one automaton.
GATHER_BYTES, SHARD_WORDS = 4 << 20, 500_000
#: Bytes of text whose n-grams make one range, on average.
RANGE_BYTES = 4 << 20
#: The bounds' sample: documents of a language, pairs of words of a document.
SAMPLE_DOCS, SAMPLE_PAIRS = 200, 100
#: Local tops that one task compares.
TOPS = 64

# A-Z in lower case, ends of pieces as line feeds, tab as space.
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytearray(range(256))
for _code in range(65, 91):
    _TABLE[_code] = _code + 32
for _code in _BREAKS:
    _TABLE[_code] = 10
_TABLE[9] = 32
_TABLE = bytes(_TABLE)


# --- automata -------------------------------------------------------------------------


@dataclass
class Counts:
    """Sorted distinct paths of one to three words with weights.

    ``words`` are sorted; ``path`` holds their numbers from 1, 0 meaning no word. A path of one word has
    all occurrences of the word as its weight; a path of two has those that no longer path holds.
    """

    words: list[bytes]
    path: np.ndarray
    weight: np.ndarray

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each prefix of two begins, and the sum of weights in its range."""
        if not len(self.path):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        change = (self.path[1:, :2] != self.path[:-1, :2]).any(axis=1)
        starts = np.concatenate(([0], np.flatnonzero(change) + 1))
        return starts, np.add.reduceat(self.weight, starts)


def _frozen(arcs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The number of the state that each run of arcs makes; equal runs make one state."""
    raw, size = arcs.tobytes(), arcs.dtype.itemsize
    register: dict[bytes, int] = {}
    at = np.append(starts * size, len(raw)).tolist()
    states = [register.setdefault(raw[a:b], len(register)) for a, b in zip(at, at[1:])]
    return np.array(states, np.uint32), list(register)


_LAST = np.dtype([("word", "<u4"), ("weight", "<i8")])
_ARC = np.dtype([("word", "<u4"), ("state", "<u4")])


def _runs(column: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1)) if len(column) else np.zeros(0, np.int64)


def packed(counts: Counts) -> bytes:
    """The minimal automaton of ``counts``: sorted arcs per state, equal states merged bottom up."""
    used = np.unique(counts.path)
    used = used[used > 0]
    number = np.zeros(len(counts.words) + 1, np.uint32)
    number[used] = np.arange(1, len(used) + 1)
    path = number[counts.path]
    last = np.empty(len(path), _LAST)
    last["word"], last["weight"] = path[:, 2], counts.weight
    pair_starts, _ = counts.pairs()
    states, ends = _frozen(last, pair_starts)
    middle = np.empty(len(states), _ARC)
    middle["word"], middle["state"] = path[pair_starts, 1], states
    first_starts = _runs(path[pair_starts, 0])
    states, middles = _frozen(middle, first_starts)
    root = np.empty(len(states), _ARC)
    root["word"], root["state"] = path[pair_starts[first_starts], 0], states
    lengths = [np.array([len(state) // kind.itemsize for state in made], "<u4").tobytes()
               for made, kind in ((middles, _ARC), (ends, _LAST))]
    words = b"\n".join([counts.words[i - 1] for i in used.tolist()])
    return pickle.dumps((words, root.tobytes(), lengths[0], b"".join(middles), lengths[1], b"".join(ends)))


def _spread(states: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The arcs of ``states``, and for each the position of its state in ``states``."""
    starts = np.cumsum(lengths) - lengths
    many = lengths[states]
    owner = np.repeat(np.arange(len(states)), many)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    return starts[states][owner] + within, owner


def unpacked(machine: bytes) -> Counts:
    words, root, middle_lengths, middle, last_lengths, last = pickle.loads(machine)
    root, middle, last = np.frombuffer(root, _ARC), np.frombuffer(middle, _ARC), np.frombuffer(last, _LAST)
    arcs, owner = _spread(root["state"], np.frombuffer(middle_lengths, "<u4").astype(np.int64))
    first, second, state = root["word"][owner], middle["word"][arcs], middle["state"][arcs]
    arcs, owner = _spread(state, np.frombuffer(last_lengths, "<u4").astype(np.int64))
    path = np.stack([first[owner], second[owner], last["word"][arcs]], axis=1).astype(np.int64)
    return Counts(words.split(b"\n") if words else [], path, last["weight"][arcs].astype(np.int64))


def _summed(path: np.ndarray, weight: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct paths and the sums of their weights."""
    if not len(path):
        return path.reshape(0, 3), weight
    # Pairs are numbered first: three word numbers may not fit one integer.
    pair, pair_at = np.unique(path[:, 0] * (words + 1) + path[:, 1], return_inverse=True)
    key = pair_at * (words + 1) + path[:, 2]
    order = np.argsort(key, kind="stable")
    starts = _runs(key[order])
    kept = order[starts]
    return path[kept], np.add.reduceat(weight[order], starts)


def united(machines: Iterable[Counts]) -> Counts:
    """The union of automata; the weights of equal paths are summed."""
    machines = [m for m in machines if len(m.path)]
    if not machines:
        return Counts([], np.zeros((0, 3), np.int64), np.zeros(0, np.int64))
    number = pa.array([word for m in machines for word in m.words], pa.large_binary()).dictionary_encode()
    order = pc.sort_indices(number.dictionary).to_numpy()
    rank = np.empty(len(order) + 1, np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    ranks = rank[number.indices.to_numpy()]
    paths, at = [], 0
    for m in machines:
        mine = np.concatenate(([0], ranks[at : at + len(m.words)]))
        at += len(m.words)
        paths.append(mine[m.path])
    path, weight = _summed(np.concatenate(paths), np.concatenate([m.weight for m in machines]), len(order))
    return Counts(number.dictionary.take(pa.array(order)).to_pylist(), path, weight)


def pruned(counts: Counts, at_least: int) -> Counts:
    """Only paths whose prefixes count ``at_least``; what goes is added to the weight of the prefix of two."""
    starts, sums = counts.pairs()
    lengths = np.diff(np.append(starts, len(counts.path)))
    kept_pair = np.repeat(sums >= at_least, lengths)
    path, weight = counts.path[kept_pair].copy(), counts.weight[kept_pair]
    path[(path[:, 2] > 0) & (weight < at_least), 2] = 0
    path, weight = _summed(path, weight, len(counts.words))
    return Counts(counts.words, path, weight)


def composed(counts: Counts, grams: list[bytes]) -> list[int]:
    """How often each of ``grams`` (words joined by a space) occurs: the weights of the paths they begin."""
    number = {word: i + 1 for i, word in enumerate(counts.words)}
    width = len(counts.words) + 1
    starts, _ = counts.pairs()
    key = counts.path[:, 0] * width + counts.path[:, 1]
    total = np.concatenate(([0], np.cumsum(counts.weight)))
    wanted = []
    for gram in grams:
        ids = [number.get(word, -1) for word in gram.split(b" ")]
        wanted.append(-1 if -1 in ids else ids[0] * width + (ids[1] if len(ids) > 1 else 0))
    wanted = np.array(wanted, np.int64)
    return (total[np.searchsorted(key, wanted, "right")] - total[np.searchsorted(key, wanted, "left")]).tolist()


# --- shards ---------------------------------------------------------------------------


def split_words(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of a text and the piece each stands in."""
    signs = np.frombuffer(text.translate(_TABLE), np.uint8)
    gap = (signs == 32) | (signs == 10)
    inside = np.concatenate(([False], ~gap, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    piece = np.cumsum(signs == 10)[starts] if len(starts) else np.zeros(0, np.int64)
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    body = signs[~gap].tobytes()
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return words, piece


def shard_counts(words: pa.Array, piece: np.ndarray, begins: int) -> Counts:
    """Counts of the n-grams that begin at the first ``begins`` words."""
    encoded = words.dictionary_encode()
    order = pc.sort_indices(encoded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    first = rank[encoded.indices.to_numpy()]
    same = np.append(piece[1:] == piece[:-1], [False, False])
    later = np.append(first, [0, 0])
    at = np.arange(begins)
    second = np.where(same[at], later[at + 1], 0)
    third = np.where(same[at] & same[at + 1], later[at + 2], 0)
    paired = second > 0
    path = np.stack([first[:begins], second, third], axis=1)[paired]
    path, weight = _summed(path, np.ones(len(path), np.int64), len(order))
    single = np.bincount(first[:begins], minlength=len(order) + 1)
    seen = np.flatnonzero(single)
    singles = np.stack([seen, np.zeros_like(seen), np.zeros_like(seen)], axis=1)
    path, weight = _summed(np.concatenate([path, singles]), np.concatenate([weight, single[seen]]), len(order))
    return Counts(encoded.dictionary.take(pa.array(order)).to_pylist(), path, weight)


# --- prefix ranges --------------------------------------------------------------------


@dataclass
class Ranges:
    """Bounds of each language, sorted pairs of words; ranges are dealt further into ``deals`` parts."""

    bounds: dict[str, list[tuple[bytes, bytes]]]
    deals: int = 1

    def of(self, lang: str, gram: bytes) -> int:
        words = gram.split(b" ")
        prefix = (words[0], words[1] if len(words) > 1 else b"")
        return bisect_right(self.bounds.get(lang, []), prefix) * self.deals + self.deal(*prefix)

    def deal(self, first: bytes, second: bytes) -> int:
        return zlib.crc32(second, zlib.crc32(first)) % self.deals

    def cut(self, lang: str, counts: Counts) -> Iterator[tuple[int, Counts]]:
        """The non-empty parts of sorted counts."""
        width = len(counts.words) + 1
        keys = counts.path[:, 0] * width + counts.path[:, 1]
        limits = []
        for first, second in self.bounds.get(lang, []):
            at = bisect_left(counts.words, first)
            known = at < len(counts.words) and counts.words[at] == first
            limits.append((at + 1) * width + (bisect_left(counts.words, second) + 1 if known and second else 0))
        edges = [0, *np.searchsorted(keys, np.array(limits, np.int64), "left").tolist(), len(keys)]
        for number, (a, b) in enumerate(zip(edges, edges[1:])):
            if a < b:
                yield from self._dealt(number, Counts(counts.words, counts.path[a:b], counts.weight[a:b]))

    def _dealt(self, number: int, counts: Counts) -> Iterator[tuple[int, Counts]]:
        if self.deals == 1:
            yield number, counts
            return
        starts, _ = counts.pairs()
        names = [b"", *counts.words]
        deals = [self.deal(names[a], names[b]) for a, b in counts.path[starts, :2].tolist()]
        deal = np.repeat(np.array(deals), np.diff(np.append(starts, len(counts.path))))
        for part in np.unique(deal).tolist():
            mine = deal == part
            yield number * self.deals + part, Counts(counts.words, counts.path[mine], counts.weight[mine])


def _sample_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            words, piece = split_words(text.encode())
            for at in np.unique(np.linspace(0, max(len(words) - 1, 0), SAMPLE_PAIRS).astype(int)).tolist():
                if at < len(words):
                    follows = at + 1 < len(words) and piece[at] == piece[at + 1]
                    rows.append((lang, words[at].as_py(), words[at + 1].as_py() if follows else b""))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
            names=["lang", "first", "second"],
        )


def ranges_of(docs: DataFrame, range_bytes: int) -> Ranges:
    """Ranges for ``lang, text`` rows: bytes of each language decide how many, sampled pairs where they lie.

    About SAMPLE_DOCS * SAMPLE_PAIRS pairs of a language come to the driver.
    """
    sized = docs.groupBy("lang").agg(F.sum(F.octet_length("text")).cast("long").alias("bytes"), F.count(F.lit(1)).alias("n"))
    sizes = {row["lang"]: row for row in sized.collect()}
    sample = docs.sampleBy("lang", {lang: min(1.0, SAMPLE_DOCS / row["n"]) for lang, row in sizes.items()}, seed=7)
    pairs = defaultdict(list)
    for row in sample.mapInArrow(_sample_pairs, "lang string, first binary, second binary").collect():
        pairs[row["lang"]].append((bytes(row["first"]), bytes(row["second"])))
    bounds, deals = {}, 1
    for lang, found in pairs.items():
        found.sort()
        wanted = -(-sizes[lang]["bytes"] // range_bytes)
        cuts = min(wanted, len(found))
        bounds[lang] = sorted({found[len(found) * i // cuts] for i in range(1, cuts)})
        deals = max(deals, -(-wanted // (len(found) or 1)))
    return Ranges(bounds, deals)


# --- jobs -----------------------------------------------------------------------------

_SHARD = "lang string, part long, machine binary"
_UNITED = "lang string, part long, n long, machine binary, asks long, grams binary, longer array<long>"
_ANSWER = "lang string, part long, grams binary, counts array<long>, covered boolean"
_SCORED = "lang string, part long, phrase string, a long, l long, r long, score long"


def _table(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(schema.values())]
    return pa.RecordBatch.from_arrays(arrays, names=list(schema))


_LONGS = pa.list_(pa.int64())
_SHARD_ARROW = {"lang": pa.string(), "part": pa.int64(), "machine": pa.binary()}
_UNITED_ARROW = {
    "lang": pa.string(), "part": pa.int64(), "n": pa.int64(), "machine": pa.binary(),
    "asks": pa.int64(), "grams": pa.binary(), "longer": _LONGS,
}
_ANSWER_ARROW = {"lang": pa.string(), "part": pa.int64(), "grams": pa.binary(), "counts": _LONGS, "covered": pa.bool_()}
_SCORED_ARROW = {
    "lang": pa.string(), "part": pa.int64(), "phrase": pa.string(),
    "a": pa.int64(), "l": pa.int64(), "r": pa.int64(), "score": pa.int64(),
}


def _shards(ranges: Ranges, gather: int, shard_words: int):
    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = defaultdict(list), 0
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                raw = text.encode()
                waiting[lang].append(raw)
                size += len(raw)
                if size >= gather:
                    yield from flush(waiting)
                    waiting, size = defaultdict(list), 0
        yield from flush(waiting)

    def flush(waiting: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
        for lang, texts in waiting.items():
            words, piece = split_words(b"\n".join(texts))
            for at in range(0, len(words), shard_words):
                begins = min(shard_words, len(words) - at)
                end = at + begins + LONGEST - 1
                counts = shard_counts(words[at:end], piece[at:end], begins)
                rows = [(lang, part, packed(mine)) for part, mine in ranges.cut(lang, counts)]
                yield _table(_SHARD_ARROW, rows)

    return build


def _candidates(counts: Counts, at_least: int) -> Iterator[tuple[list[bytes], int]]:
    """Phrases of two or three words that occur often enough; ``counts`` is pruned."""
    starts, sums = counts.pairs()
    names = [b"", *counts.words]
    for (first, second), total in zip(counts.path[starts, :2].tolist(), sums.tolist()):
        if second and total >= at_least:
            yield [names[first], names[second]], total
    for path, weight in zip(counts.path.tolist(), counts.weight.tolist()):
        if path[2] and weight >= at_least:
            yield [names[i] for i in path], weight


def _parts(words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
    for k in range(1, len(words)):
        yield b" ".join(words[:k]), b" ".join(words[k:])


def _unite(ranges: Ranges, at_least: int):
    """The automata of a range as one, and what it asks of which range."""

    def unite(key: tuple, table: pa.Table) -> pa.Table:
        lang, part = key[0].as_py(), key[1].as_py()
        whole = united(unpacked(machine) for machine in table["machine"].to_pylist())
        n = int(whole.weight[whole.path[:, 1] == 0].sum())
        kept = pruned(whole, at_least)
        rows = [(lang, part, n, packed(kept), None, None, None)]
        asked: dict[bytes, int] = {}
        for words, total in _candidates(kept, at_least):
            for sides in _parts(words):
                for gram in sides:
                    longer = total if b" " in gram else 0
                    asked[gram] = max(asked.get(gram, 0), longer)
        by_owner = defaultdict(list)
        for gram in sorted(asked):
            by_owner[ranges.of(lang, gram)].append(gram)
        for owner, grams in by_owner.items():
            rows.append((lang, owner, None, None, part, b"\n".join(grams), [asked[g] for g in grams]))
        return pa.Table.from_batches([_table(_UNITED_ARROW, rows)])

    return unite


def _answer(key: tuple, machines: pa.Table, asked: pa.Table) -> pa.Table:
    """Counts of the parts asked for, and which phrases of this range are covered by longer ones."""
    lang, part = key[0].as_py(), key[1].as_py()
    rows, longest = [], {}
    if machines.num_rows:
        counts = unpacked(machines["machine"][0].as_py())
        totals = {}
        for who, grams, longer in zip(asked["asks"].to_pylist(), asked["grams"].to_pylist(), asked["longer"].to_pylist()):
            grams = grams.split(b"\n")
            found = composed(counts, grams)
            rows.append((lang, who, b"\n".join(grams), found, False))
            for gram, total, most in zip(grams, found, longer):
                totals[gram], longest[gram] = total, max(longest.get(gram, 0), most)
        gone = [gram for gram, most in longest.items() if most and 100 * most >= COVERED * totals[gram]]
        if gone:
            rows.append((lang, part, b"\n".join(gone), [], True))
    return pa.Table.from_batches([_table(_ANSWER_ARROW, rows)])


def _score(at_least: int, top: int):
    def score(key: tuple, machines: pa.Table, answers: pa.Table) -> pa.Table:
        lang, part = key[0].as_py(), key[1].as_py()
        count, covered = {}, set()
        for grams, counts, gone in zip(answers["grams"].to_pylist(), answers["counts"].to_pylist(), answers["covered"].to_pylist()):
            if gone:
                covered.update(grams.split(b"\n"))
            else:
                count.update(zip(grams.split(b"\n"), counts))
        rows = []
        if machines.num_rows:
            for words, a in _candidates(unpacked(machines["machine"][0].as_py()), at_least):
                phrase = b" ".join(words)
                if phrase in covered:
                    continue
                cuts = ((SCALE * a * a // (count[left] * count[right]), k) for k, (left, right) in enumerate(_parts(words)))
                value, k = min(cuts)
                left, right = list(_parts(words))[k]
                rows.append((-value, -a, phrase, count[left], count[right]))
        rows.sort()
        rows = [(lang, part, p.decode(errors="replace"), -a, left, right, -v) for v, a, p, left, right in rows[:top]]
        return pa.Table.from_batches([_table(_SCORED_ARROW, rows)])

    return score


def _best(group: list[str | Column], top: int) -> Window:
    return Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"), "phrase")


def phrases(
    docs: DataFrame,
    at_least: int = AT_LEAST,
    top: int = TOP,
    range_bytes: int = RANGE_BYTES,
    gather: int = GATHER_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = ranges_of(texts, range_bytes)
    shards = texts.mapInArrow(_shards(ranges, gather, shard_words), _SHARD)
    made = stage(shards.groupBy("lang", "part").applyInArrow(_unite(ranges, at_least), _UNITED), "phrase-automata")
    machines = made.where("machine IS NOT NULL").select("lang", "part", "machine")
    asked = made.where("grams IS NOT NULL").select("lang", "part", "asks", "grams", "longer")
    by_part = machines.groupBy("lang", "part")
    answers = by_part.cogroup(asked.groupBy("lang", "part")).applyInArrow(_answer, _ANSWER)
    scored = by_part.cogroup(answers.groupBy("lang", "part")).applyInArrow(_score(at_least, top), _SCORED)
    # Each range has sent its own top; they meet a bounded number at a time.
    groups = max((len(bounds) + 1 for bounds in ranges.bounds.values()), default=1) * ranges.deals
    while groups > TOPS:
        groups = -(-groups // TOPS)
        near = _best(["lang", F.pmod("part", F.lit(groups))], top)
        scored = scored.withColumn("_n", F.row_number().over(near)).where(F.col("_n") <= top).drop("_n")
    ranked = scored.withColumn("rank", F.row_number().over(_best(["lang"], top)).cast("long")).where(F.col("rank") <= top)
    words = made.groupBy("lang").agg(F.sum("n").cast("long").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
