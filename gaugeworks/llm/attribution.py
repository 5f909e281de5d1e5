"""Token counts by section, from one encoding of the whole document (operator 2).

A text is encoded once, as it would be for training; encoding its sections one by
one would give other tokens at their borders. Each token's character span is then
joined to the sections it overlaps: both lists are in order, so the join is a
search for each token's first and last character among the section borders.

The rule for tokens that cross a border: a token belongs to the section that holds
most of its characters; of sections that hold equally many, to the first; without
any, to none. So each token counts once, and counts add up to the document's.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import columns, texts

#: A byte-level vocabulary as ranks; the path is a parameter and must exist on all executors.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how that vocabulary's texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_SECTION = -1

Sections = list[tuple[int, int]]


class Tokens(NamedTuple):
    start: np.ndarray  # first character
    end: np.ndarray  # behind the last


def encoder(path: str, pattern: str = PATTERN) -> Callable[[str], Tokens]:
    """Reads a vocabulary; the function it returns gives the tokens' character spans."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    length = np.zeros(max(ranks.values()) + 1, np.int64)
    length[list(ranks.values())] = list(map(len, ranks))

    def spans(text: str) -> Tokens:
        ids = np.array(encoding.encode_ordinary(text), np.int64)
        if not len(ids):
            return Tokens(ids, ids)
        ends = np.cumsum(length[ids])
        if len(text) == ends[-1]:  # one byte for each character
            return Tokens(ends - length[ids], ends)
        # A character whose bytes several tokens share is in the span of each.
        at = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80) - 1
        return Tokens(at[ends - length[ids]], at[ends - 1] + 1)

    return spans


def lines(text: str) -> Sections:
    """The lines of a text as sections, each with its line feed."""
    out, start = [], 0
    while start < len(text):
        end = text.find("\n", start) + 1 or len(text)
        out.append((start, end))
        start = end
    return out


def allot(tokens: Tokens, sections: Sections) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token (``NO_SECTION`` for none), and whether it overlaps several or a gap.

    Sections are in order and don't overlap.
    """
    if not sections or not len(tokens.start):
        return np.full(len(tokens.start), NO_SECTION), np.zeros(len(tokens.start), bool)
    starts, ends = np.array(sections, np.int64).T
    first = np.searchsorted(ends, tokens.start, "right")  # the first section that ends behind the token's start
    last = np.searchsorted(starts, tokens.end, "left") - 1  # the last that starts before its end
    has = first <= last
    section = np.where(has, first, NO_SECTION)
    at = np.where(has, first, 0)
    held = np.minimum(ends[at], tokens.end) - np.maximum(starts[at], tokens.start)
    crossing = has & ((first < last) | (held < tokens.end - tokens.start))
    for i in np.nonzero(has & (first < last))[0]:
        among = np.arange(first[i], last[i] + 1)
        overlap = np.minimum(ends[among], tokens.end[i]) - np.maximum(starts[among], tokens.start[i])
        section[i] = among[overlap.argmax()]
    return section, crossing


def attributed(
    docs: DataFrame, vocabulary: str = VOCABULARY, sections: Callable[[str], Sections] = lines
) -> DataFrame:
    """A row for each section of each text: ``doc_id``, ``section`` (from 0), its span ``start`` to
    ``stop`` in characters, ``n_tokens`` it holds, and ``n_crossing`` of them that reach beyond it.

    Tokens of no section make a row with ``section`` -1 and no span, where there are
    any. Null and empty texts have no sections and no rows. Repeated rows give
    repeated results, a null ``doc_id`` stays null, an empty table gives no rows.
    Other columns are not read.
    """
    names = ("doc_id", "section", "start", "stop", "n_tokens", "n_crossing")

    def count(batches):
        spans = encoder(vocabulary)
        for ids, values in columns(batches, 500):
            out: list[list[np.ndarray]] = [[] for _ in names]
            rows: list[int | None] = []
            for one, text in zip(ids, values, strict=True):
                parts = sections(text)
                section, crossing = allot(spans(text), parts)
                size = len(parts)
                held = np.bincount(section + 1, minlength=size + 1)
                beyond = np.bincount(section[crossing] + 1, minlength=size + 1)
                begin = 0 if held[0] else 1
                where = np.array([(-1, -1), *parts], np.int64)[begin:]
                rows += [one] * len(where)
                for k, x in enumerate((np.arange(begin - 1, size), where[:, 0], where[:, 1], held[begin:], beyond[begin:])):
                    out[k + 1].append(x)
            arrays = [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), *arrays], list(names))

    found = texts(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        count, ", ".join(f"{x} long" for x in names)
    )
    inside = F.col("section") != NO_SECTION
    return found.withColumn("start", F.when(inside, F.col("start"))).withColumn("stop", F.when(inside, F.col("stop")))
