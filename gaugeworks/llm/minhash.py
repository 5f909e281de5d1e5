"""One-permutation MinHash fingerprints with optimal densification (operator 10).

DataFrame and SQL functions only.

The five-word shingles of a text are hashed once; the top bits of a hash name its
bin, and each bin keeps its least hash. An empty bin takes over the value of
another bin: it tries all bins in an order of its own, the same for every text,
and takes the first that isn't empty, so that two texts borrow alike as far as
their bins agree. Of each bin the lowest ``BITS`` bits are stored. Two bins that
differ still agree in them by chance, one time in 2^BITS; likeness is corrected
for that.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import WORD, texts
from gaugeworks.session import stage

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 8


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once; in a lambda it would be computed each time."""
    return F.transform(F.array(value), use)[0]


def shingle_hashes(text: Column) -> Column:
    """Hashes of the shingles, repeats included; all words are one if they are few, none make none."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(SHINGLE)))
        )
        return F.when(F.size(h) >= SHINGLE, each).when(F.size(h) > 0, F.array(F.xxhash64(h)))

    return F.coalesce(bind(hashed, shingles), F.array().cast("array<bigint>"))


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - BIN_BITS)


def _orders() -> Column:
    """For each bin, the order in which it tries the others: try t is bin ``a * t + c``; ``inverse`` undoes ``a``."""
    rng = random.Random(10)
    rows = []
    for j in range(BINS):
        a, c = 2 * rng.randrange(BINS // 2) + 1, rng.randrange(BINS)
        rows.append(
            F.struct(
                F.lit(j).cast("long").alias("bin"), F.lit(a).cast("long").alias("a"), F.lit(c).cast("long").alias("c"),
                F.lit(pow(a, -1, BINS)).cast("long").alias("inverse"),
            )
        )
    return F.array(*rows)


def bins_of(sorted_hashes: Column) -> Column:
    """The least hash of each bin that has one: in sorted order, the first of each run of equal top bits."""
    return F.filter(
        sorted_hashes, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(sorted_hashes, i - 1)))
    )


def densified(least: Column) -> Column:
    """Low bits of all bins as shorts; null if no bin has a value."""

    def fill(bins: Column, least: Column) -> Column:
        def value(j: Column) -> Column:
            return F.get(least, (F.array_position(bins, j) - 1).cast("int"))

        def one(order: Column) -> Column:
            tries = F.transform(bins, lambda b: (order["inverse"] * (b - order["c"])).bitwiseAND(BINS - 1))
            lender = (order["a"] * F.array_min(tries) + order["c"]).bitwiseAND(BINS - 1)
            own = F.array_contains(bins, order["bin"])
            return value(F.when(own, order["bin"]).otherwise(lender)).bitwiseAND((1 << BITS) - 1).cast("short")

        return F.transform(_orders(), one)

    filled = bind(least, lambda x: bind(F.transform(x, _bin), lambda bins: fill(bins, x)))
    return F.when(F.size(least) > 0, filled)


def as_text(bins: Column) -> Column:
    """Packed bins in hexadecimal digits; empty without any."""
    digits = F.array(*(F.lit(f"{x:0{BITS // 4}x}") for x in range(1 << BITS)))
    return F.coalesce(F.array_join(F.transform(bins, lambda x: F.element_at(digits, (x + 1).cast("int"))), ""), F.lit(""))


def likeness(one: Column, other: Column) -> Column:
    """Estimated Jaccard similarity; 1 if neither has words, 0 if one has none."""
    equal = F.aggregate(F.zip_with(one, other, lambda x, y: (x == y).cast("int")), F.lit(0), lambda a, b: a + b)
    chance = 2.0**-BITS
    estimate = F.greatest(F.lit(0.0), (equal / BINS - chance) / (1 - chance))
    return F.when(one.isNull() & other.isNull(), 1.0).when(one.isNull() | other.isNull(), 0.0).otherwise(estimate)


def fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the bins of a text column, in three projections of built-in functions."""
    return (
        df.withColumn("_hashes", F.sort_array(shingle_hashes(F.col(text))))
        .withColumn("_least", bins_of(F.col("_hashes")))
        .withColumn(out, densified(F.col("_least")))
        .drop("_hashes", "_least")
    )


def in_order(docs: DataFrame) -> DataFrame:
    """Each ``doc_id`` once, with the id after it and before it, and the length of the text before it.

    Ids are dealt by range; neighbours are looked up within a range, and across
    ranges from one row for each. The first id follows the last.
    """
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.length("text")).cast("long").alias("n"))
    ranged = stage(ids.repartitionByRange("doc_id").withColumn("range", F.spark_partition_id()), "ids")
    ends = ranged.groupBy("range").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max_by("n", "doc_id").alias("last_n")
    )
    order, all_ranges = Window.orderBy("range"), Window.orderBy("range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    # One row for each partition of the ids.
    ends = ends.select(
        "range",
        F.coalesce(F.lead("first").over(order), F.first("first").over(all_ranges)).alias("behind"),
        F.coalesce(F.lag("last").over(order), F.last("last").over(all_ranges)).alias("ahead"),
        F.coalesce(F.lag("last_n").over(order), F.last("last_n").over(all_ranges)).alias("ahead_n"),
    )
    inside = Window.partitionBy("range").orderBy("doc_id")
    near = ranged.select(
        "doc_id", "range", F.lead("doc_id").over(inside).alias("next"), F.lag("doc_id").over(inside).alias("before"),
        F.lag("n").over(inside).alias("before_n"),
    )
    return near.join(ends, "range").select(
        "doc_id",
        F.coalesce("next", "behind").alias("next_id"),
        F.coalesce("before", "ahead").alias("before_id"),
        F.coalesce("before_n", "ahead_n").alias("before_n"),
    )


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text is the text without its last quarter, followed by as many
    characters from the start of the next document. Null texts are empty; texts
    without words have the fingerprint "". Where an id repeats, each row is
    fingerprinted, and the next document is, for both the edit and ``near_next``, the
    text of the next id with the smallest hash. Rows
    without ``doc_id`` have no next document: nothing replaces their last quarter,
    and ``near_next`` is null. An empty table gives no rows; other columns are not read.
    """
    docs = texts(docs)
    without_id = docs.where("doc_id is null").withColumn("start", F.lit(None).cast("string"))
    # Both joins below shuffle this very frame, so its texts are shuffled once and read twice.
    docs = docs.where("doc_id is not null")
    order = stage(in_order(docs), "order")
    # Only the characters that the document before wants are sent to it.
    wanted = F.substring(F.col("text"), F.lit(1), F.floor(F.col("before_n") / 4).cast("int"))
    starts = (
        docs.join(order.select("doc_id", "before_id", "before_n"), "doc_id")
        .select(F.col("before_id").alias("doc_id"), wanted.alias("start"), F.xxhash64("text").alias("which"))
        .groupBy("doc_id")
        .agg(F.min_by("start", "which").alias("start"))
    )
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = (
        docs.join(starts, "doc_id", "left")
        .unionByName(without_id)
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn(
            "edited",
            F.concat(
                F.substring("text", F.lit(1), F.col("n_chars").cast("int") - quarter),
                F.coalesce(F.substring("start", F.lit(1), quarter), F.lit("")),
            ),
        )
        .withColumn("edited_sha256", F.sha2("edited", 256))
    )
    both = fingerprint(fingerprint(edited, "text", "bins"), "edited", "edited_bins")
    which = F.xxhash64("text").alias("which")
    both = stage(both.select("doc_id", "n_chars", "edited_sha256", "bins", "edited_bins", which), "fingerprints")
    nexts = (
        order.select(F.col("doc_id").alias("of"), "next_id")
        .join(both.groupBy("doc_id").agg(F.min_by("bins", "which").alias("next_bins")), F.col("next_id") == F.col("doc_id"))
        .select(F.col("of").alias("doc_id"), "next_bins", F.lit(True).alias("has_next"))
    )
    return both.join(nexts, "doc_id", "left").select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("bins")).alias("fingerprint"), as_text(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        F.when(F.col("has_next"), likeness(F.col("bins"), F.col("next_bins"))).alias("near_next"),
    )
