"""Mixing sources to target weights by blocks and index permutations (operator 4).

DataFrame and SQL functions only.

The words of a source, document after document, form one stream, which is cut
into blocks of ``BLOCK_WORDS``. A source's target gives the number of its draws.
Draw k of a source takes block ``permutation(k modulo blocks)``, so each pass over
the source takes every block once, in an order of its own. All draws of all
sources are dealt over the slots of the output shards by one more permutation:
the counts of sources in a shard are then multinomial, given that over all shards
they add up to the draws. (Independent draws would miss each target by about the
root of its number of blocks.) Draws and blocks are joined by index.

Positions in a stream are running sums in three levels, so no task takes a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import word_count
from gaugeworks.session import stage

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
#: Weights of the sources in order, repeating; words wanted against
#: words there; how often a source may be used.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Rows of a part for running sums, and parts of a larger part.
PART_ROWS, PARTS = 400, 1000
#: Draws that one row is unfolded to.
CHUNK = 1 << 13
ROUNDS = 20
#: Rows equal in these are one another's copies; the digest is one of the text.
ALIKE = ("doc_id", "source", "size", "digest")


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0 to ``size`` - 1, chosen by ``key``: a swap-or-not network.

    Each round pairs x with (k - x) modulo ``size`` and swaps a pair or not by a hash
    both of its members share, so every round is a bijection for any ``size``.
    """

    def swapped(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(r, *key), size) + size - x, size)
        return F.when(F.xxhash64(F.greatest(x, other), r, *key).bitwiseAND(1) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), index.cast("long"), swapped)


def targets(sizes: DataFrame) -> DataFrame:
    """``source`` and ``size`` of documents -> a row for each source, null last.

    Targets are filled like connected vessels: sources in order of cap over weight
    stop at their cap as long as the level of those left would be above it.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.asc_nulls_last("source"))
    number = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (number + 1).cast("int"))
    cap = (MOST * F.col("source_size")).cast("double")
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    behind = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = Window.partitionBy(F.lit(1))
    level = (F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(behind)
    # One row for each source, whatever the number of documents.
    return (
        sums.withColumn("number", F.row_number().over(order))
        .withColumn("weight", weight.cast("double"))
        .withColumn("cap", cap)
        .withColumn("wanted", SHARE * F.sum("source_size").over(everywhere))
        .withColumn("level", level)
        .withColumn("level", F.max(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))).over(everywhere))
        .withColumn("target", F.coalesce(F.least("cap", F.col("weight") * F.col("level")), F.lit(0.0)))
        .select("number", "source", "source_size", "target")
    )


def with_draws(sources: DataFrame) -> DataFrame:
    """Adds blocks and draws of each source, and the number of its first draw among all."""
    size = F.col("source_size")
    blocks = F.ceil(size / BLOCK_WORDS).cast("long")
    draws = F.when(size > 0, F.round(F.col("target") * F.col("blocks") / size)).otherwise(0).cast("long")
    order = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sources.withColumn("blocks", blocks)
        .withColumn("draws", F.least(draws, MOST * F.col("blocks")))
        .withColumn("first", F.coalesce(F.sum("draws").over(order), F.lit(0)).cast("long"))
        .withColumn("all_draws", F.sum("draws").over(Window.partitionBy(F.lit(1))).cast("long"))
    )


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents that have words, each with the source's number and its place ``at`` in the stream.

    Rows alike in all columns of ``ALIKE`` are placed as one and told apart by ``copy`` afterwards, so a
    group of any size is one row of the sums.
    """
    alike = sizes.where("size > 0").groupBy(*ALIKE).agg(F.count("*").alias("copies"))
    rows = alike.join(sources.select("number", "source"), alike["source"].eqNullSafe(sources["source"]))
    rows = stage(rows.select("doc_id", "number", "size", "digest", "copies"), "alike")
    parts = max(1, -(-rows.count() // PART_ROWS))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "size", "digest"), F.lit(parts)))
    rows = rows.withColumn("wide", F.floor(F.col("part") / PARTS)).withColumn("length", F.col("size") * F.col("copies"))

    def upto(*keys: str, by: tuple[str, ...]):
        return Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)

    def running(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    in_part = running("length", upto("number", "part", by=("doc_id", "size", "digest")))
    rows = rows.withColumn("in_part", in_part)
    sums = stage(rows.groupBy("number", "wide", "part").agg(F.sum("length").alias("words")), "parts")
    wide = sums.groupBy("number", "wide").agg(F.sum("words").alias("words"))
    wide = wide.select("number", "wide", running("words", upto("number", by=("wide",))).alias("to_wide"))
    sums = sums.withColumn("to_part", running("words", upto("number", "wide", by=("part",))))
    sums = sums.join(wide, ["number", "wide"]).select("number", "part", (F.col("to_wide") + F.col("to_part")).alias("to"))
    return (
        rows.join(sums, ["number", "part"])
        .withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
        .select(
            "doc_id", "number", "size", "digest", "copy",
            (F.col("to") + F.col("in_part") + F.col("copy") * F.col("size")).cast("long").alias("at"),
        )
    )


def with_copies(sizes: DataFrame) -> DataFrame:
    """Numbers rows alike by ``row``, from 0: ``copy``. They are counted within each partition of ``row``
    and from partition to partition, so no task takes a whole group."""
    rows = sizes.withColumn("partition", F.shiftrightunsigned("row", 33))
    here = Window.partitionBy(*ALIKE, "partition").orderBy("row")
    upto = Window.partitionBy(*ALIKE).orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy(*ALIKE, "partition").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(upto))
        .where("before > 0")
        .select(*(F.col(c).alias(f"_{c}") for c in (*ALIKE, "partition")), "before")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*ALIKE, "partition")]
    # Few rows unless many are alike; staged, so that Spark knows how many.
    return (
        rows.withColumn("here", F.row_number().over(here) - 1)
        .join(stage(before, "before"), same, "left")
        .select(*ALIKE, "row", (F.col("here") + F.coalesce("before", F.lit(0))).cast("long").alias("copy"))
    )


def slots(sources: DataFrame) -> DataFrame:
    """Every draw: output ``shard`` and ``slot``, source ``number``, ``block`` and ``pass``."""
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (
        sources.where("draws > 0")
        .withColumn("chunk", F.explode(F.expr(f"sequence(0L, (draws - 1) div {CHUNK})")))
        # A fixed number: rows are few and small here, and would be put together into one task.
        .repartition(tasks, "number", "chunk")
    )
    draw = F.expr(f"sequence(chunk * {CHUNK}, least(draws, (chunk + 1) * {CHUNK}) - 1)")
    place = permuted(F.col("first") + F.col("draw"), F.col("all_draws"), F.lit("slots"))
    turn = F.expr("draw div blocks")
    return (
        chunks.withColumn("draw", F.explode(draw))
        .withColumn("pass", turn)
        .withColumn("block", permuted(F.expr("draw % blocks"), F.col("blocks"), F.col("number"), F.lit("blocks")))
        .withColumn("place", place)
        .select(
            F.expr(f"place div {SHARD_SLOTS}").alias("shard"), F.expr(f"place % {SHARD_SLOTS}").alias("slot"),
            "number", "block", "pass",
        )
    )


def shard_counts(drawn: DataFrame) -> DataFrame:
    """How many slots of each shard each source fills: ``shard``, ``number``, ``n``."""
    return drawn.groupBy("shard", "number").agg(F.count("*").alias("n"))


def cut_into_blocks(documents: DataFrame) -> DataFrame:
    """Each document's part of each block: ``from`` (a word of the document) and ``words``."""
    cut = documents.withColumn(
        "block", F.explode(F.expr(f"sequence(at div {BLOCK_WORDS}, (at + size - 1) div {BLOCK_WORDS})"))
    )
    low = F.greatest(F.col("at"), F.col("block") * BLOCK_WORDS)
    high = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * BLOCK_WORDS)
    return cut.withColumn("from", (low - F.col("at")).cast("long")).withColumn("words", (high - low).cast("long"))


def in_slots(documents: DataFrame, drawn: DataFrame) -> DataFrame:
    """The mix itself, blocks joined to slots by index: a row for each document's part of the block in each
    slot of each shard, and one without a slot for each part that no slot takes."""
    # Sizes estimated from the few rows of sources are far too small, so Spark must not choose by them.
    return cut_into_blocks(documents).join(drawn.hint("merge"), ["number", "block"], "left")


def pieces(documents: DataFrame, drawn: DataFrame) -> DataFrame:
    """Each document's part of each block, with the uses of the block: blocks joined by index."""
    uses = drawn.groupBy("number", "block").agg(F.count("*").cast("int").alias("uses"))
    return (
        cut_into_blocks(documents)
        # Sizes estimated from the few rows of sources are far too small, so Spark must not choose by them.
        .join(uses.hint("merge"), ["number", "block"], "left")
        .withColumn("uses", F.coalesce("uses", F.lit(0)))
    )


def _sizes(docs: DataFrame, *more: Column) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    source = F.col("source").cast("string").alias("source")
    return docs.select("doc_id", source, word_count(F.col("text")).alias("size"), F.xxhash64(text).alias("digest"), *more)


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` of every row of ``docs``, all summed over
    the slots of the mix, and the first ``shard`` and its first ``slot`` that hold a word of it (null if none does).

    Null and empty texts have size 0 and nothing is taken of them. A null source is
    a source of its own, the last. Repeated rows count, and are mixed, one by one;
    so do rows with a null ``doc_id``. An empty table gives no rows. Other columns
    are not read. The same table gives the same mix.
    """
    sizes = stage(_sizes(docs), "sizes")
    sources = stage(with_draws(targets(sizes)), "sources")
    place = F.col("shard") * SHARD_SLOTS + F.col("slot")
    taken = (
        in_slots(placed(sizes, sources), slots(sources))
        .groupBy("number", "at", "doc_id", "size")
        .agg(
            F.coalesce(F.sum(F.when(F.col("shard").isNotNull(), F.col("words"))), F.lit(0)).cast("long").alias("taken"),
            F.min(place).alias("first"),
        )
        .select("doc_id", "number", "size", "taken", "first")
    )
    empty = sizes.where("size = 0").join(sources.select("number", "source"), sizes["source"].eqNullSafe(sources["source"]))
    empty = empty.select("doc_id", "number", "size", F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first"))
    return (
        taken.unionAll(empty)
        .join(sources.select("number", "source_size", "target"), "number")
        .select(
            "doc_id", "size", "source_size", "target", "taken",
            F.expr(f"first div {SHARD_SLOTS}").alias("shard"), F.expr(f"first % {SHARD_SLOTS}").alias("slot"),
        )
    )


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: a row for each pass that takes words of a document.

    Its text holds the words of the blocks drawn in that pass: the text as it is where
    all are drawn, else the words joined by blanks. Documents of which nothing is
    taken go, so do null texts and those without words. Every row has a plan of its
    own, whatever its id: of rows alike, null ids included, each is one of the copies
    that :func:`mix` counts. An empty table stays empty. All columns are kept.
    """
    # The rows are numbered as they are written; the narrow side is shuffled by content, whole rows once by number.
    number = F.monotonically_increasing_id().alias("row")
    held = stage(_sizes(docs, number, F.struct(*docs.columns).alias("columns")), "rows")
    sizes = held.select(*ALIKE, "row")
    sources = stage(with_draws(targets(sizes)), "sources")
    plan = (
        pieces(placed(sizes, sources), slots(sources))
        .groupBy("number", "at", "doc_id", "size", "digest", "copy")
        .agg(F.array_sort(F.collect_list(F.struct("from", "words", "uses"))).alias("plan"))
        .where("exists(plan, p -> p.uses > 0)")
        .join(sources.select("number", "source"), "number")
        .select(*(F.col(c).alias(f"_{c}") for c in (*ALIKE, "copy")), "plan")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*ALIKE, "copy")]
    plan = with_copies(sizes.where("size > 0")).join(plan.hint("merge"), same).select("row", "plan")
    taken = held.select("row", "columns").join(plan.hint("merge"), "row").withColumn(
        "turn", F.explode(F.expr("sequence(0, array_max(transform(plan, p -> p.uses)) - 1)"))
    )
    words = F.regexp_extract_all("columns.text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = F.filter("plan", lambda p: p["uses"] > F.col("turn"))
    # The words are bound once: an expression inside a lambda would be evaluated for each piece.
    text = F.transform(
        F.array(words),
        lambda w: F.array_join(
            F.flatten(F.transform(chosen, lambda p: F.slice(w, (p["from"] + 1).cast("int"), p["words"].cast("int")))), " "
        ),
    )[0]
    text = F.when(F.expr("forall(plan, p -> p.uses > turn)"), F.col("columns.text")).otherwise(text)
    out = taken.withColumn("mixed", text)
    kept = {c: F.col(f"columns.`{c}`") for c in docs.columns} | {"text": F.col("mixed")}
    if "n_chars" in docs.columns:
        kept["n_chars"] = F.length("mixed").cast(docs.schema["n_chars"].dataType)
    return out.select(*(kept[c].alias(c) for c in docs.columns))
