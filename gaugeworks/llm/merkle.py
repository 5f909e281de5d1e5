"""Merkle manifest of a table, folded by resuming copied hash states.

Every row is a leaf, leaves are ordered within their language, and every eight
consecutive nodes make one parent: the SHA-256 of their digests as hex text. The
roots of the languages are the leaves of one more such tree, whose root stands
for the table. A parent keeps a copy of its hash state from before each child
slot; to replace a child, the state of its slot is copied, the replacement and
the right siblings are added, and nothing left of the slot is hashed again.

Positions come from a range shuffle and counts of sorted runs, so a language
that holds most rows is spread over all tasks. Trees are cut into blocks of
``8 ** LIFT`` nodes; a group is never larger than one block. Going up, each block
is reduced to its root. Coming down, each block is told the runs between its root
and the root of the table, which is a few hundred bytes a level.

Null cells hash as ``-``. A null id sorts first and is never tampered with; rows
with equal ids are ordered by their leaf, so equal rows are interchangeable and
the result does not depend on the order of rows. An empty table has no rows in the
result. Columns other than the five of ``documents`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.session import stage, staged

#: Children of a parent, and levels a block spans.
FAN, LIFT = 8, 3
BLOCK = FAN**LIFT
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: The way from a node to the root: per level the hex digests left and right of the node.
PATH = "lefts array<string>, rights array<string>"


# --- hashing inside a block -----------------------------------------------------------


class Parent:
    """A run of up to eight children: its digest and the state before each child."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: list[str]):
        state = hashlib.sha256()
        self.children, self.states = children, []
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def siblings(self, slot: int) -> tuple[str, str]:
        return "".join(self.children[:slot]), "".join(self.children[slot + 1 :])


def resumed(state, replacement: str, right: str) -> str:
    """The parent's digest when ``replacement`` stands where ``state`` was copied."""
    state = state.copy()
    state.update((replacement + right).encode())
    return state.hexdigest()


def levels_to_lift(nodes: int) -> int:
    """Levels of one block in a tree that has ``nodes`` nodes at the block's lowest level."""
    lift = 0
    while nodes > 1 and lift < LIFT:
        nodes, lift = -(-nodes // FAN), lift + 1
    return lift


def block_levels(digests: list[str], nodes: int) -> list[list[Parent]]:
    """The parents of a block, from the lowest level up."""
    levels = []
    for _ in range(levels_to_lift(nodes)):
        parents = [Parent(digests[at : at + FAN]) for at in range(0, len(digests), FAN)]
        levels.append(parents)
        digests = [parent.digest for parent in parents]
    return levels


def steps_up(levels: list[list[Parent]], at: int) -> Iterator[tuple[Parent, int]]:
    for parents in levels:
        at, slot = divmod(at, FAN)
        yield parents[at], slot


# --- positions ------------------------------------------------------------------------


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``at``, the position within ``tree`` by ``order`` from 0, and ``nodes``, the tree's size.

    Rows are range-partitioned and sorted; a row's position is its place in the sorted run
    of its partition plus the lengths of the tree's runs in earlier partitions.
    """
    spread = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    numbered = stage(spread.withColumn("_row", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("_row", 33).alias("_part")
    runs = numbered.groupBy("tree", part).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    # One row for each tree and partition, however many rows they hold.
    by_part = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree", "_part", "_first",
        F.coalesce(F.sum("_n").over(by_part), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("tree")).alias("nodes"),
    )
    placed_rows = numbered.withColumn("_part", F.shiftright("_row", 33)).join(runs, ["tree", "_part"])
    at = F.col("_row") - F.col("_first") + F.col("_before")
    return placed_rows.withColumn("at", at).drop("_row", "_part", "_first", "_before")


def blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"at div {BLOCK}"))


# --- up and down ----------------------------------------------------------------------


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by("at")


def _block_root(key: tuple, table: pa.Table) -> pa.Table:
    table = _ordered(table)
    digests, nodes = table["digest"].to_pylist(), table["nodes"][0].as_py()
    levels = block_levels(digests, nodes)
    root = levels[-1][0].digest if levels else digests[0]
    row = {"tree": key[0].as_py(), "at": key[1].as_py(), "nodes": -(-nodes // BLOCK), "digest": root}
    return pa.Table.from_pylist([row])


def lifted(nodes: DataFrame) -> list[DataFrame]:
    """The nodes at the foot of each layer of blocks, from the leaves to the roots of the trees.

    Only the size of the largest tree comes to the driver.
    """
    layers = [nodes.select("tree", "at", "nodes", "digest")]
    largest = nodes.agg(F.max("nodes")).head()[0] or 0
    while True:
        up = blocks(layers[-1]).groupBy("tree", "block").applyInArrow(
            _block_root, "tree string, at long, nodes long, digest string"
        )
        layers.append(stage(up, "merkle-layer"))
        largest = -(-largest // BLOCK)
        if largest <= 1:
            return layers


def _node_paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """For each node of a block the runs from it to the root: those in the block, then those above it."""
    nodes = _ordered(nodes)
    lefts_above, rights_above = above["lefts"][0].as_py(), above["rights"][0].as_py()
    levels = block_levels(nodes["digest"].to_pylist(), nodes["nodes"][0].as_py())
    rows = []
    for at, position in enumerate(nodes["at"].to_pylist()):
        sides = [parent.siblings(slot) for parent, slot in steps_up(levels, at)]
        rows.append((position, [left for left, _ in sides] + lefts_above, [right for _, right in sides] + rights_above))
    return pa.table(
        {
            "tree": nodes["tree"],
            "at": pa.array([row[0] for row in rows], pa.int64()),
            "lefts": pa.array([row[1] for row in rows], pa.list_(pa.string())),
            "rights": pa.array([row[2] for row in rows], pa.list_(pa.string())),
        }
    )


def _meet(nodes: DataFrame, above: DataFrame, do, schema: str) -> DataFrame:
    """Each block of nodes with the path of its root."""
    return blocks(nodes).groupBy("tree", "block").cogroup(above.groupBy("tree", "at")).applyInArrow(do, schema)


def block_paths(layers: list[DataFrame], of_roots: DataFrame) -> DataFrame:
    """``tree``, ``at`` and :data:`PATH` of the root of each lowest block; ``of_roots`` has those of the trees' roots."""
    above = of_roots
    for nodes in reversed(layers[1:-1]):
        above = _meet(nodes, above, _node_paths, f"tree string, at long, {PATH}")
    return above


def _fold_block(leaves: pa.Table, above: pa.Table) -> pa.Table:
    """Fold every leaf's replacement up to the root of the table, and hash the siblings on the way."""
    leaves = _ordered(leaves)
    lefts, rights = above["lefts"][0].as_py(), above["rights"][0].as_py()
    digests, nodes = leaves["digest"].to_pylist(), leaves["nodes"][0].as_py()
    levels = block_levels(digests, nodes)
    root = levels[-1][0].digest if levels else digests[0]
    # Above the block all leaves share their runs: one state a level serves them all.
    states, digest, within = [], root, above["within"][0].as_py()
    subroot = root if not within else None
    for level, (left, right) in enumerate(zip(lefts, rights)):
        state = hashlib.sha256(left.encode())
        states.append((state, right))
        digest = resumed(state, digest, right)
        if level + 1 == within:
            subroot = digest
    upper_siblings = "".join(left + right for left, right in zip(lefts, rights)).encode()
    proofs, folded = [], []
    for at, replacement in enumerate(leaves["replacement"].to_pylist()):
        proof = hashlib.sha256()
        for parent, slot in steps_up(levels, at):
            left, right = parent.siblings(slot)
            proof.update((left + right).encode())
            replacement = resumed(parent.states[slot], replacement, right)
        proof.update(upper_siblings)
        for state, right in states:
            replacement = resumed(state, replacement, right)
        proofs.append(proof.hexdigest())
        folded.append(replacement)
    count = leaves.num_rows
    return pa.table(
        {
            "doc_id": leaves["doc_id"],
            "leaf": leaves["digest"],
            "subroot": pa.array([subroot] * count, pa.string()),
            "root": pa.array([digest] * count, pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folded, pa.string()),
            "verified": pa.array([value == digest for value in folded], pa.bool_()),
        }
    )


# --- the table ------------------------------------------------------------------------


def encoded(column: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(docs: DataFrame, text: Column) -> Column:
    cells = [encoded(text if name == "text" else docs[name]) for name in FIELDS]
    return F.sha2(F.concat(*cells), 256)


def tampered_leaf(docs: DataFrame) -> Column:
    """The leaf of a row whose text was lower-cased (A-Z) where 3 divides crc32 of the id."""
    chosen = F.coalesce(F.crc32(docs["doc_id"].cast("string")) % 3 == 0, F.lit(False))
    changed = leaf_digest(docs, F.translate(docs["text"], UPPER, LOWER))
    return F.when(chosen & docs["text"].isNotNull(), changed)


def manifest(docs: DataFrame, replacement: Column | None = None) -> DataFrame:
    """Leaf, roots and proof of every row, and the root when ``replacement`` stands in for the leaf.

    ``replacement`` is a hex digest over the columns of ``docs``, null where the leaf stays. Result:
    ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, one row for each row of ``docs``.
    """
    leaf = leaf_digest(docs, docs["text"])
    # Nulls sort first, other values by their bytes.
    tree = F.when(docs["lang"].isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), docs["lang"]))
    changed = F.lit(None).cast("string") if replacement is None else replacement
    rows = docs.select(tree.alias("tree"), "doc_id", leaf.alias("digest"), changed.alias("replacement"))
    rows = rows.withColumn("replacement", F.coalesce("replacement", "digest"))
    # Texts are read once; the sample for the range bounds is taken from the digests.
    with staged(rows, "merkle-leaves") as digests:
        leaves = stage(placed(digests, "doc_id", "digest"), "merkle-placed")
    layers = lifted(leaves)
    subroots = layers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("doc_id"), "digest")
    roots = stage(placed(subroots, "doc_id"), "merkle-roots")
    none = F.array().cast("array<string>")
    top = lifted(roots)
    ends = top[-1].select("tree", "at", none.alias("lefts"), none.alias("rights"))
    of_trees = _meet(roots.select("tree", "at", "nodes", "digest"), block_paths(top, ends), _node_paths,
                     f"tree string, at long, {PATH}")
    above_trees = stage(
        of_trees.join(roots.select("at", "doc_id"), "at").select(F.col("doc_id").alias("tree"), F.lit(0).cast("long").alias("at"), "lefts", "rights"),
        "merkle-root-paths",
    )
    # Runs inside the language come first in a path; their number tells where the subroot is.
    heights = above_trees.select("tree", F.size("lefts").alias("_upper"))
    above = block_paths(layers, above_trees).join(heights, "tree")
    above = above.select("tree", "at", "lefts", "rights", (F.size("lefts") - F.col("_upper")).alias("within"))
    id_type = leaves.schema["doc_id"].dataType.simpleString()
    return _meet(
        leaves, above, _fold_block,
        f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )
