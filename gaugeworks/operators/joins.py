"""Joins of a large side with a dimension (JOIN-2) and the keyed merge (JOIN-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from gaugeworks import settings

SALTS = 64


def join_dimension(
    facts: DataFrame, dimension: DataFrame, on: list[str], max_rows: int = settings.BROADCAST_MAX_ROWS
) -> DataFrame:
    """Inner join, 1:N where the dimension repeats a key.

    The dimension is broadcast when a count of at most ``max_rows + 1`` rows
    shows that it is small. Otherwise both sides are shuffled on the key and a
    salt, so that a hot key is spread over several tasks.
    """
    if dimension.limit(max_rows + 1).count() <= max_rows:
        return facts.join(F.broadcast(dimension), on)
    return salted_join(facts, dimension, on)


def _hashable(kind: DataType) -> bool:
    """Maps and variants have no hash, nor has anything that holds one."""
    if isinstance(kind, StructType):
        return all(_hashable(field.dataType) for field in kind)
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, MapType | VariantType)


def salted_join(facts: DataFrame, dimension: DataFrame, on: list[str], salts: int = SALTS) -> DataFrame:
    """Each key of the dimension is repeated per salt; facts take one salt each, by a
    hash of all columns that have one: rows of a hot key may all lie in one partition.

    Spark takes the repeated side for as small as it was before, and would broadcast it; the hint keeps it off the driver."""
    plain = [F.col(f"`{field.name}`") for field in facts.schema if _hashable(field.dataType)]
    salted_facts = facts.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int"))
    repeated = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_facts.join(repeated.hint("merge"), [*on, "_salt"]).drop("_salt")


def merge_rows(
    target: DataFrame, batch: DataFrame, keys: tuple[str, ...] = settings.KEYS, null_safe: bool = False
) -> DataFrame:
    """Target rows replaced by the batch row of the same key, new keys added.

    ``batch`` holds each key at most once. A key with a null never matches, so
    such target rows stay and such batch rows are added; ``null_safe=True``
    treats nulls as equal. Target rows with a null key bypass the join: they
    would all meet in one task.
    """
    if null_safe:
        same = [F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
        return target.alias("t").join(batch.alias("b"), same, "left_anti").unionByName(batch)
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    batch_keys = batch.filter(complete).select(*keys)
    kept = target.filter(complete).join(batch_keys, list(keys), "left_anti")
    return kept.unionByName(target.filter(~complete)).unionByName(batch)
