"""Keyed upsert into a Parquet table (SNK-4, SNK-5, JOIN-1).

The table is partitioned by ``_key_block``, a range of entry ids. Entry ids grow
with time, so a batch touches few blocks; only those are read and rewritten. How
many ids make a block is fixed when the table is made and stored beside it.
Executors may be lost at any point of a write. Merged blocks are written beside the
table first and stay there until they have replaced the old ones, so a driver
lost during the swap loses nothing: the next upsert finishes the swap. One
writer at a time; there is no transaction log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks import settings
from gaugeworks.operators.blocks import has_directory, read_blocks
from gaugeworks.operators.joins import merge_rows
from gaugeworks.session import delete_path, path_exists, stage, staged, touch
from gaugeworks.sources.tables import read_if_exists

BLOCK = "_key_block"
NO_BLOCK = -1
ORDER = (BLOCK, "device_id", "entry_id")


def key_block(size: int) -> Column:
    """Block of an entry id; ids that are null share one block."""
    # Integer arithmetic: large ids are not exact as doubles.
    return F.expr(f"coalesce((entry_id - pmod(entry_id, {size}L)) div {size}L, {NO_BLOCK}L)")


def _size_path(path: str) -> str:
    # Names with an underscore are not read as data.
    return f"{path.rstrip('/')}/_block_size"


def _stored_size(spark: SparkSession, path: str) -> int:
    return spark.read.schema("block_size bigint").json(_size_path(path)).head()["block_size"]


def _store_size(spark: SparkSession, path: str, size: int) -> None:
    spark.range(1).select(F.lit(size).alias("block_size")).write.mode("overwrite").json(_size_path(path))


def fitting_block_size(batch: DataFrame) -> int:
    """Entry ids per block, so that blocks of a table like ``batch`` hold about
    ``KEY_BLOCK_ROWS`` rows and ``batch`` makes no more than
    ``KEY_BLOCK_MAX_COUNT`` of them."""
    ids = batch.agg(
        F.count("entry_id").alias("rows"), F.min("entry_id").alias("low"), F.max("entry_id").alias("high")
    ).head()
    if not ids["rows"]:
        return settings.KEY_BLOCK_ROWS
    span = ids["high"] - ids["low"] + 1
    by_rows = span * settings.KEY_BLOCK_ROWS // ids["rows"]
    return min(max(by_rows, span // settings.KEY_BLOCK_MAX_COUNT, 1), 2**62)


def _write_blocks(df: DataFrame, path: str) -> None:
    (
        df.hint("rebalance", BLOCK)
        .sortWithinPartitions(*ORDER)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BLOCK)
        .parquet(path)
    )


def _swap_path(path: str) -> str:
    # Not read as data, like the block size.
    return f"{path.rstrip('/')}/_swap"


def _replace_blocks(merged: DataFrame, path: str) -> None:
    """Write the merged blocks beside the table, then swap them in."""
    spark, swap = merged.sparkSession, _swap_path(path)
    _write_blocks(merged, f"{swap}/blocks")
    touch(spark, f"{swap}/ready")
    finish_swap(spark, path)


def finish_swap(spark: SparkSession, path: str) -> None:
    """Swap in complete blocks that wait beside the table; drop incomplete ones."""
    swap = _swap_path(path)
    if path_exists(spark, f"{swap}/ready"):
        blocks = read_if_exists(spark, f"{swap}/blocks")
        if blocks is not None:
            _write_blocks(blocks, path)
    delete_path(spark, swap)


def touched_target(target: DataFrame, batch: DataFrame, max_values: int = settings.PRUNE_MAX_VALUES) -> DataFrame:
    """The target's rows in blocks that the batch touches.

    At most ``max_values + 1`` block ids come to the driver. If there are more,
    a semi join selects the blocks instead.
    """
    blocks = batch.select(BLOCK).distinct()
    ids = [row[0] for row in blocks.take(max_values + 1)]
    if len(ids) <= max_values:
        return target.filter(F.col(BLOCK).isin(ids)) if ids else target.limit(0)
    return target.join(blocks, BLOCK, "left_semi")


def read_upserted(spark: SparkSession, path: str) -> DataFrame | None:
    if has_directory(spark, path):
        return read_blocks(spark, path)
    table = read_if_exists(spark, path)
    return None if table is None else table.drop(BLOCK)


def replaced_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The target rows the batch is about to replace."""
    complete = F.col("device_id").isNotNull() & F.col("entry_id").isNotNull()
    return target.filter(complete).join(batch.filter(complete).select(*settings.KEYS), list(settings.KEYS), "left_semi")


def upsert(
    batch: DataFrame,
    path: str,
    block_size: int | None = None,
    null_safe: bool = False,
    track_dates: bool = False,
    on_dates: Callable[[DataFrame], None] | None = None,
) -> DataFrame | None:
    """Insert or replace the rows of ``batch``, which holds each key once.

    Creates the table on first use, with ``block_size`` ids per block or, if
    none is given, as many as fit the batch. The batch is staged first: it is
    computed once, and it may itself read the table it goes into.

    With ``track_dates`` the result holds all dates whose readings changed:
    those of the batch and those the replaced rows had before. ``on_dates``
    receives them before any block is replaced: a rerun after a failure can no
    longer see the former dates.
    """
    spark = batch.sparkSession
    finish_swap(spark, path)
    with staged(batch, "upsert-batch") as rows:
        target = read_if_exists(spark, path)
        if target is None:
            size = block_size or fitting_block_size(rows)
            _store_size(spark, path, size)
        else:
            size = _stored_size(spark, path)
        blocked = rows.withColumn(BLOCK, key_block(size))
        touched = None if target is None else touched_target(target, blocked)
        dates = _changed_dates(rows, touched) if track_dates or on_dates else None
        if on_dates is not None:
            on_dates(dates)
        merged = blocked if touched is None else merge_rows(touched, blocked, null_safe=null_safe)
        _replace_blocks(merged, path)
    return dates


def _changed_dates(rows: DataFrame, touched: DataFrame | None) -> DataFrame:
    times = rows.select("recorded_at")
    if touched is not None:
        times = times.unionByName(replaced_rows(touched, rows).select("recorded_at"))
    # Staged, because the replaced rows are gone after the write.
    return stage(times.select(F.to_date("recorded_at").alias("date")).distinct(), "changed-dates")
