"""File layout: compaction and clustering (SNK-7).

Rows are clustered along a Z-order curve by default: the bits of the columns' ranks
are interleaved, so each file holds a box that is narrow in all of them, and a filter
on any one column can skip most files. Compacted partitions are written beside the
table and moved in one by one; a move that was cut is finished by the next run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import delete_path, list_folders, move_path, path_exists, touch
from gaugeworks.sources.tables import read_table

#: A partition with so few files, or with files of this size, is left as it is.
FEW_FILES, SMALL_BYTES = 4, 64 << 20
#: Bits of a column's rank in the Z-order key, and sampled values for each of its ranges.
RANK_BITS, SAMPLE_PER_RANGE = 8, 32


def file_layout(df: DataFrame) -> DataFrame:
    """Number of data files and their mean size, to see whether compaction pays."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.count(F.lit(1)).alias("files"), F.avg("file_size").alias("mean_bytes"))


def fragmented(table: DataFrame, partition_col: str, files: int = FEW_FILES, size: int = SMALL_BYTES) -> list:
    """Partitions that hold more than ``files`` files which on average are smaller than ``size``.

    Names and sizes come from the file listing; one value for each partition is returned.
    """
    each = table.select(partition_col, "_metadata.file_path", "_metadata.file_size").distinct()
    counted = each.groupBy(partition_col).agg(F.count(F.lit(1)).alias("n"), F.avg("file_size").alias("bytes"))
    return [row[0] for row in counted.filter((F.col("n") > files) & (F.col("bytes") < size)).collect()]


def clustered(df: DataFrame, *by: str, partitions: int | None = None) -> DataFrame:
    """Range-partitioned and sorted by the given columns.

    Range bounds come from a sample, so a busy device or day is split over
    several files. Without ``partitions`` adaptive execution picks the number
    from the data size.
    """
    spread = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return spread.sortWithinPartitions(*by)


# --- Z-order --------------------------------------------------------------------------


def rank_in(value: Column, bounds: Column, bits: int) -> Column:
    """How many of ``2 ** bits - 1`` sorted ``bounds`` are at most ``value``, by binary search; null has rank 0."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])

    def narrow(rank: Column, step: Column) -> Column:
        return F.when(F.coalesce(F.get(bounds, rank + step - 1) <= value, F.lit(False)), rank + step).otherwise(rank)

    return F.aggregate(steps, F.lit(0), narrow)


def interleaved(ranks: list[Column], bits: int) -> Column:
    """The Z-order key: bit i of column j goes to place ``i * columns + j``, the first column highest."""
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(reversed(ranks)):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranks) + place))
    return key


def range_bounds(table: DataFrame, partition_col: str, by: list[str], bits: int) -> DataFrame:
    """For each partition, ``2 ** bits - 1`` quantiles of every column, from a sample of bounded size.

    Ranks are taken within the partition: a date spans few of the ranges that all dates make. The sample
    holds about ``SAMPLE_PER_RANGE << bits`` rows of a partition, however large it is; one count for each
    partition comes to the driver, from the listing and the footers.
    """
    named = table.select(F.coalesce(F.col(partition_col).cast("string"), F.lit("")).alias("_part"), partition_col, *by)
    counts = {row[0]: row[1] for row in named.groupBy("_part").count().collect()}
    enough = SAMPLE_PER_RANGE << bits
    sample = named.sampleBy("_part", {part: min(1.0, enough / n) for part, n in counts.items()}, seed=11)
    places = F.sequence(F.lit(1), F.lit((1 << bits) - 1))

    def quantiles(name: str) -> Column:
        values = F.sort_array(F.collect_list(name))
        # An empty array gives nulls, which no value reaches.
        return F.transform(places, lambda i: F.get(values, F.floor(i * F.size(values) / (1 << bits)).cast("int")))

    return sample.groupBy(partition_col).agg(*[quantiles(name).alias(f"_{name}_bounds") for name in by])


def zordered(
    table: DataFrame, partition_col: str, by: list[str], partitions: int | None = None, bits: int = RANK_BITS
) -> DataFrame:
    """Range-partitioned and sorted along the Z-order curve of ``by`` within each partition of the table.

    Rows of one cell of the curve are ordered by the columns themselves, so a cell that
    holds very many rows is still split over several files.
    """
    bounds = range_bounds(table, partition_col, by, bits)
    other = bounds.withColumnRenamed(partition_col, "_bounds_of")
    same = F.col(partition_col).eqNullSafe(F.col("_bounds_of"))
    ranked = table.join(other, same, "left").withColumn(
        "_z", interleaved([rank_in(F.col(name), F.col(f"_{name}_bounds"), bits) for name in by], bits)
    )
    ranked = ranked.select(*table.columns, "_z")
    return clustered(ranked, partition_col, "_z", *by, partitions=partitions).drop("_z")


# --- compaction -----------------------------------------------------------------------


def _swap_path(path: str) -> str:
    # Names with an underscore are not read as data.
    return f"{path.rstrip('/')}/_compacted"


def finish_swap(spark: SparkSession, path: str) -> None:
    """Move complete partitions that wait beside the table into it; drop incomplete ones.

    A partition's old folder goes just before the new one takes its name. If the
    driver is lost between the two, the new one still waits, and the next call moves it.
    """
    waiting = _swap_path(path)
    if path_exists(spark, f"{waiting}/ready"):
        for folder in list_folders(spark, f"{waiting}/table"):
            _replace_folder(spark, f"{waiting}/table/{folder}", f"{path.rstrip('/')}/{folder}")
    delete_path(spark, waiting)


def _replace_folder(spark: SparkSession, new: str, old: str) -> None:
    delete_path(spark, old)
    move_path(spark, new, old)


def compact(
    spark: SparkSession,
    path: str,
    partition_col: str,
    *by: str,
    target: str | None = None,
    partitions: int | None = None,
    only: list | None = None,
    zorder: bool = False,
) -> None:
    """Rewrite a partitioned table with few, sorted files per partition.

    Rows are ordered by one column after the other, or with ``zorder`` along the
    Z-order curve of all of them. In place by default; with ``target`` the result
    goes elsewhere and the source stays untouched. ``only`` names the partitions to
    rewrite; all others are neither read nor written.
    """
    finish_swap(spark, path)
    table = read_table(spark, path)
    if only is not None:
        hit = F.col(partition_col).isin([v for v in only if v is not None])
        table = table.filter(hit | F.col(partition_col).isNull() if None in only else hit)
    if zorder:
        laid = zordered(table, partition_col, list(by), partitions)
    else:
        laid = clustered(table, *dict.fromkeys([partition_col, *by]), partitions=partitions)
    if target:
        _write_partitions(laid, partition_col, target)
        return
    waiting = _swap_path(path)
    _write_partitions(laid, partition_col, f"{waiting}/table")
    touch(spark, f"{waiting}/ready")
    finish_swap(spark, path)


def _write_partitions(df: DataFrame, partition_col: str, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def files_to_read(table: DataFrame, column: str, value) -> DataFrame:
    """How many of a table's files a filter ``column = value`` has to read, by the files' ranges of the column."""
    ranges = table.groupBy("_metadata.file_path").agg(F.min(column).alias("low"), F.max(column).alias("high"))
    hit = (F.col("low") <= F.lit(value)) & (F.col("high") >= F.lit(value))
    return ranges.agg(F.count_if(hit).alias("read"), F.count(F.lit(1)).alias("files"))
