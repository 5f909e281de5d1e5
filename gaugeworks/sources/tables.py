"""Tables by path or by name, and SQL over them (SRC-4, SRC-5, SNK-3, SNK-6).

A reference with a slash is a Parquet folder; without one it is a catalog table.
"""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from gaugeworks.session import delete_path, pin_utc

MISSING_CONDITIONS = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
#: Fixed value: the folder of the partition whose value is null.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
WRITE_MODES = ("append", "overwrite", "error", "ignore", "overwrite_partitions")


def is_path(ref: str) -> bool:
    return "/" in ref


def read_table(spark: SparkSession, ref: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(ref) if is_path(ref) else spark.table(ref)


def read_if_exists(spark: SparkSession, ref: str) -> DataFrame | None:
    try:
        return read_table(spark, ref)
    except AnalysisException as error:
        if error.getCondition() in MISSING_CONDITIONS:
            return None
        raise


def write_table(df: DataFrame, ref: str, mode: str = "append", partition_cols: tuple[str, ...] = ()) -> None:
    """Write by path or name. ``overwrite_partitions`` replaces only the
    partitions that occur in ``df``; all others stay as they are.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode {mode!r} is none of {WRITE_MODES}")
    if mode == "overwrite_partitions":
        _overwrite_partitions(df, ref, partition_cols)
        return
    writer = df.write.mode(mode).partitionBy(*partition_cols)
    if is_path(ref):
        writer.parquet(ref)
    else:
        writer.format("parquet").saveAsTable(ref)


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """insertInto takes this mode from the session only."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _overwrite_partitions(df: DataFrame, ref: str, partition_cols: tuple[str, ...]) -> None:
    if not partition_cols:
        raise ValueError("overwrite_partitions needs partition columns")
    # Rebalancing gives each partition value few files, and splits a value that
    # holds most of the rows over several tasks.
    spread = df.hint("rebalance", *partition_cols)
    dynamic = spread.write.option("partitionOverwriteMode", "dynamic")
    spark = df.sparkSession
    if is_path(ref):
        dynamic.mode("overwrite").partitionBy(*partition_cols).parquet(ref)
    elif spark.catalog.tableExists(ref):
        # saveAsTable would drop the other partitions; insertInto goes by position.
        columns = spark.table(ref).columns
        with _dynamic_overwrite(spark):
            spread.select(*columns).write.insertInto(ref, overwrite=True)
    else:
        spread.write.partitionBy(*partition_cols).format("parquet").saveAsTable(ref)


def drop_partitions(spark: SparkSession, ref: str, column: str, values: Iterable) -> None:
    """Delete whole partitions of a table by path or name; None stands for the null partition."""
    for value in values:
        if is_path(ref):
            delete_path(spark, f"{ref.rstrip('/')}/{column}={NULL_PARTITION if value is None else value}")
        else:
            wanted = "null" if value is None else f"'{value}'"
            spark.sql(f"ALTER TABLE {ref} DROP IF EXISTS PARTITION ({column} = {wanted})")


def run_sql(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None, **args) -> DataFrame:
    """SQL text over named frames. ``:name`` markers take ``args``."""
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    return pin_utc(spark).sql(text, args=args or None)
