"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space. ``bytes.split()`` cuts at the same places.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Id and text only, whatever else the table has; a null text is empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def fold_of(folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds, F.lit(0))


def columns(batches: Iterable[pa.RecordBatch], rows: int = 2_000) -> Iterator[tuple[list, ...]]:
    """The columns of each Arrow batch as Python lists, a few rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield tuple(column.to_pylist() for column in part.columns)
