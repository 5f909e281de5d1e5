"""Bronze to Silver by increments: each new Bronze file once, upserted by key (STR-4)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.plans.silver import SilverStep, apply_batch


def bronze_stream(spark: SparkSession, bronze: str, **options) -> DataFrame:
    """New files of the Bronze table; its schema is taken from what is stored.

    ``options`` go to the file source; ``maxFilesPerTrigger`` bounds a batch.
    """
    schema = spark.read.parquet(bronze).schema
    return spark.readStream.schema(schema).options(**options).parquet(bronze)


def upsert_stream(
    bronze: DataFrame,
    silver: str,
    checkpoint: str,
    block_size: int | None = None,
    null_safe: bool = True,
    on_batch: Callable[[SilverStep], None] | None = None,
    on_dates: Callable[[DataFrame], None] | None = None,
    split_blocks: bool = False,
) -> StreamingQuery:
    """Clean and upsert what is new, then stop.

    Files come in the order they were written, so a later delivery of a reading
    replaces an earlier one. A batch that is replayed after a failure replaces
    its own rows again. ``on_batch`` receives the check results of each batch,
    ``on_dates`` the dates it is about to change.

    By default a null entry id is a key like any other: of a device's readings
    without id the newest stays, however the files fall into batches. With
    ``null_safe=False`` each batch adds its newest one.
    """

    def apply(batch: DataFrame, _: int) -> None:
        step = apply_batch(batch, silver, block_size, null_safe, on_dates, split_blocks)
        if on_batch is not None:
            on_batch(step)

    query = (
        bronze.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
