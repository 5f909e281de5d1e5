"""One Silver step: measure, clean, de-duplicate, upsert."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from gaugeworks.operators import quality
from gaugeworks.operators.blocks import has_directory, upsert_blocks
from gaugeworks.operators.cleanse import clean, latest_delivery, stamp_updated
from gaugeworks.operators.upsert import upsert
from gaugeworks.session import path_exists

OUTPUT_RULES = quality.STANDARD_RULES + quality.PHYSICAL_RULES


@dataclass(frozen=True)
class SilverStep:
    """What a step found: check results."""

    quality: DataFrame


def apply_batch(
    bronze: DataFrame,
    silver: str,
    block_size: int | None = None,
    null_safe: bool = True,
    on_dates: Callable[[DataFrame], None] | None = None,
    split_blocks: bool = False,
) -> SilverStep:
    """The standard battery is measured before nulls become sentinels, where it
    can fail; the range checks are measured on the rows that are written. Both
    ride along with the write. ``on_dates`` receives the dates whose readings change,
    before they do. ``split_blocks`` makes a new table of blocks that split as they grow;
    a table keeps the form it was made in."""
    spark, run = bronze.sparkSession, uuid.uuid4().hex
    incoming, before = quality.watch(bronze, f"bronze-{run}")
    rows, after = quality.watch(latest_delivery(clean(incoming)), f"silver-{run}", OUTPUT_RULES)
    stamped = stamp_updated(rows)
    if has_directory(spark, silver) or (split_blocks and not path_exists(spark, silver)):
        upsert_blocks(stamped, silver, null_safe=null_safe, on_dates=on_dates)
    else:
        upsert(stamped, silver, block_size, null_safe, on_dates=on_dates)
    found = quality.observed_results(spark, "bronze_sensors", before.get).unionByName(
        quality.observed_results(spark, "silver_sensors", after.get, OUTPUT_RULES)
    )
    return SilverStep(found)
