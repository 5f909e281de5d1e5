"""Exact percentiles per group without gathering a group in one task.

``percentile`` keeps all distinct values of a group in one buffer. Here a small
sketch first gives a band of values that must hold the wanted rank; only rows in
the band are ranked, and rows below it are merely counted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.operators.joins import join_dimension

ACCURACY = 10_000
# The sketch's rank error is 1/ACCURACY of the group; the band is wider than that.
SLACK = 4 / ACCURACY


def band_sketch(value: str, p: float) -> Column:
    """Mergeable, fixed-size bounds around the percentile ``p``."""
    bounds = [max(p - SLACK, 0.0), min(p + SLACK, 1.0)]
    return F.percentile_approx(value, bounds, ACCURACY)


def exact_percentile(df: DataFrame, groups: DataFrame, keys: list[str], value: str, p: float, alias: str) -> DataFrame:
    """Linear-interpolated percentile per group, as ``percentile`` defines it.

    ``groups`` has one row per key with the count ``n`` of non-null values and
    ``band`` from :func:`band_sketch`; it is read twice and should be staged.
    Groups with fewer than ACCURACY values are ranked whole. Null where the band does not hold the rank.
    """
    wide = F.col("n") < ACCURACY
    bounds = groups.select(
        *keys,
        "n",
        F.when(~wide, F.col("band")[0]).alias("_from"),
        F.when(~wide, F.col("band")[1]).alias("_to"),
    )
    rows = join_dimension(df.filter(F.col(value).isNotNull()).select(*keys, value), bounds, keys)
    # Rows below the band fold into one null value, which sorts first.
    within = F.when(F.col("_from").isNull() | (F.col(value) >= F.col("_from")), F.col(value))
    counts = (
        rows.filter(F.col("_to").isNull() | (F.col(value) <= F.col("_to")))
        .select(*keys, "n", within.alias("_value"))
        .groupBy(*keys, "n", "_value")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    running = Window.partitionBy(*keys).orderBy(F.col("_value").asc_nulls_first())
    ranked = counts.withColumn(
        "_upto", F.sum("_copies").over(running.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    position = F.lit(p) * (F.col("n") - 1)
    low = F.min(F.when(F.col("_upto") > F.floor(position), F.col("_value")))
    high = F.min(F.when(F.col("_upto") > F.ceil(position), F.col("_value")))
    folded = F.coalesce(F.max(F.when(F.col("_value").isNull(), F.col("_upto"))), F.lit(0))
    within_band = folded <= F.floor(position)
    picked = ranked.groupBy(*keys, "n").agg(low.alias("_low"), high.alias("_high"), within_band.alias("_held"))
    picked = picked.withColumn("_low", F.when(F.col("_held"), F.col("_low")))
    share = position - F.floor(position)
    return picked.select(*keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * share).alias(alias))
