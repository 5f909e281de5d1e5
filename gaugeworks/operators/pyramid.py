"""Metric roll-ups that are stored once and merged upward (AGG-19).

For every metric and five minutes a row holds sum, extremes, count and a mergeable
quantile sketch. An hour or a day is merged from these rows, without the metrics being
read again. The exact percentile needs values, but only those in the narrow band that
the merged sketch leaves open; all periods are refined in one pass. A sketch errs with a
small probability, so a rank outside its band is noticed and searched without one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.joins import join_dimension
from gaugeworks.operators.metrics import DASHBOARD_CURVES, P99, curves_of
from gaugeworks.operators.percentiles import exact_percentile
from gaugeworks.session import stage

#: Seconds of a stored row; coarser periods are multiples of it.
BASE_SECONDS = 300
#: Size of a sketch; its rank error is about 0.2 % of a group at this size, and the band is wider.
SKETCH_SIZE, SLACK = 2_048, 0.005

KEYS = ["metric_name", "period_seconds", "period_start"]


def _start(seconds: Column | int) -> Column:
    at = F.unix_seconds("ts")
    return F.timestamp_seconds(at - F.pmod(at, F.lit(seconds) if isinstance(seconds, int) else seconds))


def base_parts(metrics: DataFrame) -> DataFrame:
    """The rows to store: ``metric_name, part_start, sum, maximum, minimum, n, sketch``; unnamed metrics are left out."""
    named = metrics.filter(F.col("metric_name").isNotNull() & F.col("ts").isNotNull())
    return named.groupBy("metric_name", _start(BASE_SECONDS).alias("part_start")).agg(
        F.sum("value").alias("sum"),
        F.max("value").alias("maximum"),
        F.min("value").alias("minimum"),
        F.count("value").alias("n"),
        F.kll_sketch_agg_double("value", SKETCH_SIZE).alias("sketch"),
    )


def merged(parts: DataFrame, period_seconds: int) -> DataFrame:
    """Stored rows of a coarser period; the sketches are merged, too."""
    if period_seconds % BASE_SECONDS:
        raise ValueError(f"{period_seconds} s is no multiple of {BASE_SECONDS} s")
    figures = parts.withColumn("ts", F.col("part_start"))
    return figures.groupBy(
        "metric_name", F.lit(period_seconds).cast("bigint").alias("period_seconds"), _start(period_seconds).alias("period_start")
    ).agg(
        F.sum("sum").alias("sum"),
        F.max("maximum").alias("maximum"),
        F.min("minimum").alias("minimum"),
        F.sum("n").alias("n"),
        F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"),
    )


def _banded(rolled: DataFrame, p: float, slack: float) -> DataFrame:
    """With the two values between which the sketch places the percentile; extremes where it has nothing."""
    ends = [F.kll_sketch_get_quantile_double("sketch", F.lit(rank)) for rank in (max(p - slack, 0.0), min(p + slack, 1.0))]
    known = F.when(F.col("n") > 0, F.array(*ends))
    return rolled.withColumn("band", known).drop("sketch")


def pyramid(
    metrics: DataFrame, parts: DataFrame, periods: tuple[int, ...], p: float | None = P99, slack: float = SLACK
) -> DataFrame:
    """All periods from the stored ``parts``; ``metrics`` is read only to refine the percentile.

    The columns of :func:`gaugeworks.operators.metrics.rollup`. ``p=None`` leaves the percentile null and
    does not read ``metrics`` at all.
    """
    levels = None
    for seconds in sorted(set(periods)):
        level = merged(parts, seconds)
        levels = level if levels is None else levels.unionByName(level)
    if p is None:
        found = levels.drop("sketch").withColumn("percentile", F.lit(None).cast("double"))
    else:
        groups = stage(_banded(levels, p, slack), "pyramid-groups")
        found = groups.join(_refined(metrics, groups, p), KEYS, "left")
    return found.select(
        *KEYS, "sum", F.try_divide("sum", "n").alias("average"), "maximum", "minimum",
        F.col("n").alias("sample_count"), "percentile",
    )


def _refined(metrics: DataFrame, groups: DataFrame, p: float) -> DataFrame:
    """The exact percentile of each group, from one pass over the metrics for all periods."""
    seconds = [row[0] for row in groups.select("period_seconds").distinct().collect()]  # the few periods asked for
    spans = F.array(*[F.lit(s).cast("bigint") for s in seconds])
    named = metrics.filter(F.col("metric_name").isNotNull() & F.col("ts").isNotNull() & F.col("value").isNotNull())
    rows = named.select("metric_name", "ts", "value", F.explode(spans).alias("period_seconds"))
    rows = rows.select("metric_name", "period_seconds", _start(F.col("period_seconds")).alias("period_start"), "value")
    counted = groups.filter("n > 0").select(*KEYS, "n", "band", "minimum", "maximum")
    found = stage(exact_percentile(rows, counted, KEYS, "value", p, "percentile"), "pyramid-percentiles")
    # A rank that its band does not hold comes back as null.
    missed = counted.join(found.filter("percentile IS NOT NULL"), KEYS, "left_anti")
    if missed.isEmpty():
        return found
    whole = stage(missed.withColumn("band", F.array("minimum", "maximum")), "pyramid-missed")
    again = exact_percentile(join_dimension(rows, whole.select(*KEYS), KEYS), whole, KEYS, "value", p, "percentile")
    return found.filter("percentile IS NOT NULL").unionByName(again)


def stored_curves(metrics: DataFrame, parts: DataFrame, since, until, curves=None) -> DataFrame:
    """The dashboard's curves, at both periods, from the stored rows between two times."""
    wanted = curves or DASHBOARD_CURVES
    names = sorted({name for name, _, _ in wanted})
    ranked = any(statistic == "p99" for _, statistic, _ in wanted)
    stored = parts.filter(F.col("metric_name").isin(names) & (F.col("part_start") >= since) & (F.col("part_start") < until))
    recent = metrics.filter(F.col("metric_name").isin(names) & (F.col("ts") >= since) & (F.col("ts") < until))
    rolled = pyramid(recent, stored, tuple({seconds for _, _, seconds in wanted}), P99 if ranked else None)
    return curves_of(rolled, wanted)
