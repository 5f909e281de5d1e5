"""Alarm rules evaluated over the metrics table (AGG-20)."""

from __future__ import annotations

import math
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.functions import scalars
from gaugeworks.operators.joins import join_dimension
from gaugeworks.operators.metrics import LAST_COMPUTED
from gaugeworks.sources.schemas import ALARM_RULE

BELOW = "LessThanThreshold"
ABOVE = "GreaterThanThreshold"
AT_LEAST = "GreaterThanOrEqualToThreshold"
AT_MOST = "LessThanOrEqualToThreshold"
BREACHING = "breaching"
NOT_BREACHING = "notBreaching"
GOLD_MAX_AGE_SECONDS = 7200
# The fields of a rule, in the order of its tuple.
ALARM_RULE_NAMES = tuple(ALARM_RULE.names)


def default_rules(as_of: str | datetime, gold_metric: str = LAST_COMPUTED) -> list[tuple]:
    """The five standard rules. Gold is stale when it was last computed more
    than two hours before ``as_of``; with ``gold_metric=LAST_UPDATE``, when its
    newest date began before that."""
    at = datetime.fromisoformat(str(as_of)).replace(tzinfo=timezone.utc)
    oldest_gold = at.timestamp() - GOLD_MAX_AGE_SECONDS
    # Rule, metric, statistic, period, periods, comparison,
    # threshold, treatment of missing data, dimensions.
    return [
        ("ingestion-stale", "RecordsIngested", "Sum", 300, 1, BELOW, 1.0, BREACHING, {}),
        ("pipeline-errors", "PipelineErrors", "Sum", 300, 1, AT_LEAST, 1.0, NOT_BREACHING, {}),
        ("stream-lag", "GetRecords.IteratorAgeMilliseconds", "Maximum", 300, 1, ABOVE, 60000.0, NOT_BREACHING, {}),
        ("storage-errors", "5xxErrors", "Sum", 300, 1, AT_LEAST, 1.0, NOT_BREACHING, {}),
        ("gold-stale", gold_metric, "Maximum", 3600, 2, BELOW, oldest_gold, BREACHING, {}),
    ]


STATISTICS = ("Sum", "Average", "Maximum", "Minimum", "SampleCount")
KNOWN = {"statistic": STATISTICS, "comparison": (BELOW, ABOVE, AT_LEAST, AT_MOST), "missing_data": (BREACHING, NOT_BREACHING)}


def rules_frame(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    """Rules as a frame; a value that no rule may have is an error, not a rule that is never in ALARM."""
    for rule in rules:
        named = dict(zip(ALARM_RULE_NAMES, rule, strict=True))
        for field, values in KNOWN.items():
            if named[field] not in values:
                raise ValueError(f"rule {named['rule']!r}: {field} {named[field]!r} is none of {values}")
    return spark.createDataFrame(rules, ALARM_RULE)


def rules_per_device(
    devices: DataFrame, metric: str, statistic: str, period: int, periods: int, comparison: str, threshold: float, missing: str
) -> DataFrame:
    """One rule of the same kind for each ``device_id`` of a table, however many there are; null is left out."""
    rules_frame(devices.sparkSession, [("check", metric, statistic, period, periods, comparison, threshold, missing, {})])
    device = F.col("device_id")
    values = (F.concat(F.lit(f"{metric}-"), device), *map(F.lit, (metric, statistic, period, periods, comparison, threshold, missing)),
              F.create_map(F.lit("DeviceId"), device))
    known = devices.select("device_id").filter(device.isNotNull()).distinct()
    return known.select(*[v.cast(f.dataType).alias(f.name) for v, f in zip(values, ALARM_RULE.fields, strict=True)])


def _period_start(ts) -> F.Column:
    """Start of the rule's period, in epoch seconds."""
    seconds = F.unix_seconds(ts)
    return seconds - F.pmod(seconds, F.col("period_seconds"))


def _summed(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """One row for each metric, dimensions and stretch of time that all periods are multiples of."""
    periods = [row[0] for row in rules.select("period_seconds").distinct().collect()]  # the few lengths in use
    shared = math.gcd(*periods) or 1
    seconds = F.unix_seconds("ts")
    return (
        metrics.withColumn("_bucket", seconds - F.pmod(seconds, F.lit(shared)))
        .groupBy("metric_name", F.array_sort(F.map_entries("dimensions")).alias("_entries"), "_bucket")
        .agg(
            F.sum("value").alias("_sum"), F.max("value").alias("_max"), F.min("value").alias("_min"),
            F.count("value").alias("_n"),
        )
        .withColumn("dimensions", F.map_from_entries("_entries"))
    )


def _in_scope(summed: DataFrame, wanted: DataFrame) -> DataFrame:
    """Sums with the rules that may apply. A rule with dimensions is looked up by one of
    them, so with a rule for each device a sum meets the rules of its own device only."""
    first = F.get(F.array_sort(F.map_entries("rule_dimensions")), 0)
    wanted = wanted.withColumn("_key", first["key"]).withColumn("_value", first["value"])
    plain, keyed = wanted.filter("_key IS NULL"), wanted.filter("_key IS NOT NULL")
    each = summed.withColumn("_entry", F.explode("_entries")).withColumn("_key", F.col("_entry.key"))
    each = each.withColumn("_value", F.col("_entry.value")).drop("_entry")
    everything = join_dimension(summed, plain.drop("_key", "_value"), ["metric_name"])
    by_key = join_dimension(each, keyed, ["metric_name", "_key", "_value"])
    return everything.unionByName(by_key.select(*everything.columns))


def evaluate(metrics: DataFrame, rules: DataFrame, start, end) -> DataFrame:
    """State of each rule for each period in [start, end).

    A rule without dimensions sums over all of a metric; one with dimensions
    takes the matching rows. A rule is in ALARM when its last
    ``evaluation_periods`` periods all breach; the missing-data policy decides
    for periods without a value. The spine has a row per rule and period, so its
    size follows from the time range and not from the number of metric rows.
    """
    start, end = scalars.moment(start), scalars.moment(end)
    # The newest period may be cut off by `end`; only whole periods are judged.
    spine = rules.withColumn("_first", _period_start(start)).withColumn(
        "_last", _period_start(end) - F.col("period_seconds")
    )
    spine = spine.filter(F.col("_last") >= F.col("_first")).withColumn(
        "_period", F.explode(F.sequence("_first", "_last", "period_seconds"))
    )
    in_scope = F.forall(
        F.map_entries("rule_dimensions"), lambda e: F.coalesce(F.try_element_at("dimensions", e["key"]) == e["value"], F.lit(False))
    )
    wanted = rules.select("rule", "metric_name", "period_seconds", F.col("dimensions").alias("rule_dimensions"))
    measured = (
        _in_scope(_summed(metrics.filter((F.col("ts") >= start) & (F.col("ts") < end)), rules), wanted)
        .filter(in_scope)
        .groupBy("rule", _period_start(F.timestamp_seconds("_bucket")).alias("_period"))
        .agg(
            F.sum("_sum").alias("Sum"),
            F.max("_max").alias("Maximum"),
            F.min("_min").alias("Minimum"),
            F.sum("_n").cast("double").alias("SampleCount"),
        )
        .withColumn("Average", F.try_divide("Sum", "SampleCount"))
    )
    value = F.coalesce(*[F.when(F.col("statistic") == name, F.col(name)) for name in STATISTICS])
    breach = (
        F.when(F.col("comparison") == BELOW, F.col("value") < F.col("threshold"))
        .when(F.col("comparison") == ABOVE, F.col("value") > F.col("threshold"))
        .when(F.col("comparison") == AT_LEAST, F.col("value") >= F.col("threshold"))
        .when(F.col("comparison") == AT_MOST, F.col("value") <= F.col("threshold"))
    )
    judged = (
        spine.join(measured, ["rule", "_period"], "left")
        .withColumn("value", value)
        .withColumn("breaching", F.coalesce(breach, F.col("missing_data") == BREACHING))
    )
    # A run of breaching periods is counted from the last period that did not breach.
    by_time = Window.partitionBy("rule").orderBy("_period")
    last_fine = F.max(F.when(~F.col("breaching"), F.col("_period"))).over(by_time)
    run = (F.col("_period") - F.coalesce(last_fine, F.col("_first") - F.col("period_seconds"))) / F.col("period_seconds")
    return judged.withColumn("_run", run).select(
        "rule",
        F.timestamp_seconds("_period").alias("period_start"),
        "value",
        "breaching",
        F.when(F.col("_run") >= F.col("evaluation_periods"), "ALARM").otherwise("OK").alias("state"),
    )
