"""Data quality checks in one pass (AGG-3..8, FLT-2, FLT-3).

All rules of a table become expressions of one global aggregate, or of
``observe`` on a frame that is being written anyway.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugeworks import settings

RESULT_SCHEMA = "table_name string, check_name string, observed double, allowed double, passed boolean"


@dataclass(frozen=True)
class MinRows:
    minimum: int = 1

    @property
    def name(self) -> str:
        return "min_row_count"

    def measure(self) -> Column:
        return F.count(F.lit(1)).cast("double")

    def verdict(self, observed):
        return observed >= float(self.minimum)

    @property
    def allowed(self) -> float:
        return float(self.minimum)


@dataclass(frozen=True)
class NullRate:
    """Share of nulls at most ``allowed``; an empty table passes."""

    column: str
    allowed: float = settings.DEFAULT_MAX_NULL_RATE

    @property
    def name(self) -> str:
        return f"null_rate_{self.column}"

    def measure(self) -> Column:
        return F.coalesce(F.avg(F.col(self.column).isNull().cast("double")), F.lit(0.0))

    def verdict(self, observed):
        return observed <= self.allowed


@dataclass(frozen=True)
class ValueRange:
    """No non-null value outside [low, high]; observed is the number outside."""

    column: str
    low: float
    high: float
    allowed: float = 0.0

    @property
    def name(self) -> str:
        return f"value_range_{self.column}"

    def measure(self) -> Column:
        value = F.col(self.column)
        return F.count_if((value < F.lit(self.low)) | (value > F.lit(self.high))).cast("double")

    def verdict(self, observed):
        return observed <= self.allowed


Rule = MinRows | NullRate | ValueRange

STANDARD_RULES: tuple[Rule, ...] = (
    MinRows(1),
    NullRate("device_id", 0.0),
    NullRate("entry_id", 0.0),
    NullRate("recorded_at", 0.0),
    NullRate("vibration_rms", 0.5),
    NullRate("temperature_celsius", 0.5),
    NullRate("pressure_bar", 0.5),
)
PHYSICAL_RULES: tuple[Rule, ...] = tuple(
    ValueRange(column, low, high) for column, (low, high) in settings.PHYSICAL_RANGES.items()
)


def check(df: DataFrame, table_name: str, rules: tuple[Rule, ...] = STANDARD_RULES) -> DataFrame:
    """One result row per rule, from one aggregate over ``df``."""
    measured = df.agg(*[rule.measure().alias(rule.name) for rule in rules])
    results = [
        F.struct(
            F.lit(table_name).alias("table_name"),
            F.lit(rule.name).alias("check_name"),
            F.col(rule.name).alias("observed"),
            F.lit(rule.allowed).alias("allowed"),
            rule.verdict(F.col(rule.name)).alias("passed"),
        )
        for rule in rules
    ]
    return measured.select(F.inline(F.array(*results)))


def watch(df: DataFrame, name: str, rules: tuple[Rule, ...] = STANDARD_RULES) -> tuple[DataFrame, Observation]:
    """Measure the rules while ``df`` is written, without another scan."""
    seen = Observation(name)
    return df.observe(seen, *[rule.measure().alias(rule.name) for rule in rules]), seen


def observed_results(
    spark: SparkSession, table_name: str, seen: dict, rules: tuple[Rule, ...] = STANDARD_RULES
) -> DataFrame:
    """Turn observed measures (one small row) into result rows."""
    rows = [
        (table_name, r.name, float(seen[r.name]), r.allowed, bool(r.verdict(float(seen[r.name])))) for r in rules
    ]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def summarize(results: DataFrame) -> DataFrame:
    """Checks, passed and failed per table."""
    return results.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )
