"""Gold tables: full rebuild from one scan of Silver, and refresh by date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks import settings
from gaugeworks.operators.rollups import daily_from_parts, hour_parts, hourly_from_parts, sentinel_to_null
from gaugeworks.operators.scoring import score_daily
from gaugeworks.session import staged
from gaugeworks.sources.tables import drop_partitions, read_if_exists, write_table

# The hourly table is partitioned by the date of the window; one folder per
# window would mean one folder per hour.
HOURLY_PARTITION = settings.HOURLY_PARTITION
DAILY_PARTITION = "date"
SCORE_COLUMNS = ("vibration_zscore", "is_at_risk")


def write_hourly(hourly: DataFrame, ref: str) -> None:
    dated = hourly.withColumn(HOURLY_PARTITION, F.to_date("window_start"))
    write_table(dated, ref, "overwrite_partitions", (HOURLY_PARTITION,))


def write_daily(daily: DataFrame, ref: str) -> None:
    write_table(daily, ref, "overwrite_partitions", (DAILY_PARTITION,))


def _dates_of(parts: DataFrame) -> set:
    """The dates that have readings, null included: one value for each day on record."""
    return {row[0] for row in parts.select(F.to_date("hour")).distinct().collect()}


def _stored_dates(spark: SparkSession, ref: str, column: str) -> set:
    table = read_if_exists(spark, ref)
    return set() if table is None else {row[0] for row in table.select(column).distinct().collect()}


def rebuild(
    silver: DataFrame, hourly_ref: str, daily_ref: str, frame_rows: int = settings.RISK_FRAME_ROWS, now=None
) -> None:
    """Both tables from all of Silver. Silver is scanned once; the staged hourly
    parts, which are far smaller, feed both. Dates that are no longer in Silver go."""
    with staged(hour_parts(sentinel_to_null(silver)), "hour-parts") as parts:
        write_hourly(hourly_from_parts(parts, now), hourly_ref)
        write_daily(score_daily(daily_from_parts(parts, now), frame_rows), daily_ref)
        present = _dates_of(parts)
    for ref, column in ((hourly_ref, HOURLY_PARTITION), (daily_ref, DAILY_PARTITION)):
        drop_partitions(silver.sparkSession, ref, column, _stored_dates(silver.sparkSession, ref, column) - present)


@dataclass(frozen=True)
class ChangedDates:
    """Dates to recompute. ``listed`` is None when there are too many to list."""

    frame: DataFrame
    first: object
    last: object
    undated: bool
    listed: list | None

    @classmethod
    def of(cls, dates: DataFrame, max_values: int = settings.PRUNE_MAX_VALUES) -> ChangedDates:
        known = dates.filter(F.col("date").isNotNull()).select("date").distinct()
        ends = dates.agg(
            F.min("date").alias("first"),
            F.max("date").alias("last"),
            F.coalesce(F.bool_or(F.col("date").isNull()), F.lit(False)).alias("undated"),
        ).head()
        few = [row[0] for row in known.take(max_values + 1)]
        return cls(known, ends["first"], ends["last"], ends["undated"], few if len(few) <= max_values else None)

    def values(self) -> set:
        """All of them, null included: at most one for each day on record."""
        known = self.listed if self.listed is not None else [row[0] for row in self.frame.collect()]
        return {*known, None} if self.undated else set(known)

    def select_from(self, df: DataFrame, date: Column) -> DataFrame:
        """Rows of ``df`` on one of the dates."""
        return self._match(df, date, "left_semi")

    def exclude_from(self, df: DataFrame, date: Column) -> DataFrame:
        return self._match(df, date, "left_anti")

    def _match(self, df: DataFrame, date: Column, how: str) -> DataFrame:
        if self.listed is not None:
            hit = F.coalesce(date.isin(self.listed), F.lit(False)) if self.listed else F.lit(False)
            if self.undated:
                hit = hit | date.isNull()
            return df.filter(hit if how == "left_semi" else ~hit)
        keyed = df.withColumn("_date", date)
        undated = F.col("_date").isNull()
        dates = self.frame.withColumnRenamed("date", "_date")
        matched = keyed.filter(~undated).join(dates, "_date", how)
        if self.undated == (how == "left_semi"):
            matched = matched.unionByName(keyed.filter(undated))
        return matched.drop("_date")


def refresh(
    silver: DataFrame,
    hourly_ref: str,
    daily_ref: str,
    dates: DataFrame,
    frame_rows: int = settings.RISK_FRAME_ROWS,
    now=None,
) -> None:
    """Recompute only the given dates, plus the scores of later days.

    A row frame looks back ``frame_rows - 1`` rows, so a changed day can alter
    the score of every later day's row but of no earlier one. Overwriting by
    partition leaves alone what is not in the result, so the partitions of dates
    that lost all of their readings are dropped afterwards.
    """
    changed = ChangedDates.of(dates)
    recorded = F.col("recorded_at")
    readings = silver
    if not changed.undated:
        if changed.first is None:
            return
        # A plain range on the stored column lets Parquet skip row groups.
        readings = readings.filter(
            (recorded >= F.lit(changed.first).cast("timestamp"))
            & (recorded < F.date_add(F.lit(changed.last), 1).cast("timestamp"))
        )
    readings = changed.select_from(readings, F.to_date(recorded))
    with staged(hour_parts(sentinel_to_null(readings)), "hour-parts") as parts:
        write_hourly(hourly_from_parts(parts, now), hourly_ref)
        _refresh_daily(daily_from_parts(parts, now), daily_ref, changed, frame_rows)
        emptied = changed.values() - _dates_of(parts)
    drop_partitions(silver.sparkSession, hourly_ref, HOURLY_PARTITION, emptied - {None})
    drop_partitions(silver.sparkSession, daily_ref, DAILY_PARTITION, emptied)


def _refresh_daily(fresh: DataFrame, daily_ref: str, changed: ChangedDates, frame_rows: int) -> None:
    stored = read_if_exists(fresh.sparkSession, daily_ref)
    if stored is None:
        write_daily(score_daily(fresh, frame_rows), daily_ref)
        return
    kept = changed.exclude_from(stored, F.col("date")).drop(*SCORE_COLUMNS)
    if changed.undated:
        # Undated rows sort first, so every later score may change.
        write_daily(score_daily(kept.unionByName(fresh), frame_rows), daily_ref)
        return
    since = F.col("date") >= F.lit(changed.first)
    rows = kept.filter(since).unionByName(fresh)
    history = _recent_history(kept, changed.first, frame_rows)
    scored = score_daily(rows.unionByName(history, allowMissingColumns=True), frame_rows)
    write_daily(scored.filter(since).select(*stored.columns), daily_ref)


def _recent_history(kept: DataFrame, first, frame_rows: int) -> DataFrame:
    """The rows before ``first`` that later frames reach back to; only what the
    score needs."""
    rank = F.row_number().over(Window.partitionBy("device_id").orderBy(F.col("date").desc_nulls_last()))
    return (
        kept.filter(F.col("date").isNull() | (F.col("date") < F.lit(first)))
        .select("device_id", "date", "avg_vibration_rms")
        .withColumn("_rank", rank)
        .filter(F.col("_rank") < frame_rows)
        .drop("_rank")
    )
