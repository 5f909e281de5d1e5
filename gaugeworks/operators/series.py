"""Windows over long series, cut into pieces (WIN-3..6).

A window over one device sorts all of its rows in one task. Here a series is cut, by
time for a frame of time and by position for a frame of rows, and each piece is given
the rows before it that its first frames reach back to. Those rows are dropped again
afterwards, so the result is that of the plain window, and one device is many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gaugeworks.functions import scalars
from gaugeworks.operators.scoring import DAY_SECONDS, HOUR_SECONDS

#: Length of a piece: in time, and in rows.
PIECE_SECONDS, PIECE_ROWS = 28 * DAY_SECONDS, 1_000

#: A column over a window, from the window.
OverFrame = Callable[[WindowSpec], Column]
_UNDATED = -(2**62)


def over_time(df: DataFrame, key: str, seconds: Column, back: int, made: dict[str, OverFrame], piece: int = PIECE_SECONDS) -> DataFrame:
    """Columns over the frame of the last ``back`` seconds, the current row's time included.

    Rows without a time have a piece of their own, as they share one frame in a plain window.
    """
    piece = max(piece, back, 1)
    timed = df.withColumn("_at", seconds)
    own = F.when(F.col("_at").isNull(), F.lit(_UNDATED)).otherwise(F.floor(F.col("_at") / piece))
    # The next piece needs a row if its first frame reaches back to it.
    reaches = F.coalesce(piece - F.pmod("_at", F.lit(piece)) <= back, F.lit(False))
    pieces = F.when(reaches, F.array(own, own + 1)).otherwise(F.array(own))
    spread = timed.withColumn("_own", own).withColumn("_piece", F.explode(pieces))
    frame = Window.partitionBy(key, "_piece").orderBy("_at").rangeBetween(-back, 0)
    return _kept(spread, {name: over(frame) for name, over in made.items()}, df.columns)


def positions(df: DataFrame, key: str, order: Column, bucket: Column) -> DataFrame:
    """Adds ``_position``, the place of a row in its series from 0, without a window over the whole series.

    ``bucket`` must not fall as ``order`` rises. Rows are ranked within their bucket; the buckets' sizes,
    one row for each, are summed up along the series.
    """
    placed = df.withColumn("_order", order).withColumn("_bucket", F.coalesce(bucket, F.lit(_UNDATED)))
    sizes = placed.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    along = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col(key).alias("_key"), F.col("_bucket").alias("_of"), F.coalesce(F.sum("_size").over(along), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy("_order")) - 1
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_bucket") == F.col("_of"))
    joined = placed.withColumn("_rank", rank).join(before, same)
    return joined.withColumn("_position", F.col("_before") + F.col("_rank")).drop("_key", "_of", "_before", "_rank", "_bucket", "_order")


def over_rows(
    df: DataFrame, key: str, order: Column, bucket: Column, rows: int, made: dict[str, OverFrame], piece: int = PIECE_ROWS
) -> DataFrame:
    """Columns over the frame of the last ``rows`` rows, the current one included.

    ``order`` tells the rows of a series apart; nulls come first. ``bucket`` is as in :func:`positions`.
    """
    piece = max(piece, rows)
    placed = positions(df, key, order, bucket)
    own = F.expr(f"_position div {piece}")
    reaches = F.col("_position") % piece >= piece - (rows - 1)
    pieces = F.when(reaches, F.array(own, own + 1)).otherwise(F.array(own))
    spread = placed.withColumn("_own", own).withColumn("_piece", F.explode(pieces))
    frame = Window.partitionBy(key, "_piece").orderBy("_position").rowsBetween(1 - rows, 0)
    return _kept(spread, {name: over(frame) for name, over in made.items()}, df.columns)


def _kept(spread: DataFrame, made: dict[str, Column], columns: list[str]) -> DataFrame:
    return spread.withColumns(made).filter(F.col("_piece") == F.col("_own")).select(*columns, *made)


def _zscore(value: str) -> OverFrame:
    return lambda w: scalars.guarded_zscore(F.col(value), F.avg(value).over(w), F.stddev_samp(value).over(w))


def zscore_24h(hourly: DataFrame, value: str = "avg_vibration_rms", piece: int = PIECE_SECONDS) -> DataFrame:
    """:func:`gaugeworks.operators.scoring.zscore_24h` for series of any length."""
    made = {"vibration_zscore": _zscore(value)}
    return over_time(hourly, "device_id", F.unix_seconds("window_start"), DAY_SECONDS - HOUR_SECONDS, made, piece)


def zscore_daily(daily: DataFrame, frame_rows: int, value: str = "avg_vibration_rms", piece: int = PIECE_ROWS) -> DataFrame:
    """:func:`gaugeworks.operators.scoring.zscore_daily` for series of any length."""
    made = {"vibration_zscore": _zscore(value)}
    month = F.floor(F.unix_date("date") / 28)
    return over_rows(daily, "device_id", F.col("date"), month, frame_rows, made, piece)
