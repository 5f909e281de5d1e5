"""Scalar expressions. All are built-in Spark functions; there are no UDFs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeworks import settings

# Fixed value: what a plain decimal number looks like. Spark's own cast would
# also take Java forms such as "1.5f" and hexadecimal floats.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
BLANKS = " \t\n\r\x0b\x0c"


def moment(as_of: datetime | str | Column | None) -> Column:
    """``as_of`` as a timestamp column; the current time when none is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp")


def parse_number(text: Column) -> Column:
    """Text to double; blank or non-numeric text to null."""
    bare = F.regexp_replace(F.btrim(text, F.lit(BLANKS)), "(?<=[0-9])_(?=[0-9])", "")
    word = F.lower(bare)
    return (
        F.when(bare.rlike(NUMBER_PATTERN), bare.try_cast("double"))
        .when(word.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
        .when(word.isin("-inf", "-infinity"), F.lit(float("-inf")))
        .when(word.isin("nan", "+nan", "-nan"), F.lit(float("nan")))
    )


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 text to a timestamp; bad text to null instead of an error."""
    return F.try_to_timestamp(text)


def missing_to_null(value: Column) -> Column:
    """The missing-value sentinel back to null."""
    return F.nullif(value, F.lit(settings.MISSING))


def guarded_zscore(value: Column, mean: Column, deviation: Column) -> Column:
    """``(value - mean) / deviation``; 0.0 when the deviation is null or 0."""
    return F.when(deviation > 0, (value - mean) / deviation).otherwise(F.lit(0.0))


# A number is split at 2**-24, and what is left at 2**-60.
HIGH_BITS, LOW_BITS, HIGH_LIMIT = 24, 36, 2.0**27


def split_number(value: Column) -> tuple[Column, Column, Column]:
    """``high``, ``low`` and ``fits``: bigints with ``value == (high + low / 2**36) / 2**24``, exactly.

    Sums of bigints do not depend on the order of rows, as sums of doubles do. ``fits`` is false for
    numbers that are too large, too fine or not finite; all are null for null.
    """
    scaled = value * F.lit(2.0**HIGH_BITS)
    high = F.when(F.abs(value) < HIGH_LIMIT, F.floor(scaled))
    rest = (scaled - high) * F.lit(2.0**LOW_BITS)
    low = F.floor(rest)
    fits = F.when(value.isNotNull(), F.coalesce(rest == low, F.lit(False)))
    return F.when(fits, high), F.when(fits, low), fits


def joined_mean(high: Column, low: Column, n: Column) -> Column:
    """The mean of ``n`` numbers from the sums of their parts: their exact sum, rounded once, by ``n``. Null beyond bigint."""
    carried = F.try_add(high, F.call_function("shiftright", low, F.lit(LOW_BITS)))
    rest = low.bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    return F.try_divide((carried.cast("double") + rest / F.lit(2.0**LOW_BITS)) / F.lit(2.0**HIGH_BITS), n)


def whole_minutes(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, truncated toward zero."""
    return F.timestamp_diff("MINUTE", start, end)


def freshness(minutes: Column) -> Column:
    return (
        F.when(minutes < settings.LIVE_MINUTES, "LIVE")
        .when(minutes < settings.RECENT_MINUTES, "RECENT")
        .otherwise("STALE")
    )


def exceeds(value: Column, limit: float) -> Column:
    """True above the limit; null counts as not exceeding."""
    return F.coalesce(value > F.lit(limit), F.lit(False))


def rounded(name: str, digits: int, alias: str | None = None) -> Column:
    return F.round(F.col(name), digits).alias(alias or name)


def time_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded path parts of a timestamp."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }


def compact_json(*columns: str) -> Column:
    """One compact JSON object per row; nulls are written as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
