"""The JSON contract of a reading (SRC-7): valid rows and quarantine.

Works on batch and streaming frames. Each text is parsed once, into a variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from gaugeworks.sources.schemas import READING

# Field -> (accepted JSON types, required, null allowed).
INTEGER = ("BIGINT",)
NUMBER = ("BIGINT", "DOUBLE", "DECIMAL")
TEXT = ("STRING",)
CONTRACT = {
    "device_id": (TEXT, True, False),
    "entry_id": (INTEGER, True, False),
    "recorded_at": (TEXT, True, False),
    "vibration_rms": (NUMBER, False, True),
    "temperature_celsius": (NUMBER, False, True),
    "pressure_bar": (NUMBER, False, True),
    "source_channel": (INTEGER, False, False),
    "ingested_at": (TEXT, False, False),
}


def once(value: Column) -> Column:
    """Evaluates ``value`` once per row, however often its column is used later.

    A plain projection would be merged into each later use; the optimizer does
    not merge a generator.
    """
    return F.explode(F.array(value))


# Fixed value: a date-time has a date, a time with seconds, and an offset.
DATE_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"
DATE_TIMES = ("recorded_at", "ingested_at")


def _typed(field: str, kind: str) -> Column:
    return F.try_variant_get("reading", f"$.{field}", kind)


def _value_violation(field: str) -> Column | None:
    """What is wrong with a value whose JSON type is accepted."""
    if field in DATE_TIMES:
        text = _typed(field, "string")
        good = text.rlike(DATE_TIME) & F.try_to_timestamp(text).isNotNull()
        return F.when(~good, F.lit(f"format:{field}"))
    if CONTRACT[field][0] == NUMBER:
        # A number too large for a double would become infinite.
        return F.when(F.abs(_typed(field, "double")) == float("inf"), F.lit(f"nonfinite:{field}"))
    if READING[field].dataType == IntegerType():
        return F.when(_typed(field, "int").isNull(), F.lit(f"range:{field}"))
    return None


def _field_violation(field: str) -> Column:
    types, required, nullable = CONTRACT[field]
    # "DECIMAL(3,2)" -> "DECIMAL"; a JSON null is VOID.
    kind = F.substring_index(F.schema_of_variant(_typed(field, "variant")), "(", 1)
    accepted = [*types, "VOID"] if nullable else list(types)
    out = F.when(kind.isNull(), F.lit(f"missing:{field}" if required else None).cast("string"))
    out = out.when(~kind.isin(accepted), F.lit(f"type:{field}"))
    value = _value_violation(field)
    return out if value is None else out.when(kind.isin(list(types)), value)


def check_contract(raw: DataFrame, text: str = "value") -> DataFrame:
    """Adds ``reading`` (variant) and ``violations``, an array that is empty for
    a valid text. Numbers JSON cannot express (NaN, Infinity) and numbers that
    would become infinite or overflow are not valid."""
    parsed = raw.select("*", once(F.try_parse_json(text)).alias("reading"))
    # Only names are read here; values of other fields stay unparsed.
    extra = F.array_except(F.json_object_keys(text), F.array(*[F.lit(f) for f in CONTRACT]))
    typed = parsed.select("*", once(F.sort_array(extra)).alias("_extra"))
    fields = F.array_compact(F.array(*[_field_violation(f) for f in CONTRACT]))
    named = F.when(F.size("_extra") > 0, F.transform("_extra", lambda key: F.concat(F.lit("extra:"), key)))
    violations = (
        F.when(F.col("reading").isNull(), F.array(F.lit("not_json")))
        .when(F.col("_extra").isNull(), F.array(F.lit("not_an_object")))
        .otherwise(F.concat(fields, F.coalesce(named, F.array().cast("array<string>"))))
    )
    return typed.select("*", once(violations).alias("violations")).drop("_extra")


def valid_readings(checked: DataFrame, *keep: str) -> DataFrame:
    """Typed readings of the valid texts, plus the columns named in ``keep``."""
    typed = [
        F.try_variant_get("reading", f"$.{field.name}", field.dataType.simpleString()).alias(field.name)
        for field in READING.fields
    ]
    return checked.filter(F.size("violations") == 0).select(*typed, *keep)


def quarantined(checked: DataFrame) -> DataFrame:
    """The other texts, unchanged, with what is wrong with them."""
    return checked.filter(F.size("violations") > 0).drop("reading")
