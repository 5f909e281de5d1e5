"""A JSON contract compiled from its schema document (SRC-7, PIPE-5).

The document is read once, on the driver, and becomes column expressions: required
fields, unions of types, formats, bounds, and whether other fields may occur. A
keyword that the compiler does not know is refused, since leaving it out would accept
what the document forbids. One pass over the texts yields typed readings and the
reasons against each text; both sides of the split are taken from it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import staged
from gaugeworks.sources.contract import DATE_TIME, once

#: The contract of a reading.
READING_SCHEMA = Path(__file__).with_name("reading.schema.json")

# JSON type -> types of a variant, and the Spark type it is read as.
_TYPES = {
    "string": (("STRING",), "string"),
    "integer": (("BIGINT",), "bigint"),
    "number": (("BIGINT", "DOUBLE", "DECIMAL"), "double"),
    "boolean": (("BOOLEAN",), "boolean"),
}
_FIELD_KEYWORDS = {"type", "format", "minimum", "maximum", "enum", "title", "description", "default", "examples"}
_OBJECT_KEYWORDS = {"$schema", "$id", "title", "description", "type", "required", "properties", "additionalProperties"}


@dataclass(frozen=True)
class FieldRule:
    """One field of the object: its type, and what its value has to keep to."""

    name: str
    kind: str
    required: bool
    nullable: bool
    date_time: bool = False
    minimum: float | None = None
    maximum: float | None = None
    allowed: tuple | None = None

    def value(self) -> Column:
        return F.try_variant_get("_json", _path(self.name), _TYPES[self.kind][1])

    def violation(self) -> Column:
        """What is wrong with the field, or null."""
        # "DECIMAL(3,2)" -> "DECIMAL"; a JSON null is VOID.
        found = F.substring_index(F.schema_of_variant(F.try_variant_get("_json", _path(self.name), "variant")), "(", 1)
        types = _TYPES[self.kind][0]
        out = F.when(found.isNull(), F.lit(f"missing:{self.name}" if self.required else None).cast("string"))
        out = out.when(found == "VOID", F.lit(None if self.nullable else f"type:{self.name}").cast("string"))
        out = out.when(~found.isin(*types), F.lit(f"type:{self.name}"))
        for reason, bad in self._value_rules():
            out = out.when(bad, F.lit(f"{reason}:{self.name}"))
        return out

    def _value_rules(self) -> list[tuple[str, Column]]:
        value, rules = self.value(), []
        if self.kind == "number":
            # A number too large for a double would become infinite.
            rules.append(("nonfinite", F.abs(value) == float("inf")))
        if self.date_time:
            rules.append(("format", ~(value.rlike(DATE_TIME) & F.try_to_timestamp(value).isNotNull())))
        if self.minimum is not None:
            rules.append(("range", value < F.lit(self.minimum)))
        if self.maximum is not None:
            rules.append(("range", value > F.lit(self.maximum)))
        if self.allowed is not None:
            rules.append(("enum", ~value.isin(*self.allowed)))
        return rules


@dataclass(frozen=True)
class Contract:
    fields: tuple[FieldRule, ...]
    extras: bool

    def names(self) -> list[str]:
        return [rule.name for rule in self.fields]


def _path(name: str) -> str:
    return f"$['{name}']"


def compile_schema(document: str | Path | dict) -> Contract:
    """The contract of a schema document: its text, its path, or what was read from it."""
    if not isinstance(document, dict):
        document = json.loads(document.read_text() if isinstance(document, Path) else document)
    _refuse_unknown(document, _OBJECT_KEYWORDS, "the object")
    if document.get("type", "object") != "object" or not isinstance(document.get("additionalProperties", True), bool):
        raise ValueError("only flat objects are supported")
    required = set(document.get("required", ()))
    properties = document.get("properties", {})
    if unknown := required - properties.keys():
        raise ValueError(f"required but not described: {sorted(unknown)}")
    rules = tuple(_field(name, spec, name in required) for name, spec in properties.items())
    return Contract(rules, document.get("additionalProperties", True))


def _refuse_unknown(spec: dict, known: set[str], where: str) -> None:
    if unknown := spec.keys() - known:
        raise ValueError(f"{where}: keywords not supported: {sorted(unknown)}")


def _field(name: str, spec: dict, required: bool) -> FieldRule:
    _refuse_unknown(spec, _FIELD_KEYWORDS, f"field {name!r}")
    if "'" in name:
        raise ValueError(f"field {name!r}: a quote in a name is not supported")
    types = spec.get("type")
    types = [types] if isinstance(types, str) else list(types or ())
    kinds = [t for t in types if t != "null"]
    if len(kinds) != 1 or kinds[0] not in _TYPES:
        raise ValueError(f"field {name!r}: type {types} is not one of {sorted(_TYPES)}, with or without null")
    if spec.get("format") not in (None, "date-time"):
        raise ValueError(f"field {name!r}: format {spec['format']!r} is not supported")
    allowed = tuple(v for v in spec["enum"] if v is not None) if "enum" in spec else None
    return FieldRule(
        name, kinds[0], required, "null" in types, spec.get("format") == "date-time",
        spec.get("minimum"), spec.get("maximum"), allowed,
    )


def checked(raw: DataFrame, contract: Contract, text: str = "value") -> DataFrame:
    """Adds ``violations``, empty for a valid text, and ``reading``, its typed fields; null for others.

    Works on batch and streaming frames. A null text is no JSON.
    """
    parsed = raw.select("*", once(F.try_parse_json(text)).alias("_json"))
    others = F.array_except(F.json_object_keys(text), F.array(*[F.lit(name) for name in contract.names()]).cast("array<string>"))
    keyed = parsed.select("*", once(F.sort_array(others)).alias("_others"))
    fields = F.array_compact(F.array(*[rule.violation() for rule in contract.fields]).cast("array<string>"))
    extra = F.transform("_others", lambda key: F.concat(F.lit("extra:"), key))
    violations = (
        F.when(F.col("_json").isNull(), F.array(F.lit("not_json")))
        .when(F.col("_others").isNull(), F.array(F.lit("not_an_object")))
        .otherwise(fields if contract.extras else F.concat(fields, extra))
    )
    judged = keyed.select("*", once(violations).alias("violations"))
    reading = F.when(F.size("violations") == 0, F.struct(*[rule.value().alias(rule.name) for rule in contract.fields]))
    return judged.withColumn("reading", reading).drop("_json", "_others")


def split_once(raw: DataFrame, contract: Contract, accept, refuse, text: str = "value") -> None:
    """Check every text once and hand both sides on: ``accept`` gets the typed readings with the other columns
    of ``raw``, ``refuse`` the texts with their violations. The checked rows are stored between the two."""
    others = [name for name in raw.columns if name != text]
    with staged(checked(raw, contract, text), "checked") as rows:
        accept(rows.filter(F.size("violations") == 0).select("reading.*", *others))
        refuse(rows.filter(F.size("violations") > 0).select(text, "violations", *others))
