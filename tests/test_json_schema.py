import json

import pytest

from gaugeworks.plans import jobs
from gaugeworks.sources import contract, json_schema, landing
from gaugeworks.sources.json_schema import READING_SCHEMA, checked, compile_schema
from gaugeworks.sources.tables import read_table

GOOD = {"device_id": "d1", "entry_id": 1, "recorded_at": "2024-01-15T14:30:00Z", "vibration_rms": 1.5, "pressure_bar": None}


def found(spark, rules, *texts):
    df = checked(spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, value string"), rules)
    return [list(r["violations"]) for r in df.orderBy("n").collect()]


def test_the_document_says_what_the_fixed_contract_says(spark):
    """One text for each kind of fault, judged by both."""
    def but(**change):
        return json.dumps({**GOOD, **change})

    texts = [
        json.dumps(GOOD), but(device_id=None), but(device_id=7), but(entry_id="1"), but(entry_id=1.5), but(recorded_at="soon"),
        but(vibration_rms="high"), but(vibration_rms=None), but(vibration_rms=3), but(extra=1, more=[2]), but(source_channel=None),
        but(ingested_at="2024-01-15"), json.dumps({"entry_id": 1}), "{}", "[1]", "3", "", None, "{broken",
        '{"device_id":"d","entry_id":1,"recorded_at":"2024-01-15T14:30:00Z","pressure_bar":1e999}',
    ]
    fixed = contract.check_contract(spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, value string"))
    want = [list(r["violations"]) for r in fixed.orderBy("n").collect()]
    assert found(spark, compile_schema(READING_SCHEMA), *texts) == want and sum(not v for v in want) == 3


def test_bounds_enumerations_and_extras(spark):
    rules = compile_schema(
        {"type": "object", "properties": {"a": {"type": ["integer", "null"], "minimum": 0, "maximum": 9},
                                          "b": {"type": "string", "enum": ["x", "y"]}, "c d": {"type": "boolean"}}}
    )
    texts = ['{"a":0,"b":"x","z":1}', '{"a":10}', '{"a":-1,"b":"q"}', '{"a":null,"c d":true}', '{"c d":1}']
    assert found(spark, rules, *texts) == [[], ["range:a"], ["range:a", "enum:b"], [], ["type:c d"]]
    row = checked(spark.createDataFrame([(texts[3],)], "value string"), rules).first()["reading"]
    assert row.asDict() == {"a": None, "b": None, "c d": True}


@pytest.mark.parametrize(
    "document",
    [
        {"type": "array"},
        {"type": "object", "patternProperties": {}},
        {"properties": {"a": {"type": "object"}}},
        {"properties": {"a": {"type": ["string", "integer"]}}},
        {"properties": {"a": {"type": "string", "pattern": "x"}}},
        {"properties": {"a": {"type": "string", "format": "email"}}},
        {"properties": {"a": {"type": "string"}}, "required": ["b"]},
        {"additionalProperties": {"type": "string"}},
    ],
)
def test_what_the_compiler_does_not_know_is_refused(document):
    with pytest.raises(ValueError):
        compile_schema(json.dumps(document))


def test_landing_checks_once(spark, path, monkeypatch):
    """Both sides come from one stored pass; the metrics count what landed."""
    where = jobs.Locations.under(path("root"))
    feeds = [{"entry_id": i, "created_at": t, "field1": "2"} for i, t in enumerate(["2024-01-15T14:30:00Z", "", "2024-01-15T15:30:00Z"])]
    payloads = spark.createDataFrame([(9, json.dumps({"feeds": [feed]})) for feed in feeds], "channel_id int, payload string")
    passes = []
    check = json_schema.checked
    monkeypatch.setattr(json_schema, "checked", lambda *a: passes.append(1) or check(*a))
    jobs.run_landing(spark, payloads, where, contract=compile_schema(READING_SCHEMA))
    assert len(passes) == 1
    # Channel 9 feeds two devices.
    assert sorted((r.device_id, r.entry_id) for r in landing.read_landing(spark, where.landing).collect()) == [
        ("device-001", 0), ("device-001", 2), ("device-003", 0), ("device-003", 2)
    ]
    aside = read_table(spark, where.quarantine).collect()
    assert [list(r["violations"]) for r in aside] == [["format:recorded_at"]] * 2
    assert {json.loads(r["value"])["entry_id"] for r in aside} == {1}
    assert sorted(r["value"] for r in read_table(spark, where.metrics).collect()) == [2.0, 2.0]
