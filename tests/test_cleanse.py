from conftest import at

from gaugeworks.operators import cleanse
from gaugeworks.sources.schemas import READING

TEXT = (
    "device_id string, entry_id string, recorded_at string, vibration_rms string, temperature_celsius string, "
    "pressure_bar string, source_channel string, ingested_at string, _ingested_at timestamp, _source_file string, "
    "_batch_id string"
)
TYPED = (
    "device_id string, entry_id bigint, recorded_at string, vibration_rms double, temperature_celsius double, "
    "pressure_bar double, _ingested_at timestamp"
)
T0 = at("2024-01-15T14:30:00")
T1 = at("2024-01-15T15:30:00")


def text_row(entry="42", vibration="3.14", recorded="2024-01-15T14:30:00Z"):
    return ("d1", entry, recorded, vibration, "22.5", None, "9", "2024-01-15T14:31:00Z", T0, "f", "b")


def test_casts_text_columns(spark):
    df = cleanse.cast_readings(spark.createDataFrame([text_row(), text_row("x", "bad")], TEXT))
    types = dict(df.dtypes)
    assert types["vibration_rms"] == types["temperature_celsius"] == types["pressure_bar"] == "double"
    assert types["entry_id"] == "bigint"
    first, second = df.collect()
    assert (first["entry_id"], first["vibration_rms"], first["pressure_bar"]) == (42, 3.14, None)
    assert (second["entry_id"], second["vibration_rms"]) == (None, None)


def test_parses_iso_timestamps(spark):
    df = cleanse.parse_recorded_at(spark.createDataFrame([text_row(), text_row(recorded="soon")], TEXT))
    assert dict(df.dtypes)["recorded_at"] == "timestamp"
    first, second = df.selectExpr("year(recorded_at)", "month(recorded_at)", "day(recorded_at)", "hour(recorded_at)").collect()
    assert tuple(first) == (2024, 1, 15, 14)
    assert tuple(second) == (None, None, None, None)


def test_missing_values(spark):
    rows = [
        ("d1", 1, "2024-01-15T14:30:00Z", None, None, None, T0),
        ("d2", 2, "2024-01-15T14:30:00Z", 1.5, 20.0, float("nan"), T0),
        (None, 3, "2024-01-15T14:30:00Z", 9.0, 9.0, 9.0, T0),
    ]
    found = cleanse.clean(spark.createDataFrame(rows, TYPED)).orderBy("device_id").collect()
    assert [tuple(r[3:6]) for r in found] == [(-1.0, -1.0, -1.0), (1.5, 20.0, -1.0)]
    kept = cleanse.clean(spark.createDataFrame(rows, TYPED), fill=False).orderBy("device_id").collect()
    assert tuple(kept[0][3:6]) == (None, None, None)
    only_unowned = spark.createDataFrame(rows[2:], TYPED)
    assert cleanse.clean(only_unowned).count() == 0


def test_newest_delivery_wins(spark):
    rows = [
        ("d1", 42, "2024-01-15T14:30:00Z", 1.0, 1.0, 1.0, T0),
        ("d1", 42, "2024-01-15T14:30:00Z", 9.9, 1.0, 1.0, T1),
        ("d2", 42, "2024-01-15T14:30:00Z", 5.0, 1.0, 1.0, T0),
        ("d1", 43, "2024-01-15T14:30:00Z", 7.0, 1.0, 1.0, T0),
    ]
    found = cleanse.latest_delivery(spark.createDataFrame(rows, TYPED)).collect()
    assert sorted((r["device_id"], r["entry_id"], r["vibration_rms"]) for r in found) == [
        ("d1", 42, 9.9),
        ("d1", 43, 7.0),
        ("d2", 42, 5.0),
    ]


def test_ties_and_null_keys_are_settled(spark):
    rows = [("d1", None, "2024-01-15T14:30:00Z", float(v), 1.0, 1.0, T0) for v in range(20)]
    for partitions in (1, 7):
        df = spark.createDataFrame(rows, TYPED).repartition(partitions)
        assert [r["vibration_rms"] for r in cleanse.latest_delivery(df).collect()] == [19.0]


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    rows = [("d1", 1, "2024-01-15T14:30:00Z", float(v), 1.0, 1.0, T0) for v in range(100)]
    df = cleanse.latest_delivery(spark.createDataFrame(rows, TYPED))
    plan = df._jdf.queryExecution().executedPlan().toString()
    limit, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange")
    assert exchange < limit and plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_silver_passes_bronze_columns_through(spark):
    df = cleanse.to_silver(spark.createDataFrame([text_row()], TEXT), now="2024-01-16 00:00:00")
    assert df.columns == [*READING.names, "_ingested_at", "_source_file", "_batch_id", "_silver_updated_at"]
    assert df.first()["_silver_updated_at"] == at("2024-01-16T00:00:00")
