"""The order in which ordered results come, against SQL's, and the session's time zone."""

import os

import pytest
from compare import connect

from gaugeworks.operators import alarms
from gaugeworks.plans.oracle import ORACLES
from gaugeworks.plans.registry import QUERIES, _readings
from gaugeworks.operators.rollups import hourly
from gaugeworks.session import get_session

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

#: Query, the columns that its order is by, and that order in SQL.
ORDERS = {
    "twin_state": (["device_id"], "device_id"),
    "at_risk_7d": (["vibration_zscore", "date"], "vibration_zscore DESC, date DESC"),
    "trend_24h": (["device_id", "window_start"], "device_id, window_start"),
    "pipeline_health": (["layer"], "CASE layer WHEN 'bronze' THEN 1 WHEN 'silver' THEN 2 ELSE 3 END"),
    "daily_summary_30d": (["device_id", "date"], "device_id, date DESC"),
    "ordered_handoff": (["device_id", "recorded_at", "entry_id"], "device_id NULLS FIRST, recorded_at, entry_id"),
}


@needs_data
@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(spark, name):
    columns, order = ORDERS[name]
    got = [tuple(r) for r in QUERIES[name](spark, SF_DIR).select(*columns).collect()]
    want = connect(SF_DIR).sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]}) ORDER BY {order}").fetchall()
    assert got == want and len(got) > 1


@needs_data
def test_session_pins_the_zone(spark):
    """Hours and dates are UTC's, whatever zone the session was made with."""
    want = sorted(map(tuple, hourly(_readings(spark, SF_DIR)).select("device_id", "window_start", "reading_count").collect()))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        session = get_session()
        assert session.conf.get("spark.sql.session.timeZone") == "UTC"
        got = sorted(map(tuple, hourly(_readings(session, SF_DIR)).select("device_id", "window_start", "reading_count").collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want and got


def test_rules_per_device(spark):
    devices = spark.createDataFrame([("d1",), ("d2",), ("d1",), (None,)], "device_id string")
    rules = alarms.rules_per_device(devices, "m", "Sum", 300, 1, alarms.AT_LEAST, 1.0, alarms.NOT_BREACHING)
    assert sorted((r["rule"], r["dimensions"]["DeviceId"]) for r in rules.collect()) == [("m-d1", "d1"), ("m-d2", "d2")]
    with pytest.raises(ValueError):
        alarms.rules_per_device(devices, "m", "Median", 300, 1, alarms.AT_LEAST, 1.0, alarms.NOT_BREACHING)
