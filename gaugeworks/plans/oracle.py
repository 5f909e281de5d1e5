"""The registered queries as SQL for DuckDB, to compare results."""

from __future__ import annotations

#: Files of the query on checks per micro-batch.
BRONZE_FILES = 5
METRICS = ("vibration_rms", "temperature_celsius", "pressure_bar")
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"
FIGURES = [f"{fn}_{m}" for m in METRICS for fn in ("avg", "min", "max")]


def half_up(expr: str, digits: int = 6) -> str:
    """Rounds the decimal text of a double, as Spark does."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 15)), {digits}) AS DOUBLE)"


def _rounded(names: list[str] | tuple[str, ...], digits: int = 6) -> str:
    return ", ".join(f"{half_up(n, digits)} AS {n}" for n in names)


def _delivery(bump: str, lag: str, where: str = "") -> str:
    return f"""
    SELECT CASE WHEN event_id % 97 <> 0 THEN printf('device-%06d', user_id) END AS device_id,
           event_id AS entry_id,
           strftime(ts, {ISO}) AS recorded_at,
           CASE WHEN event_id % 11 <> 0 THEN value + CAST({bump} AS DOUBLE) END AS vibration_rms,
           CASE WHEN event_id % 17 <> 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END
               AS temperature_celsius,
           CASE WHEN event_id % 13 <> 0
                THEN CAST(1.0 AS DOUBLE) + (event_id % 100) * CAST(0.01 AS DOUBLE) END AS pressure_bar,
           CAST(user_id % 3 AS INTEGER) AS source_channel,
           ts + INTERVAL {lag} AS _ingested_at
    FROM events {where}"""


_FIRST = _delivery("0.0", "1 MINUTE")
_SECOND = _delivery("1.0", "1 DAY", "WHERE event_id % 10 = 0")


def _clean(source: str) -> str:
    filled = ", ".join(f"coalesce({m}, CAST(-1.0 AS DOUBLE)) AS {m}" for m in METRICS)
    return f"""
    SELECT device_id, entry_id, try_strptime(recorded_at, {ISO}) AS recorded_at, {filled},
           source_channel, _ingested_at
    FROM {source} WHERE device_id IS NOT NULL"""


def _grouped(bucket: str, source: str = "readings", where: str = "") -> str:
    figures = ", ".join(f"{fn}({m}) AS {fn}_{m}" for m in METRICS for fn in ("avg", "min", "max"))
    return f"""
    SELECT device_id, {bucket}, {figures}, count(entry_id) AS reading_count
    FROM {source} {where} GROUP BY ALL"""


def _scored(source: str, order: str, frame: str) -> str:
    return f"""
    SELECT *, CASE WHEN sd > 0 THEN (avg_vibration_rms - mean) / sd ELSE CAST(0.0 AS DOUBLE) END AS vibration_zscore
    FROM (SELECT *, avg(avg_vibration_rms) OVER f AS mean, stddev_samp(avg_vibration_rms) OVER f AS sd
          FROM {source} WINDOW f AS (PARTITION BY device_id ORDER BY {order} {frame}))"""


CTES = {
    "bronze": f"{_FIRST} UNION ALL {_SECOND}",
    "clean": _clean("bronze"),
    "silver": """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY device_id, entry_id ORDER BY _ingested_at DESC) AS rn FROM clean)
    WHERE rn = 1""",
    "readings": "SELECT * REPLACE (" + ", ".join(f"nullif({m}, -1.0) AS {m}" for m in METRICS) + ") FROM silver",
    "hourly": _grouped(
        "date_trunc('hour', recorded_at) AS window_start, date_trunc('hour', recorded_at) + INTERVAL 1 HOUR AS window_end",
        where="WHERE recorded_at IS NOT NULL",
    ),
    "daily": _grouped("CAST(recorded_at AS DATE) AS date"),
    "daily2": _scored("daily", "date", "ROWS BETWEEN 1 PRECEDING AND CURRENT ROW"),
    "daily14": _scored("daily", "date", "ROWS BETWEEN 13 PRECEDING AND CURRENT ROW"),
    "days14": _scored("daily", "date", "RANGE BETWEEN INTERVAL 13 DAYS PRECEDING AND CURRENT ROW"),
    "hourly24": _scored("hourly", "window_start", "RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW"),
    "risk": f"SELECT *, vibration_zscore > 2.5 AS is_at_risk, {AS_OF} AS _computed_at FROM daily14",
    "feed": """
    SELECT 'RecordsIngested' AS metric_name, CAST(1 AS DOUBLE) AS value, printf('device-%06d', user_id) AS device, ts
    FROM events
    UNION ALL SELECT CASE event_id % 3 WHEN 0 THEN 'Bronze' WHEN 1 THEN 'Silver' ELSE 'Gold' END || 'WriteLatencyMs',
           value * 10, NULL, ts FROM events
    UNION ALL SELECT 'GetRecords.IteratorAgeMilliseconds', value * 150, NULL, ts FROM events
    UNION ALL SELECT 'GoldTableLastUpdate', CAST(floor(epoch(ts)) AS DOUBLE), NULL, ts FROM events
    UNION ALL SELECT 'PipelineErrors', CAST(1 AS DOUBLE), printf('device-%06d', user_id), ts
    FROM events WHERE event_type = 'error'""",
    "table_feed": """
    SELECT * FROM feed
    UNION ALL SELECT 'BronzeRowCount', CAST(event_id + 1 AS DOUBLE), NULL, ts FROM events
    UNION ALL SELECT 'SilverRowCount', floor((event_id + 1) * 9 / 10), NULL, ts FROM events
    UNION ALL SELECT 'GoldHourlyRowCount', floor((event_id + 1) / 2), NULL, ts FROM events
    UNION ALL SELECT 'GoldDailyRowCount', floor((event_id + 1) / 10), NULL, ts FROM events
    UNION ALL SELECT 'AtRiskDeviceCount', CAST(user_id % 7 AS DOUBLE), NULL, ts FROM events
    UNION ALL SELECT 'MaxVibrationZScore', floor(value), NULL, ts FROM events""",
    "raw": f"""
    SELECT device_id, entry_id, recorded_at, vibration_rms, temperature_celsius, pressure_bar, source_channel,
           strftime(_ingested_at, {ISO}) AS ingested_at
    FROM ({_FIRST})""",
}
CTES["settled_hourly"] = "SELECT * REPLACE (" + _rounded(FIGURES) + ") FROM hourly"
CTES["settled_risk"] = "SELECT * REPLACE (" + _rounded([*FIGURES, "vibration_zscore"]) + ") FROM risk"
CHAIN = ["bronze", "clean", "silver", "readings", "hourly", "daily"]
NEEDS = {
    "daily2": CHAIN,
    "daily14": CHAIN,
    "days14": CHAIN,
    "hourly24": CHAIN,
    "risk": [*CHAIN, "daily14"],
    "settled_risk": [*CHAIN, "daily14", "risk"],
    "settled_hourly": CHAIN,
    "feed": [],
    "table_feed": ["feed"],
    "raw": [],
    **{name: CHAIN[:i] for i, name in enumerate(CHAIN)},
}


def _with(select: str, *names: str) -> str:
    wanted: list[str] = []
    for name in names:
        for part in (*NEEDS[name], name):
            if part not in wanted:
                wanted.append(part)
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in wanted) + "\n" + select


def _moved(select: str, *names: str) -> str:
    """The chain over two deliveries of which the second moves readings to the next day."""
    half = "SELECT * REPLACE (CASE WHEN entry_id % 89 <> 0 THEN entry_id END AS entry_id) FROM ({})"
    first = half.format(_delivery("0.0", "1 MINUTE"))
    moved = "(SELECT * REPLACE (ts + INTERVAL 1 DAY AS ts) FROM events WHERE event_id % 10 = 0 OR CAST(ts AS DATE) = DATE '2024-01-01')"
    # In the order of the runs, whatever the times of the readings.
    second = half.format(_delivery("1.0", "1000 DAY").replace("FROM events", f"FROM {moved} AS events"))
    text = _with(select, *names)
    return text.replace(f"bronze AS ({CTES['bronze']})", f"bronze AS ({first} UNION ALL {second})")


def _hourly_columns() -> str:
    return f"device_id, {_rounded(FIGURES)}, reading_count, window_start, window_end"


def _daily_columns() -> str:
    return f"device_id, date, {_rounded(FIGURES)}, reading_count"


# Quality


def _check(table: str, source: str, name: str, observed: str, allowed: float, passes: str = "<=") -> str:
    return f"""
    SELECT '{table}' AS table_name, '{name}' AS check_name, {half_up('observed')} AS observed,
           CAST({allowed} AS DOUBLE) AS allowed, observed {passes} {allowed} AS passed
    FROM (SELECT CAST({observed} AS DOUBLE) AS observed FROM {source})"""


def _battery(table: str, source: str, ranges: bool) -> str:
    checks = [_check(table, source, "min_row_count", "count(*)", 1.0, ">=")]
    limits = {"device_id": 0.0, "entry_id": 0.0, "recorded_at": 0.0, **{m: 0.5 for m in METRICS}}
    for column, allowed in limits.items():
        rate = f"coalesce(avg(CASE WHEN {column} IS NULL THEN 1.0 ELSE 0.0 END), 0.0)"
        checks.append(_check(table, source, f"null_rate_{column}", rate, allowed))
    if ranges:
        for column, low, high in (
            ("temperature_celsius", -1.0, 200.0),
            ("pressure_bar", -1.0, 1000.0),
            ("vibration_rms", -1.0, 500.0),
        ):
            outside = f"count(*) FILTER ({column} < {low} OR {column} > {high})"
            checks.append(_check(table, source, f"value_range_{column}", outside, 0.0))
    return " UNION ALL ".join(checks)


# Dashboards

_MINUTES = f"datesub('minute', recorded_at, {AS_OF})"
_TWIN = f"""
SELECT device_id, recorded_at AS last_seen, {half_up('vibration_rms', 3)} AS vibration_rms_mm_s,
       {half_up('temperature_celsius', 2)} AS temperature_celsius, {half_up('pressure_bar', 3)} AS pressure_bar,
       {_MINUTES} AS minutes_since_last_reading,
       CASE WHEN {_MINUTES} < 5 THEN 'LIVE' WHEN {_MINUTES} < 15 THEN 'RECENT' ELSE 'STALE' END AS data_freshness,
       source_channel, entry_id
FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY recorded_at DESC, entry_id DESC) AS rn FROM silver)
WHERE rn = 1"""
_AT_RISK = f"""
SELECT device_id, date, {half_up('avg_vibration_rms', 3)} AS avg_vibration_rms_mm_s,
       {half_up('max_vibration_rms', 3)} AS max_vibration_rms_mm_s,
       {half_up('vibration_zscore', 3)} AS vibration_zscore, is_at_risk, reading_count,
       {half_up('avg_temperature_celsius', 2)} AS avg_temperature_celsius,
       {half_up('avg_pressure_bar', 3)} AS avg_pressure_bar, _computed_at
FROM settled_risk WHERE is_at_risk AND date >= DATE '2024-01-31' - 7"""
_TREND = f"""
SELECT device_id, window_start, window_end, {half_up('avg_vibration_rms', 3)} AS avg_vibration_rms_mm_s,
       {half_up('max_vibration_rms', 3)} AS max_vibration_rms_mm_s,
       {half_up('min_vibration_rms', 3)} AS min_vibration_rms_mm_s, reading_count,
       CASE WHEN avg_vibration_rms > 10.0 THEN TRUE ELSE FALSE END AS threshold_exceeded,
       {half_up('avg_temperature_celsius', 2)} AS avg_temperature_celsius,
       {half_up('avg_pressure_bar', 3)} AS avg_pressure_bar
FROM settled_hourly WHERE window_start >= {AS_OF} - INTERVAL 24 HOURS"""
_HEALTH = " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, '{layer}' AS layer, count(*) AS row_count, max({latest}) AS latest_record_at,
    datesub('minute', max({latest}), {AS_OF}) AS data_lag_minutes FROM {source}"""
    for table, layer, source, latest in (
        ("bronze_sensors", "bronze", "bronze", f"try_strptime(recorded_at, {ISO})"),
        ("silver_sensors", "silver", "silver", "recorded_at"),
        ("gold_sensors_hourly", "gold", "hourly", "window_start"),
        ("gold_sensors_daily", "gold", "risk", "CAST(date AS TIMESTAMP)"),
    )
)
_SUMMARY = f"""
SELECT device_id, date, reading_count,
       {', '.join(f"{half_up(f'{fn}_vibration_rms', 3)} AS {fn}_vibration_rms_mm_s" for fn in ('avg', 'min', 'max'))},
       {half_up('vibration_zscore', 3)} AS vibration_zscore, is_at_risk,
       {_rounded([f'{fn}_temperature_celsius' for fn in ('avg', 'min', 'max')], 2)},
       {_rounded([f'{fn}_pressure_bar' for fn in ('avg', 'min', 'max')], 3)}, _computed_at
FROM settled_risk WHERE date >= DATE '2024-01-31' - 30"""

_DEVICES = " UNION ALL ".join(
    f"SELECT '{period}' AS period, {start} AS period_start, count(DISTINCT device_id) AS devices, "
    "count(DISTINCT device_id) FILTER (is_at_risk) AS devices_at_risk FROM risk GROUP BY ALL"
    for period, start in (
        ("day", "date"),
        ("week", "CAST(date_trunc('week', date) AS DATE)"),
        ("all", "CAST(NULL AS DATE)"),
    )
)

# Metrics

_SNAPSHOT_AT = "TIMESTAMP '2024-01-30 12:00:00'"
_SNAPSHOT = " UNION ALL ".join(
    f"SELECT '{name}' AS metric_name, {half_up(f'CAST({value} AS DOUBLE)')} AS value, '{unit}' AS unit, "
    f"{_SNAPSHOT_AT} AS ts FROM {source}"
    for name, value, unit, source in (
        ("BronzeRowCount", "count(*)", "Count", "bronze"),
        ("SilverRowCount", "count(*)", "Count", "silver"),
        ("GoldHourlyRowCount", "count(*)", "Count", "hourly"),
        ("GoldDailyRowCount", "count(*)", "Count", "risk"),
        ("AtRiskDeviceCountAllTime", "count(DISTINCT device_id)", "Count", "risk WHERE is_at_risk"),
        (
            "AtRiskDeviceCount",
            "count(DISTINCT device_id)",
            "Count",
            "risk WHERE is_at_risk AND date = DATE '2024-01-30'",
        ),
        ("MaxVibrationZScore", "coalesce(max(vibration_zscore), 0.0)", "None", "risk WHERE date = DATE '2024-01-30'"),
        ("GoldTableLastUpdate", "coalesce(epoch(max(CAST(date AS TIMESTAMP))), 0)", "None", "risk"),
        ("GoldTableLastComputed", "coalesce(epoch(max(_computed_at)), 0)", "None", "risk"),
    )
)


def _rollup(seconds: int, where: str = "", feed: str = "feed") -> str:
    return f"""
    SELECT metric_name, CAST({seconds} AS BIGINT) AS period_seconds,
           time_bucket(INTERVAL {seconds} SECONDS, ts, TIMESTAMP '1970-01-01 00:00:00') AS period_start,
           sum(value) AS "sum", avg(value) AS average, max(value) AS maximum, min(value) AS minimum,
           count(value) AS sample_count, quantile_cont(value, 0.99) AS percentile
    FROM {feed} {where} GROUP BY ALL"""


_ROLLUP_COLUMNS = (
    f"metric_name, period_seconds, period_start, {half_up('\"sum\"')} AS \"sum\", "
    f"{_rounded(['average', 'maximum', 'minimum'])}, sample_count, {half_up('percentile')} AS percentile"
)
_RECENT = f"WHERE ts >= {AS_OF} - INTERVAL 3 HOURS AND ts < {AS_OF}"
_CURVES = f"""
SELECT r.metric_name, s.statistic, s.period_seconds, r.period_start,
       {half_up("CASE s.statistic WHEN 'Sum' THEN r.sum WHEN 'Average' THEN r.average "
                "WHEN 'Maximum' THEN r.maximum ELSE r.percentile END")} AS value
FROM ({_rollup(300, _RECENT)}) r
JOIN (VALUES ('RecordsIngested', 'Sum'), ('PipelineErrors', 'Sum'),
             ('GetRecords.IteratorAgeMilliseconds', 'Maximum'),
             ('BronzeWriteLatencyMs', 'Average'), ('BronzeWriteLatencyMs', 'p99'),
             ('SilverWriteLatencyMs', 'Average'), ('SilverWriteLatencyMs', 'p99'),
             ('GoldWriteLatencyMs', 'Average'), ('GoldWriteLatencyMs', 'p99')) v(metric_name, statistic)
  ON r.metric_name = v.metric_name
JOIN (SELECT 'Sum' AS statistic, CAST(300 AS BIGINT) AS period_seconds
      UNION ALL SELECT 'Average', 300 UNION ALL SELECT 'Maximum', 300 UNION ALL SELECT 'p99', 300) s
  ON s.statistic = v.statistic"""
#: The hourly curves, all of them maxima, beside the others.
_TABLE_METRICS = "'BronzeRowCount', 'SilverRowCount', 'GoldHourlyRowCount', 'GoldDailyRowCount', 'AtRiskDeviceCount', 'MaxVibrationZScore'"
_HOURLY_CURVES = f"""
SELECT metric_name, 'Maximum' AS statistic, period_seconds, period_start, {half_up("maximum")} AS value
FROM ({_rollup(3600, _RECENT, "table_feed")}) WHERE metric_name IN ({_TABLE_METRICS})"""
_STATES = f"""
, rules AS (SELECT * FROM (VALUES
    ('ingestion-stale', 'RecordsIngested', 'Sum', 300, 1, '<', 1.0, TRUE, NULL),
    ('pipeline-errors', 'PipelineErrors', 'Sum', 300, 1, '>=', 1.0, FALSE, NULL),
    ('stream-lag', 'GetRecords.IteratorAgeMilliseconds', 'Maximum', 300, 1, '>', 60000.0, FALSE, NULL),
    ('storage-errors', '5xxErrors', 'Sum', 300, 1, '>=', 1.0, FALSE, NULL),
    ('gold-stale', 'GoldTableLastUpdate', 'Maximum', 3600, 2, '<', epoch({AS_OF}) - 7200, TRUE, NULL),
    ('device-errors', 'PipelineErrors', 'SampleCount', 3600, 2, '>=', 1.0, FALSE, 'device-000003')
  ) v(rule, metric_name, statistic, period, periods, op, threshold, missing, device)),
measured AS (
  SELECT rule, CAST(floor(epoch(ts) / period) * period AS BIGINT) AS p, sum(value) AS s, max(value) AS m, count(value) AS n
  FROM feed JOIN rules ON feed.metric_name = rules.metric_name
   AND (rules.device IS NULL OR rules.device = feed.device)
  GROUP BY ALL),
spine AS (
  SELECT *, unnest(generate_series(CAST(epoch(TIMESTAMP '2024-01-01') AS BIGINT),
                                   CAST(epoch({AS_OF}) AS BIGINT) - period, period)) AS p FROM rules),
judged AS (
  SELECT spine.*, CASE statistic WHEN 'Sum' THEN s WHEN 'Maximum' THEN m ELSE CAST(n AS DOUBLE) END AS value,
         coalesce(CASE op WHEN '<' THEN value < threshold WHEN '>' THEN value > threshold ELSE value >= threshold END,
                  missing) AS breaching
  FROM spine LEFT JOIN measured USING (rule, p)),
recent AS (
  SELECT *, count(*) FILTER (breaching) OVER w AS two FROM judged
  WINDOW w AS (PARTITION BY rule ORDER BY p ROWS BETWEEN 1 PRECEDING AND CURRENT ROW))
SELECT rule, make_timestamp(p * 1000000) AS period_start, {half_up('value')} AS value, breaching,
       CASE WHEN breaching AND (periods = 1 OR two = 2) THEN 'ALARM' ELSE 'OK' END AS state
FROM recent"""

_DEFAULT_STATES = (
    _STATES.replace("'GoldTableLastUpdate'", "'GoldTableLastComputed'")
    .replace("    ('device-errors', 'PipelineErrors', 'SampleCount', 3600, 2, '>=', 1.0, FALSE, 'device-000003')\n", "")
    .replace(f"epoch({AS_OF}) - 7200, TRUE, NULL),\n", f"epoch({AS_OF}) - 7200, TRUE, NULL)\n")
    .replace(
        "threshold, missing, device)),",
        "threshold, missing, device) UNION ALL SELECT DISTINCT 'PipelineErrors-' || printf('device-%06d', user_id), 'PipelineErrors', "
        "'Sum', 86400, 2, '>=', 1.0, FALSE, printf('device-%06d', user_id) FROM events),",
    )
)

# Sources and sinks

_TEXT_DEVICE = "CASE WHEN {k} = 1 THEN '' ELSE '\"device_id\":\"' || printf('device-%06d', user_id) || '\",' END"
_K = "event_id % 20"
_RAW_TEXT = f"""
SELECT event_id, ts, user_id, value,
       CASE WHEN {_K} = 8 THEN '[' || t || ']' ELSE t END AS text, {_K} AS k
FROM (SELECT *, '{{' || {_TEXT_DEVICE.format(k=_K)}
      || '"entry_id":' || CASE WHEN {_K} = 2 THEN '"' || event_id || '"' ELSE CAST(event_id AS VARCHAR) END
      || ',"recorded_at":' || CASE WHEN {_K} = 3 THEN 'null' WHEN {_K} = 9 THEN '"soon"' ELSE '"' || strftime(ts, {ISO}) || '"' END
      || ',"vibration_rms":' || CASE WHEN {_K} = 4 THEN '"high"' WHEN {_K} = 5 THEN 'null' WHEN {_K} = 10 THEN '1e999' ELSE CAST(value AS VARCHAR) END
      || CASE WHEN {_K} = 6 THEN ',"firmware":"v1","batch":7' ELSE '' END
      || ',"source_channel":' || CASE WHEN {_K} = 11 THEN '99999999999' ELSE CAST(user_id % 3 AS VARCHAR) END
      || CASE WHEN {_K} = 7 THEN '' ELSE '}}' END AS t FROM events)"""
_NUMBER_TYPES = "('UBIGINT', 'BIGINT', 'DOUBLE', 'NULL')"
_CHECKED = f"""
texts AS ({_RAW_TEXT}),
parsed AS (SELECT *, CASE WHEN json_valid(text) THEN CAST(text AS JSON) END AS j FROM texts),
checked AS (
  SELECT *, CASE
    WHEN j IS NULL THEN 'not_json'
    WHEN json_type(j) <> 'OBJECT' THEN 'not_an_object'
    ELSE coalesce(array_to_string(list_concat(
      [CASE WHEN NOT json_exists(j, '$.device_id') THEN 'missing:device_id'
            WHEN json_type(j, '$.device_id') <> 'VARCHAR' THEN 'type:device_id' END,
       CASE WHEN NOT json_exists(j, '$.entry_id') THEN 'missing:entry_id'
            WHEN json_type(j, '$.entry_id') NOT IN ('UBIGINT', 'BIGINT') THEN 'type:entry_id' END,
       CASE WHEN NOT json_exists(j, '$.recorded_at') THEN 'missing:recorded_at'
            WHEN json_type(j, '$.recorded_at') <> 'VARCHAR' THEN 'type:recorded_at'
            WHEN try_strptime(json_extract_string(j, '$.recorded_at'), {ISO}) IS NULL THEN 'format:recorded_at' END,
       CASE WHEN text LIKE '%"vibration_rms":1e999,%' THEN 'nonfinite:vibration_rms'
            WHEN json_type(j, '$.vibration_rms') NOT IN {_NUMBER_TYPES} THEN 'type:vibration_rms' END,
       CASE WHEN CAST(json_extract_string(j, '$.source_channel') AS BIGINT) > 2147483647 THEN 'range:source_channel' END],
      list_transform(list_sort(list_filter(json_keys(j), lambda x: x NOT IN ('device_id', 'entry_id', 'recorded_at',
        'vibration_rms', 'temperature_celsius', 'pressure_bar', 'source_channel', 'ingested_at'))),
        lambda x: 'extra:' || x)), ';'), '') END AS violations
  FROM parsed)"""
_FEED_PARSE = f"""
WITH payloads AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 9 ELSE 276330 END AS channel_id,
         CAST('{{"channel":{{"name":"c"}},"feeds":[' || CASE WHEN event_id % 11 = 0 THEN '' ELSE '{{'
           || CASE WHEN event_id % 19 = 0 THEN '' ELSE '"entry_id":' || event_id || ',' END
           || '"created_at":"' || strftime(ts, {ISO})
           || '","field1":"' || CASE WHEN event_id % 7 = 0 THEN 'N/A' ELSE CAST(value AS VARCHAR) END
           || '","field2":"' || CASE WHEN event_id % 5 = 0 THEN ' ' ELSE ' ' || json_extract_string(props, '$.k') || ' ' END
           || '","field3":' || CASE WHEN event_id % 3 = 0 THEN 'null' ELSE CAST(user_id AS VARCHAR) END
           || '}},{{"entry_id":1,"created_at":"2000-01-01T00:00:00Z","field1":"0"}}' END || ']}}' AS JSON) AS payload
  FROM events),
channels(channel_id, device_id) AS (VALUES (9, 'device-001'), (276330, 'device-002'), (9, 'device-003'))
SELECT device_id, coalesce(CAST(json_extract_string(payload, '$.feeds[0].entry_id') AS BIGINT), 0) AS entry_id,
       coalesce(json_extract_string(payload, '$.feeds[0].created_at'), '') AS recorded_at,
       TRY_CAST(trim(json_extract_string(payload, '$.feeds[0].field1')) AS DOUBLE) AS vibration_rms,
       TRY_CAST(trim(json_extract_string(payload, '$.feeds[0].field2')) AS DOUBLE) AS temperature_celsius,
       TRY_CAST(trim(json_extract_string(payload, '$.feeds[0].field3')) AS DOUBLE) AS pressure_bar,
       CAST(channel_id AS INTEGER) AS source_channel
FROM payloads JOIN channels USING (channel_id)
WHERE json_array_length(payload, '$.feeds') > 0"""

_RAW_COLUMNS = (
    f"device_id, entry_id, recorded_at, {_rounded(METRICS)}, source_channel, ingested_at"
)
_SILVER_COLUMNS = f"device_id, entry_id, recorded_at, {_rounded(METRICS)}, source_channel, _ingested_at"

ORACLES = {
    "silver_clean": _with(f"SELECT {_SILVER_COLUMNS} FROM clean", "clean"),
    "silver_dedupe": _with(f"SELECT {_SILVER_COLUMNS} FROM silver", "silver"),
    **dict.fromkeys(("silver_upsert", "silver_upsert_growth", "silver_upsert_pruned"), f"""
WITH first_raw AS ({_FIRST}), second_raw AS ({_SECOND}),
target AS ({_clean('first_raw')}), batch AS ({_clean('second_raw')})
SELECT {_SILVER_COLUMNS} FROM (
  SELECT * FROM target t WHERE NOT EXISTS (
    SELECT 1 FROM batch b WHERE b.device_id = t.device_id AND b.entry_id = t.entry_id)
  UNION ALL SELECT * FROM batch)"""),
    "silver_stream": _with(f"SELECT {_SILVER_COLUMNS} FROM silver", "silver"),
    "sentinel_to_null": _with(f"SELECT {_SILVER_COLUMNS} FROM readings", "readings"),
    "gold_hourly": _with(f"SELECT {_hourly_columns()} FROM hourly", "hourly"),
    "gold_hourly_stream": _with(f"SELECT {_hourly_columns()} FROM hourly", "hourly"),
    "gold_hourly_from_parts": _with(f"SELECT {_hourly_columns()} FROM hourly", "hourly"),
    "gold_daily": _with(f"SELECT {_daily_columns()} FROM daily", "daily"),
    "gold_daily_from_hours": _with(f"SELECT {_daily_columns()} FROM daily", "daily"),
    "zscore_daily": _with(
        f"SELECT device_id, date, {_rounded(['avg_vibration_rms', 'vibration_zscore'])} FROM daily2", "daily2"
    ),
    "zscore_days": _with(
        f"SELECT device_id, date, {_rounded(['avg_vibration_rms', 'vibration_zscore'])} FROM days14", "days14"
    ),
    **dict.fromkeys(
        ("zscore_24h_hourly", "zscore_split_series"),
        _with(f"SELECT device_id, window_start, {_rounded(['avg_vibration_rms', 'vibration_zscore'])} FROM hourly24", "hourly24"),
    ),
    **dict.fromkeys(
        ("risk_flag", "zscore_split_rows"),
        _with(f"SELECT device_id, date, {_rounded(['avg_vibration_rms', 'vibration_zscore'])}, is_at_risk FROM risk", "risk"),
    ),
    "devices_by_range": _with(_DEVICES, "risk"),
    "daily_risk": _with(
        f"SELECT {_daily_columns()}, {half_up('vibration_zscore')} AS vibration_zscore, "
        "vibration_zscore > 2.5 AS is_at_risk FROM daily2",
        "daily2",
    ),
    "gold_refresh": _with(
        f"SELECT {_daily_columns()}, {half_up('vibration_zscore')} AS vibration_zscore, is_at_risk FROM risk", "risk"
    ),
    "pipeline_full": _moved(
        f"SELECT {_daily_columns()}, {half_up('vibration_zscore')} AS vibration_zscore, "
        "vibration_zscore > 2.5 AS is_at_risk FROM daily14",
        "daily14",
    ),
    "pipeline_incremental": _moved(
        f"SELECT {_daily_columns()}, {half_up('vibration_zscore')} AS vibration_zscore, "
        "vibration_zscore > 2.5 AS is_at_risk FROM daily14",
        "daily14",
    ),
    "silver_null_keys": _moved(f"SELECT {_SILVER_COLUMNS.replace(', _ingested_at', '')} FROM silver", "silver"),
    "bronze_quality": "WITH bronze AS (" + CTES["raw"] + ") " + " UNION ALL ".join(
        _battery("bronze_sensors", f"(SELECT * FROM bronze WHERE entry_id % {BRONZE_FILES} = {k})", False)
        for k in range(BRONZE_FILES)
    ),
    "dq_report": _with(_battery("silver_sensors", "silver", True), "silver"),
    "dq_report_bronze": _with(_battery("bronze_sensors", "bronze", False), "bronze"),
    "dq_summary": _with(
        f"""SELECT table_name, count(*) AS checks, count(*) FILTER (passed) AS passed,
        count(*) FILTER (NOT passed) AS failed
        FROM ({_battery('bronze_sensors', 'bronze', False)} UNION ALL {_battery('silver_sensors', 'silver', True)})
        GROUP BY table_name""",
        "silver",
    ),
    "table_stats": _with(
        "SELECT 'silver_sensors' AS table_name, count(*) AS row_count, count(DISTINCT device_id) AS distinct_devices, "
        "min(recorded_at) AS min_recorded_at, max(recorded_at) AS max_recorded_at FROM silver",
        "silver",
    ),
    "table_row_count": "SELECT count(*) AS row_count, 'events' AS table_name FROM events "
    "UNION ALL SELECT 0, 'no_such_table'",
    "sql_text": _with(
        f"SELECT device_id, count(*) AS readings, {half_up('max(vibration_rms)')} AS max_vibration_rms "
        f"FROM silver WHERE recorded_at < {AS_OF} GROUP BY device_id",
        "silver",
    ),
    "twin_state": _with(_TWIN, "silver"),
    "at_risk_7d": _with(_AT_RISK, "settled_risk"),
    "trend_24h": _with(_TREND, "settled_hourly"),
    "pipeline_health": _with(_HEALTH, "risk"),
    "daily_summary_30d": _with(_SUMMARY, "settled_risk"),
    "metrics_snapshot": _with(_SNAPSHOT, "risk"),
    "metrics_published": _with(_SNAPSHOT, "risk"),
    "bronze_audit": "SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(2 AS BIGINT) AS runs, CAST(0 AS BIGINT) AS without_file, "
    "CAST(0 AS BIGINT) AS without_time, CAST(sum(n) AS BIGINT) AS counted_on_the_way FROM (SELECT count(*) AS n FROM events "
    "UNION ALL SELECT count(*) FROM events WHERE event_id % 10 = 0 OR CAST(ts AS DATE) = DATE '2024-01-01')",
    "ingest_count": _with(
        f"SELECT 'RecordsIngested' AS metric_name, device_id, CAST(count(*) AS DOUBLE) AS value, 'Count' AS unit, "
        f"{AS_OF} AS ts FROM bronze WHERE device_id IS NOT NULL GROUP BY device_id",
        "bronze",
    ),
    "stage_latency": _with(
        f"SELECT 'BronzeWriteLatencyMs' AS metric_name, coalesce(device_id, 'ALL') AS device_id, "
        f"{half_up(f'(epoch_us(_ingested_at) - epoch_us(try_strptime(recorded_at, {ISO}))) / 1000.0')} AS value, "
        "'Milliseconds' AS unit, _ingested_at AS ts FROM bronze",
        "bronze",
    ),
    "metric_rollup": _with(f"SELECT {_ROLLUP_COLUMNS} FROM ({_rollup(300)})", "feed"),
    "metric_rollup_daily": _with(f"SELECT {_ROLLUP_COLUMNS} FROM ({_rollup(86400)})", "feed"),
    "metric_rollup_pyramid": _with(
        " UNION ALL ".join(f"SELECT {_ROLLUP_COLUMNS} FROM ({_rollup(s, '', 'table_feed')})" for s in (300, 3600, 86400)),
        "table_feed",
    ),
    "dashboard_curves": _with(_CURVES, "feed"),
    "dashboard_curves_stored": _with(f"{_CURVES} UNION ALL {_HOURLY_CURVES}", "table_feed"),
    "alarm_state": _with("", "feed") + _STATES,
    "alarm_state_default": _with("", "feed").replace(
        "UNION ALL SELECT 'GoldTableLastUpdate'",
        "UNION ALL SELECT 'GoldTableLastComputed', CAST(floor(epoch(ts)) AS DOUBLE), NULL, ts FROM events WHERE event_id % 3 = 0 "
        "UNION ALL SELECT 'GoldTableLastUpdate'",
    )
    + _DEFAULT_STATES,
    "feed_parse": _FEED_PARSE,
    "contract_valid": f"""WITH {_CHECKED}
SELECT json_extract_string(j, '$.device_id') AS device_id, CAST(json_extract_string(j, '$.entry_id') AS BIGINT) AS entry_id,
       json_extract_string(j, '$.recorded_at') AS recorded_at,
       CAST(json_extract_string(j, '$.vibration_rms') AS DOUBLE) AS vibration_rms,
       CAST(NULL AS DOUBLE) AS temperature_celsius, CAST(NULL AS DOUBLE) AS pressure_bar,
       CAST(json_extract_string(j, '$.source_channel') AS INTEGER) AS source_channel,
       CAST(NULL AS VARCHAR) AS ingested_at
FROM checked WHERE violations = ''""",
    "contract_quarantine": f"WITH {_CHECKED} SELECT event_id, text AS value, violations FROM checked WHERE violations <> ''",
    "contract_from_schema": f"""WITH {_CHECKED},
schema_checked AS (SELECT * REPLACE (replace(replace(violations, ';range:source_channel', ''), 'range:source_channel', '') AS violations)
  FROM checked),
read AS (SELECT *, CASE WHEN violations = '' THEN j END AS good FROM schema_checked)
SELECT event_id, violations, json_extract_string(good, '$.device_id') AS device_id,
       CAST(json_extract_string(good, '$.entry_id') AS BIGINT) AS entry_id,
       json_extract_string(good, '$.recorded_at') AS recorded_at,
       CAST(json_extract_string(good, '$.vibration_rms') AS DOUBLE) AS vibration_rms,
       CAST(NULL AS DOUBLE) AS temperature_celsius, CAST(NULL AS DOUBLE) AS pressure_bar,
       CAST(json_extract_string(good, '$.source_channel') AS BIGINT) AS source_channel, CAST(NULL AS VARCHAR) AS ingested_at
FROM read""",
    "landing_checked": f"""
SELECT device_id, entry_id, CASE WHEN entry % 23 = 0 THEN '' ELSE recorded_at END AS recorded_at,
       {", ".join(METRICS)}, CASE WHEN entry % 23 = 0 THEN 'format:recorded_at' ELSE '' END AS violations
FROM ({_FEED_PARSE.replace("SELECT device_id, coalesce", "SELECT event_id AS entry, device_id, coalesce").replace("SELECT CASE WHEN user_id % 2", "SELECT event_id, CASE WHEN user_id % 2")})""",
    "landing_json": _with(
        f"SELECT {_RAW_COLUMNS}, '2024' AS year, '01' AS month, '31' AS day, '00' AS hour FROM raw", "raw"
    ),
    "landing_delivery": _with(f"SELECT {_RAW_COLUMNS} FROM raw", "raw"),
    "ordered_handoff": _with(f"SELECT {_RAW_COLUMNS} FROM raw", "raw"),
    "bronze_ingest": _with(
        f"SELECT {_RAW_COLUMNS}, CAST(try_strptime(recorded_at, {ISO}) AS DATE) AS _partition_date FROM raw", "raw"
    ),
    "partition_overwrite": _with(
        f"SELECT device_id, date, {_rounded(FIGURES)}, "
        "reading_count + CASE WHEN date >= DATE '2024-01-25' THEN 100 ELSE 0 END AS reading_count FROM daily",
        "daily",
    ),
    "compact_cluster": _with(f"SELECT {_hourly_columns()} FROM hourly", "hourly"),
    "compact_zorder": _with(f"SELECT {_hourly_columns()} FROM hourly", "hourly"),
}
