"""Fixed values the results depend on, and the defaults of the jobs."""

METRICS = ("vibration_rms", "temperature_celsius", "pressure_bar")
KEYS = ("device_id", "entry_id")

# They decide the results.
MISSING = -1.0                 # stands for a missing metric in Silver
RISK_ZSCORE = 2.5              # at risk above this, strictly
RISK_FRAME_ROWS = 2            # rows in the daily z-score frame, current row included
VIBRATION_LIMIT = 10.0         # mm/s, hourly trend threshold, strict
LIVE_MINUTES = 5
RECENT_MINUTES = 15
AT_RISK_DAYS = 7
SUMMARY_DAYS = 30
TREND_HOURS = 24
DEFAULT_MAX_NULL_RATE = 0.05

PHYSICAL_RANGES = {
    "temperature_celsius": (-1.0, 200.0),
    "pressure_bar": (-1.0, 1000.0),
    "vibration_rms": (-1.0, 500.0),
}

# Fixed values: (channel id, device id, sensor name). One channel feeds two devices.
DEFAULT_CHANNELS = [
    (9, "device-001", "temperature_sensor_01"),
    (276330, "device-002", "vibration_sensor_01"),
    (9, "device-003", "pressure_sensor_01"),
]

# Tables this small are joined by broadcast; larger ones are shuffled.
BROADCAST_MAX_ROWS = 100_000
# So many partition values are pruned by an IN list; more by a semi join.
PRUNE_MAX_VALUES = 2_000
# A new Silver table gets key blocks of about so many rows, and at most so many
# blocks for its first batch.
KEY_BLOCK_ROWS = 4_000_000
KEY_BLOCK_MAX_COUNT = 5_000
# Partition column of the hourly table: the date of the window.
HOURLY_PARTITION = "_window_date"
