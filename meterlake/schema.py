"""Schemas of the raw and the processed zone."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw columns in file order, their type, and what a missing cell
# becomes (None: it stays null).
RAW_FIELDS: tuple[tuple[str, str, object], ...] = (
    ("meter_id", "string", "UNKNOWN"),
    ("timestamp", "timestamp", None),
    ("voltage", "double", 0.0),
    ("current", "double", 0.0),
    ("power_factor", "double", 0.0),
    ("last_communication_time", "timestamp", None),
    ("battery_status", "string", "Unknown"),
    ("battery_pct", "int", 0),
    ("rssi", "double", 0.0),
    ("firmware_version", "string", "Unknown"),
    ("state", "string", "Unknown"),
    ("district", "string", "Unknown"),
    ("discom", "string", "Unknown"),
    ("feeder_id", "string", "Unknown"),
    ("consumption_kwh", "double", 0.0),
    ("voltage_issue", "boolean", False),
    ("power_factor_issue", "boolean", False),
    ("comm_issue", "boolean", False),
    ("signal_issue", "boolean", False),
    ("battery_issue", "boolean", False),
    ("health_status", "string", "Unknown"),
)

# Fields a delivery must contain.
REQUIRED_FIELDS = (
    "meter_id",
    "timestamp",
    "voltage",
    "current",
    "power_factor",
    "last_communication_time",
    "battery_status",
    "rssi",
    "firmware_version",
    "state",
    "district",
    "discom",
)

# Status names and the label of a missing meter.
HEALTHY, WARNING, CRITICAL = "Healthy", "Warning", "Critical"
STATUSES = (HEALTHY, WARNING, CRITICAL)
UNKNOWN_METER = "UNKNOWN"
OFFLINE_MINUTES = 180

RAW_COLUMNS = tuple(name for name, _, _ in RAW_FIELDS)
RAW_TYPES = {name: dtype for name, dtype, _ in RAW_FIELDS}
DEFAULTS = {name: value for name, _, value in RAW_FIELDS if value is not None}
UNDEFAULTED = tuple(name for name, _, value in RAW_FIELDS if value is None)
FLAGS = tuple(name for name, dtype, _ in RAW_FIELDS if dtype == "boolean")
DOUBLES = tuple(name for name, dtype, _ in RAW_FIELDS if dtype == "double")
IDENTITY = ("meter_id", "timestamp")
PARTITION_KEYS = ("year", "month", "day")

# A raw delivery is always read as text, so a bad cell stays visible until it is parsed.
RAW_STRINGS = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])


SPARK_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
}


def _processed() -> T.StructType:
    out = T.StructType()
    for name, dtype, _ in RAW_FIELDS:
        if name == "health_status":
            out.add("issue_count", T.IntegerType())
        out.add(name, SPARK_TYPES[dtype])
        if name == "timestamp":
            out.add("event_date", T.DateType())
        if name == "last_communication_time":
            out.add("communication_lag_minutes", T.DoubleType())
    return out.add("year", T.IntegerType()).add("month", T.StringType()).add("day", T.StringType())


PROCESSED = _processed()
PROCESSED_COLUMNS = tuple(PROCESSED.names)
