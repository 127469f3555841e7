"""Raw readings derived from the public star-schema test tables.

The reading stream is ``events``; the meter's place comes from ``customer``,
``nation`` and ``region``. All rules are integer arithmetic on keys, so any
engine derives the same rows, including missing cells and duplicate copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.schema import RAW_COLUMNS

SOURCE_ORDER = ("event_id", "dup")

# Rules over event_id, user_id, ts, value, dup and the names of the place.
CELLS = {
    "meter_id": "CASE WHEN event_id % 401 <> 400 THEN concat('MTR-', lpad(user_id, 6, '0')) END",
    "timestamp": "CASE WHEN event_id % 503 <> 502 THEN ts END",
    "voltage": "CASE WHEN event_id % 97 <> 96 THEN (1980 + (event_id * 37) % 560) / 10 END",
    "current": "((event_id * 53) % 1435) / 100",
    "power_factor": "(85 + (event_id * 7) % 11) / 100",
    "last_communication_time": "CASE WHEN event_id % 89 <> 88 THEN "
    "timestampadd(SECOND, -int((event_id * 7919) % 11400), ts) END",
    "battery_status": "CASE WHEN 5 + (event_id * 13) % 96 >= 50 THEN 'Good' "
    "WHEN 5 + (event_id * 13) % 96 >= 20 THEN 'Medium' ELSE 'Low' END",
    "battery_pct": "int(5 + (event_id * 13) % 96)",
    "rssi": "double(-115 + (event_id * 17) % 71)",
    "firmware_version": "CASE WHEN user_id % 11 <> 10 THEN concat('FW-2.', user_id % 5, '.0') END",
    "state": "r_name",
    "district": "n_name",
    "discom": "concat('DISCOM-', c_nationkey % 10)",
    "feeder_id": "concat('FDR-', lpad(user_id % 40, 3, '0'))",
    "consumption_kwh": "value + dup",
    "voltage_issue": "(event_id * 37) % 560 >= 530",
    "power_factor_issue": "(event_id * 7) % 11 = 0",
    "comm_issue": "(event_id * 7919) % 11400 > 10800",
    "signal_issue": "CASE WHEN event_id % 79 <> 78 THEN (event_id * 17) % 71 < 25 END",
    "battery_issue": "(event_id * 13) % 96 < 15",
    "health_status": "CAST(NULL AS string)",
}


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 21 raw columns plus the source order (``event_id``, ``dup``)."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    # No broadcast hint: customer grows with the data, so its measured size decides.
    placed = (
        table("events")
        .selectExpr("event_id", "CAST(ts AS timestamp) AS ts", "user_id", "value")
        .join(table("customer"), F.expr("user_id = c_custkey"))
        .join(table("nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table("region"), F.expr("n_regionkey = r_regionkey"))
    )
    copied = placed.selectExpr("*", "explode(if(event_id % 50 = 0, array(0, 1), array(0))) AS dup")
    return copied.selectExpr(*(f"{CELLS[name]} AS {name}" for name in RAW_COLUMNS), *SOURCE_ORDER)


def as_text(raw: DataFrame) -> DataFrame:
    """Every cell as text, the way a CSV export carries it."""
    return raw.selectExpr(*(f"CAST(`{name}` AS string) AS `{name}`" for name in raw.columns))


def faulty_text(raw: DataFrame) -> DataFrame:
    """Text cells of which some do not parse, beside the ones that are missing."""
    faults = {
        "timestamp": ("event_id % 509 = 11", "'garbage'"),
        "voltage": ("event_id % 61 = 7", "'abc'"),
        "battery_pct": ("event_id % 67 = 3", "concat(battery_pct, '.7')"),
        "comm_issue": ("event_id % 71 = 5", "'maybe'"),
    }

    def cell(name: str) -> str:
        text = f"CAST({name} AS string)"
        if name in faults:
            where, bad = faults[name]
            text = f"if({where}, {bad}, {text})"
        return f"{text} AS {name}"

    return raw.selectExpr(*(cell(name) for name in RAW_COLUMNS), *SOURCE_ORDER)
