import datetime as dt

import pytest
from making import raw, records
from pyspark.sql import functions as F

from meterlake.operators.clean import add_missing, clean, conform, dedupe
from meterlake.schema import PROCESSED, PROCESSED_COLUMNS


def one(spark, **cells):
    return clean(raw(spark, cells)).first()


def test_schema_and_order(spark):
    cleaned = clean(raw(spark, {}))
    assert tuple(cleaned.columns) == PROCESSED_COLUMNS
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in PROCESSED]
    row = cleaned.first()
    assert (row.event_date, row.year, row.month, row.day) == (dt.date(2024, 3, 5), 2024, "03", "05")
    assert row.communication_lag_minutes == 30.0


@pytest.mark.parametrize(
    "column, cell, value",
    [
        ("voltage", None, 0.0),
        ("voltage", "abc", None),
        ("voltage", "NaN", None),
        ("voltage", "Infinity", None),
        ("battery_pct", "5.7", 5),
        ("battery_pct", None, 0),
        ("battery_pct", "x", None),
        ("signal_issue", None, False),
        ("signal_issue", "maybe", None),
        ("signal_issue", "true", True),
        ("meter_id", None, "UNKNOWN"),
        ("state", None, "Unknown"),
        ("last_communication_time", None, None),
        ("last_communication_time", "soon", None),
    ],
)
def test_cells(spark, column, cell, value):
    assert one(spark, **{column: cell})[column] == value


def test_numbers_may_stay_missing(spark):
    row = conform(raw(spark, {"voltage": None, "battery_pct": None, "state": None}), fill_numeric=False).first()
    assert (row.voltage, row.battery_pct, row.state) == (None, None, "Unknown")


@pytest.mark.parametrize("cell", [None, "garbage"])
def test_reading_without_time_is_dropped(spark, cell):
    assert clean(raw(spark, {"timestamp": cell})).count() == 0


def test_unknown_flag_leaves_status_healthy(spark):
    row = one(spark, comm_issue="maybe", voltage_issue="true", power_factor_issue="true", battery_issue="true")
    assert (row.issue_count, row.health_status) == (None, "Healthy")


@pytest.mark.parametrize("issues, status", [(0, "Healthy"), (1, "Warning"), (2, "Warning"), (3, "Critical"), (5, "Critical")])
def test_status_by_issue_count(spark, issues, status):
    flags = ("voltage_issue", "power_factor_issue", "comm_issue", "signal_issue", "battery_issue")
    row = one(spark, health_status="Nonsense", **{flag: "true" for flag in flags[:issues]})
    assert (row.issue_count, row.health_status) == (issues, status)


def test_lag_modes(spark):
    cells = {"timestamp": "2024-03-05 10:00:05", "last_communication_time": "2024-03-05 09:58:50"}
    assert clean(raw(spark, cells)).first().communication_lag_minutes == 1.25
    assert clean(raw(spark, cells), lag_mode="boundary").first().communication_lag_minutes == 2.0
    with pytest.raises(ValueError):
        clean(raw(spark, cells), lag_mode="other")


def test_missing_column_gets_default(spark):
    row = clean(raw(spark, {}).drop("rssi", "discom", "battery_issue")).first()
    assert (row.rssi, row.discom, row.battery_issue) == (0.0, "Unknown", False)


def test_missing_time_column_is_an_error(spark):
    with pytest.raises(ValueError, match="timestamp"):
        add_missing(raw(spark, {}).drop("timestamp"))


def test_unnamed_meters_collapse(spark):
    assert clean(raw(spark, {"meter_id": None}, {"meter_id": None, "voltage": "1"})).count() == 1


def test_dedupe_is_deterministic_and_idempotent(spark):
    rows = [{"consumption_kwh": str(n), "rssi": str(-n)} for n in range(5)] + [{"meter_id": "M2"}]
    forward, backward = clean(raw(spark, *rows)), clean(raw(spark, *reversed(rows)).repartition(3))
    assert records(forward) == records(backward)
    again = forward.drop("event_date").transform(dedupe)
    assert again.count() == forward.count() == 2


def test_dedupe_by_source_order(spark):
    source = raw(spark, {"consumption_kwh": "2"}, {"consumption_kwh": "1"}).withColumn(
        "arrival", F.when(F.col("consumption_kwh") == "2", 1).otherwise(2)
    )
    assert clean(source, order=["arrival"]).first().consumption_kwh == 2.0


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    """Many copies of one reading: each map task sends one row, whatever it holds."""
    copies = raw(spark, {}).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(30_000)))).drop("n").repartition(6)
    cleaned = clean(copies)
    assert cleaned.count() == 1
    plan = cleaned._jdf.queryExecution().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert plan.rindex("Exchange hashpartitioning(timestamp") < plan.rindex("Partial")
