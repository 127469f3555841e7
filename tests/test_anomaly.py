import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from meterlake.operators.anomaly import group_outliers, rolling_outliers, voltage_bands, with_severity

START = dt.datetime(2024, 3, 1)


def series(meter, count, step_minutes, seed):
    rng = random.Random(seed)
    at, rows = START, []
    for _ in range(count):
        at += dt.timedelta(minutes=rng.uniform(0.1, step_minutes))
        value = None if rng.random() < 0.02 else round(rng.gauss(50, 5) + (100 if rng.random() < 0.02 else 0), 2)
        rows.append((meter, at, value))
    return rows


def brute_force(rows, window, threshold):
    out, history = {}, {}
    for meter, at, value in sorted(rows):
        before = history.setdefault(meter, [])
        frame = [v for v in before[-window:] if v is not None]
        flagged = False
        if len(before) >= window and value is not None and len(frame) > 1:
            deviation = statistics.stdev(frame)
            if deviation > 0:
                flagged = abs((value - statistics.fmean(frame)) / deviation) > threshold
        out[(meter, at)] = (len(before) >= window and bool(frame), flagged)
        before.append(value)
    return out


@pytest.mark.parametrize("chunk", ["minute", "hour", "day", "month"])
def test_chunks_do_not_change_the_result(spark, chunk):
    """Dense, sparse and gapped histories; one meter holds most rows."""
    rows = series("HOT", 900, 1, 1) + series("B", 120, 90, 2) + series("C", 40, 3000, 3) + series("D", 3, 10, 4)
    df = spark.createDataFrame(rows, "meter_id string, timestamp timestamp, consumption_kwh double").repartition(4)
    found = rolling_outliers(df, window=7, threshold=3.0, chunk=chunk).collect()
    expected = brute_force(rows, 7, 3.0)
    assert len(found) == len(rows)
    assert {(r.meter_id, r.timestamp): (r.mean_value is not None, r.is_outlier) for r in found} == expected
    assert sum(r.is_outlier for r in found) > 5


def test_flat_history_has_no_score(spark):
    rows = [("A", START + dt.timedelta(hours=n), 5.0) for n in range(5)] + [("A", START + dt.timedelta(hours=9), 500.0)]
    df = spark.createDataFrame(rows, "meter_id string, timestamp timestamp, consumption_kwh double")
    last = rolling_outliers(df, window=4).orderBy(F.desc("timestamp")).first()
    assert (last.mean_value, last.deviation, last.z_score, last.is_outlier) == (5.0, 0.0, None, False)


def test_unnamed_meters_are_kept_without_a_score(spark):
    rows = [("UNKNOWN", START + dt.timedelta(minutes=n), float(n)) for n in range(9)]
    df = spark.createDataFrame(rows, "meter_id string, timestamp timestamp, consumption_kwh double")
    found = rolling_outliers(df, window=3).collect()
    assert len(found) == 9 and {(r.mean_value, r.z_score, r.is_outlier) for r in found} == {(None, None, False)}


def test_group_outliers(spark):
    rows = [("g", f"f{n}", 10.0 + n % 3) for n in range(20)] + [("g", "odd", 99.0), ("h", "only", 1.0)]
    df = spark.createDataFrame(rows, "discom string, feeder_id string, kwh double")
    found = {r.feeder_id: r for r in group_outliers(df, "discom", "kwh").collect()}
    assert [name for name, r in found.items() if r.is_outlier] == ["odd"]
    values = [v for g, _, v in rows if g == "g"]
    assert found["odd"].z_score == round((99.0 - statistics.fmean(values)) / statistics.stdev(values), 4)
    assert found["only"].z_score is None


def test_group_outliers_keep_rows_without_a_group(spark):
    df = spark.createDataFrame([(None, "a", 1.0), (None, "b", 3.0), ("g", "c", None)], "discom string, feeder_id string, kwh double")
    found = {r.feeder_id: r for r in group_outliers(df, "discom", "kwh").collect()}
    assert len(found) == 3 and found["a"].mean_value == found["b"].mean_value == 2.0


def test_severity(spark):
    rows = [(3, 0.0, 90), (0, 181.0, 10), (2, 0.0, 90), (0, 181.0, 90), (1, None, 90), (0, 0.0, 10), (0, 180.0, 20), (None, None, None)]
    df = spark.createDataFrame(rows, "issue_count int, communication_lag_minutes double, battery_pct int")
    assert [r.severity for r in with_severity(df).collect()] == [
        "Severe", "Severe", "Major", "Major", "Minor", "Minor", "None", "None",
    ]


def test_voltage_bands(spark):
    df = spark.createDataFrame([("a", 199.9), ("a", 200.0), ("a", 250.1), ("b", None)], "state string, voltage double")
    assert [tuple(r) for r in voltage_bands(df, "state").orderBy("state").collect()] == [("a", 3, 1, 1), ("b", 1, 0, 0)]
