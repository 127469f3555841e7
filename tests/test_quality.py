from making import SF_SMALL, raw, records
from pyspark.sql import functions as F

from meterlake.operators import quality
from meterlake.operators.clean import clean, conform
from meterlake.plans.catalogue import readings
from meterlake.schema import RAW_COLUMNS


def typed(df):
    """Parsed but not filled, as a profile sees a delivery."""
    return df.withColumns(
        {"timestamp": F.col("timestamp").try_cast("timestamp"), "voltage": F.col("voltage").try_cast("double")}
    )


def test_drift(spark):
    delivered = raw(spark, {}).drop("rssi").withColumn("note", F.lit("x")).select("timestamp", "meter_id", "note", *RAW_COLUMNS[2:8], *RAW_COLUMNS[9:])
    report = {r.column_name: (r.status, r.present_cells) for r in quality.drift_report(delivered).collect()}
    assert report["rssi"] == ("missing", 0) and report["note"] == ("unexpected", 1)
    assert report["timestamp"] == ("moved", 1) and report["health_status"] == ("ok", 0)


def test_unparseable_and_missing_are_told_apart(spark):
    df = raw(spark, {"voltage": "abc", "rssi": None}, {"voltage": "NaN", "timestamp": "garbage"}, {"comm_issue": "maybe", "battery_pct": "5.7"})
    counts = {r.column_name: r.unparseable_cells for r in quality.unparseable_counts(df).collect()}
    assert {name: n for name, n in counts.items() if n} == {"voltage": 2, "timestamp": 1, "comm_issue": 1}


def test_identity_and_verdict(spark):
    df = typed(raw(spark, {}, {}, {"meter_id": None}, {"meter_id": "M2", "timestamp": "2024-03-06 00:00:00"}))
    row = quality.identity_profile(df).first()
    assert (row.row_count, row.unique_meters, row.duplicate_rows) == (4, 2, 1)
    assert quality.verdict(df).first().fit_for_use is False
    assert quality.verdict(df.filter("meter_id = 'M2'")).first().fit_for_use is True
    assert quality.verdict(df.drop("voltage")).first().fit_for_use is False
    assert quality.verdict(df.drop("timestamp")).first().fit_for_use is False
    assert quality.missing_required(df.drop("voltage")) == ["voltage"]


def test_violations(spark):
    df = clean(raw(spark, {"voltage": "199.9", "rssi": "-111"}, {"meter_id": "M2", "voltage": "abc"}, {"meter_id": "M3", "voltage": "250"}))
    found = [(r.meter_id, r.measure, r.value) for r in quality.range_violations(df).collect()]
    assert sorted(found) == [("M1", "rssi", -111.0), ("M1", "voltage", 199.9)]
    assert quality.range_violations(df, {"voltage": (0, 240)}).first().meter_id == "M3"


def test_losses(spark):
    df = typed(raw(spark, {}, {}, {"meter_id": None}, {"timestamp": None}, {"meter_id": "M4", "timestamp": "x"}))
    assert quality.load_losses(df).first().asDict() == {
        "raw_rows": 5, "unknown_meter_rows": 1, "untimed_rows": 2, "surplus_copies": 1, "kept_rows": 2,
    }
    assert quality.duplicate_readings(df).first().copies == 2
    assert records(quality.missing_timestamps(df)) == [("M1", 1), ("M4", 1)]


def test_declared_status(spark):
    df = raw(spark, {"health_status": "Critical"}, {"health_status": "Healthy"}, {"health_status": None})
    assert [tuple(r) for r in quality.declared_mismatches(df).collect()] == [("Critical", "Healthy", 1)]


def test_differences_count_copies(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "n int, s string")
    right = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "n int, s string")
    assert records(quality.row_differences(left, right)) == [(1, "a", 2, 1), (3, "c", 0, 1)]
    assert quality.row_differences(left, left).count() == 0


def test_profile_of_derived_readings(spark):
    delivery = conform(raw(spark, {}, {"meter_id": "M2", "voltage_issue": "true"}))
    report = quality.profile(delivery)
    for name, alone in (
        ("shape", quality.shape),
        ("null_counts", quality.null_counts),
        ("identity", quality.identity_profile),
        ("numeric_ranges", quality.numeric_ranges),
        ("category_counts", quality.category_counts),
        ("issue_rates", quality.issue_rates),
        ("verdict", quality.verdict),
    ):
        assert records(report[name]) == records(alone(delivery)), name
    assert report["shape"].first().row_count == 2
    assert {r.flag: r.issue_rate_pct for r in report["issue_rates"].collect()}["voltage_issue"] == 50.0
    assert report["verdict"].first().fit_for_use
    labels = quality.category_counts(readings(spark, SF_SMALL))
    assert {r[0] for r in labels.groupBy("column_name").agg(F.sum("row_count").alias("n")).select("n").collect()} == {999}


def test_checks_on_empty_input(spark):
    empty = typed(raw(spark, {})).filter("false")
    assert quality.identity_profile(empty).first().row_count == 0
    assert quality.load_losses(empty).first().kept_rows == 0
    assert {r.null_count for r in quality.null_counts(empty).collect()} == {0}


def test_sniffing_counts_cells_as_plain_casts_do(spark):
    """Asking before a cast changes no count, columns are counted cell by cell, and a table may be empty."""
    cells = ["true", " TRUE\t", "T", "no", "0", "01", "+1", " 7 ", "\x017\x7f", "5.", ".5", "1e5", "1d", "0x1p3", "inf", "+Infinity", " nan "]
    cells += ["12:30", "T12:30", "2024", "2024-01-05", "2024-01-05T10:00:00Z", " 2024-01-05 ", "99999999999", "abc", "", "FW-2.1", "true\n", None]
    df = spark.createDataFrame([(c,) for c in cells], "cell string")
    plain = {t: df.where(F.col("cell").try_cast(t).isNotNull()).count() for t in quality.CELL_TYPES[:-1]}
    assert {t: df.where(quality._fits(t)).count() for t in plain} == plain
    found = quality.sniffed_types(df)
    assert "Generate" in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("cell", "string", len(cells) - 1, 0)]
    assert [tuple(r) for r in quality.sniffed_types(df.limit(0)).collect()] == [("cell", "string", 0, 0)]
