import pytest
from making import SF_SMALL, scanned_partitions
from pyspark.sql import functions as F

from meterlake.operators.charts import chart_query
from meterlake.operators.filters import apply_filters, in_dates, in_partition, restrict, with_flags
from meterlake.plans.catalogue import readings
from meterlake.plans.charts import CHARTS


@pytest.fixture(scope="module")
def table(spark):
    return readings(spark, SF_SMALL)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "start, end",
    [("2024-01-03", "2024-01-09"), ("2023-11-20", "2024-01-02"), (None, "2024-01-10"), ("2024-01-25", None), ("2022-02-02", "2025-01-01")],
)
def test_dates_match_a_plain_date_filter(table, start, end):
    plain = table
    if start:
        plain = plain.filter(F.col("event_date") >= start)
    if end:
        plain = plain.filter(F.col("event_date") <= end)
    assert in_dates(table, start, end).count() == plain.count()


def test_dates_prune_partitions(table):
    """Days read, as the scan counts them; a plan's text is shortened."""
    pruned = in_dates(table, "2024-01-03", "2024-01-09")
    days = pruned.select("day").distinct().count()
    assert 0 < days <= 7 < table.select("day").distinct().count()
    assert scanned_partitions(pruned.groupBy("state").count()) == days


def test_choices_are_pushed_to_the_scan(table):
    text = plan(apply_filters(table, state="ASIA", health_status=["Warning", "Critical"]))
    assert "EqualTo(state,ASIA)" in text and "In(health_status" in text


def test_no_filter_is_the_whole_table(table):
    assert apply_filters(table).count() == table.count()


def test_partition_by_number_or_text(table):
    assert in_partition(table, 2024, 1, 5).count() == in_partition(table, 2024, "01", "05").count() > 0


def test_flags(spark):
    rows = [("Healthy", 180.0, "Good", -80.0), ("Warning", 180.5, "Low", -80.5), ("Critical", None, "Medium", -90.5)]
    df = spark.createDataFrame(rows, "health_status string, communication_lag_minutes double, battery_status string, rssi double")
    flags = with_flags(df).select("unhealthy_flag", "offline_flag", "low_battery_flag", "signal_quality").collect()
    assert [tuple(r) for r in flags] == [(0, 0, 0, "Good"), (1, 1, 1, "Weak"), (1, 0, 0, "Poor")]


def test_restrict_keeps_each_reading_once(spark, table):
    grants = spark.createDataFrame(
        [("ann", "ASIA", "NATION_2"), ("ann", "ASIA", "NATION_2"), ("ann", "EUROPE", "x"), ("bob", "AFRICA", "x")],
        "principal string, state string, district string",
    )
    seen = restrict(table, grants, "ann")
    assert seen.count() == table.filter("state IN ('ASIA', 'EUROPE')").count()
    assert restrict(table, grants, "ann", by=("state", "district")).count() == table.filter(
        "state = 'ASIA' AND district = 'NATION_2'"
    ).count()
    assert restrict(table, grants, "eve").count() == 0


def test_charts_show_every_group(spark):
    from pyspark.sql import functions as F

    from meterlake.operators.charts import chart_query

    days = spark.range(1830).select((F.col("id") % 366).alias("day"), (F.col("id") % 5).alias("state"), F.col("id").alias("n"))
    assert chart_query(days, ("day", "state"), (("sum", "n"),)).count() == 1830


def test_chart_limit_and_time_range(table):
    full = CHARTS["daily_consumption"].query(table)
    assert CHARTS["daily_consumption"].query(table, limit=7).count() == 7
    part = CHARTS["daily_consumption"].query(table, time_range=("2024-01-01", "2024-01-03"))
    assert part.count() == full.filter("event_date <= '2024-01-03'").count()
    with pytest.raises(ValueError):
        chart_query(table, ["state"], [("median", "voltage")])


def test_chart_metrics(table):
    row = chart_query(
        table, [], [("max", "voltage"), ("count", "rssi"), ("count_distinct", "meter_id"), ("avg", "battery_pct")]
    ).first()
    assert (row.rssi, row.meter_id) == (999, 16)
