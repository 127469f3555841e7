import pytest
from making import SF_SMALL, raw, records
from pyspark.sql import functions as F

from meterlake.functions.measures import components, exact_avg, exact_sum, meter_day_rollup
from meterlake.functions.scalars import bin_floor
from meterlake.operators.clean import clean
from meterlake.plans import dashboard, notebook, statements, views
from meterlake.plans.catalogue import readings


@pytest.fixture(scope="module")
def table(spark):
    return readings(spark, SF_SMALL).cache()


@pytest.mark.parametrize("name", sorted(views.VIEWS))
def test_rollup_gives_the_same_view(table, name):
    build = views.VIEWS[name]
    assert records(build(meter_day_rollup(table))) == records(build(table))


@pytest.mark.parametrize("name", sorted(views.VIEWS))
def test_view_does_not_depend_on_partitioning(table, name):
    build = views.VIEWS[name]
    assert records(build(table.repartition(5, "rssi"))) == records(build(table.coalesce(1)))


def test_empty_input(spark):
    empty = clean(raw(spark, {})).filter("false")
    row = views.fleet_summary(empty).first()
    assert tuple(row) == (0, 0, 0, 0, None, None, None, None)
    assert [r.issue_count for r in views.issue_mix(empty).collect()] == [0] * 5
    assert views.feeder_risk(empty).count() == 0


def test_sums_agree(table):
    rows = table.count()
    assert views.health_by_status(table).agg(F.sum("readings")).first()[0] == rows
    assert views.issue_mix(table).agg(F.sum("issue_count")).first()[0] == table.agg(F.sum("issue_count")).first()[0]
    daily = views.daily_consumption(table).agg(exact_sum("total_consumption_kwh")).first()[0]
    monthly = views.monthly_consumption(table).agg(exact_sum("total_consumption_kwh")).first()[0]
    assert daily == monthly
    fleet = views.fleet_summary(table).first()
    by_state = views.state_health_summary(table).agg(*(F.sum(c) for c in ("healthy", "warning", "critical"))).first()
    assert tuple(by_state) == (fleet.healthy, fleet.warning, fleet.critical)


def test_lag_limit_is_exclusive(spark):
    cells = {"timestamp": "2024-03-05 10:00:00"}
    df = clean(
        raw(
            spark,
            {**cells, "meter_id": "A", "last_communication_time": "2024-03-05 07:00:00"},
            {**cells, "meter_id": "B", "last_communication_time": "2024-03-05 06:59:59"},
            {**cells, "meter_id": "C", "last_communication_time": None},
        )
    )
    assert views.communication_health(df).first().offline_meters == 1


def test_repeated_readings_tell_rows_from_meters(spark):
    """One meter, three readings: two healthy, one critical."""
    bad = {"voltage_issue": "true", "comm_issue": "true", "signal_issue": "true"}
    df = clean(
        raw(
            spark,
            {"timestamp": "2024-03-05 10:00:00"},
            {"timestamp": "2024-03-05 11:00:00"},
            {"timestamp": "2024-03-05 12:00:00", **bad},
        )
    )
    fleet = views.fleet_summary(df).first()
    assert (fleet.total_meters, fleet.healthy, fleet.critical) == (1, 2, 1)
    split = dashboard.meters_with_status(df).first()
    assert (split.healthy_meters, split.warning_meters, split.critical_meters) == (1, 0, 1)
    assert notebook.firmware_issues(df).first().meters == 2
    assert notebook.exact_firmware_issues(df).first().meters == 1
    assert views.state_health_summary(df).first().critical_pct == 33.33


def test_exact_mean_rounds_half_up_in_any_order(spark):
    """0.005 above a cent boundary: a plain double mean may land on either side."""
    values = [223.61, 223.62, 223.63, 223.64] * 25
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    assert df.agg(F.round(exact_avg("v"), 2)).first()[0] == 223.63
    assert df.agg(exact_sum("v")).first()[0] == 22362.5


@pytest.mark.parametrize("value", [-115.5, -0.000001, 0.0, 0.1, 9_000_000_000.25, -4_000_000.75])
def test_exact_sum_of_one_value(spark, value):
    assert spark.createDataFrame([(value,)], "v double").agg(exact_sum("v")).first()[0] == value


def test_components_skip_a_rollup(table):
    rollup = meter_day_rollup(table)
    assert components(rollup) is rollup


def test_bins(spark):
    df = spark.createDataFrame([(0.29,), (0.87,), (0.869999,), (-0.01,)], "v double")
    assert [r[0] for r in df.select(bin_floor("v", 0.01)).collect()] == [0.29, 0.87, 0.86, -0.01]
    below = spark.createDataFrame([(-115.0,), (-114.9,), (-110.0,), (-111.0,)], "v double")
    assert [r[0] for r in below.select(bin_floor("v", 5)).collect()] == [-115.0, -115.0, -110.0, -115.0]


def test_approximate_meters_are_close(table):
    exact = views.fleet_summary(table).first().total_meters
    assert abs(views.fleet_summary(table, approx=True).first().total_meters - exact) <= max(1, exact // 10)


def test_ranking_is_total(table):
    top = statements.biggest_consumers(table, 5).collect()
    totals = [row.total_consumption_kwh for row in top]
    assert totals == sorted(totals, reverse=True) and len(top) == 5


def test_register_and_materialise(spark, table, tmp_path):
    names = views.register_views(table, prefix="t_")
    assert len(names) == len(views.VIEWS)
    assert spark.sql("SELECT total_meters FROM t_fleet_summary").first()[0] == 16
    paths = views.materialise_views(table, str(tmp_path / "extracts"))
    for name, path in paths.items():
        assert records(spark.read.parquet(path)) == records(views.VIEWS[name](table)), name


def test_failed_refresh_leaves_the_old_extracts(spark, table, tmp_path, monkeypatch):
    base = str(tmp_path / "extracts")
    before = views.materialise_views(table, base)
    rows = spark.read.parquet(before["feeder_risk"]).count()
    monkeypatch.setitem(views.VIEWS, "feeder_risk", lambda df: df.select(F.raise_error(F.lit("broken")).cast("int").alias("x")))
    with pytest.raises(Exception, match="broken"):
        views.materialise_views(table.limit(1), base)
    assert spark.read.parquet(before["feeder_risk"]).count() == rows
    assert [p.name for p in tmp_path.iterdir()] == ["extracts"]


def test_values_beyond_the_millionths_are_summed_too(spark):
    from meterlake.functions.measures import exact_sum

    df = spark.createDataFrame([(9.1e12,), (-9.1e12,), (0.25,)], "x double")
    assert df.agg(exact_sum("x")).first()[0] == 0.25
    large = spark.createDataFrame([(1e13,), (1e13,), (1e300,), (0.25,), (None,)], "x double")
    assert large.agg(exact_sum("x")).first()[0] == 1e300
    assert large.where("x < 1e14").agg(exact_sum("x")).first()[0] == 2e13 + 0.25


def test_wide_sums_are_exact(spark):
    import math
    from fractions import Fraction
    from random import Random

    from meterlake.functions.wide import wide_sums

    random = Random(3)
    groups = {
        "mixed": [1e300, 1e13, 4e-7, -1e300],
        "too large": [1.7e308] * 3,
        "smallest": [5e-324] * 7 + [2.2e-308],
        "nothing": [None, float("nan"), float("inf")],
        "zeros": [0.0, -0.0],
        "any": [random.uniform(-1, 1) * 2.0 ** random.randint(-1000, 1000) for _ in range(300)],
        "powers": [-(2.0**k) for k in range(-1074, 1000, 7)] + [0.1] * 100,
        None: [0.1, 0.2, -0.3],
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: r for r in wide_sums(df, ["k"], "v").collect()}
    assert got.keys() == groups.keys()
    for k, values in groups.items():
        finite = [v for v in values if v is not None and math.isfinite(v)]
        total = sum(map(Fraction, finite))
        assert got[k].n == len(finite)
        if not finite:
            assert got[k].total is got[k].average is None
        else:
            assert got[k].total == (math.inf if k == "too large" else float(total)) and got[k].average == float(total / len(finite))
    whole = wide_sums(df.where("k = 'mixed'"), [], "v").collect()
    assert [(r.total, r.n) for r in whole] == [(1e13 + 4e-7, 4)] and wide_sums(df.limit(0), ["k"], "v").count() == 0
