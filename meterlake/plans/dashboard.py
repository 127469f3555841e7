"""Dashboard visuals beyond the views and statements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.measures import (
    components,
    flag_rows,
    meters,
    rounded_mean,
    status_rows,
)
from meterlake.functions.scalars import signal_quality
from meterlake.operators.charts import histogram
from meterlake.operators.filters import apply_filters
from meterlake.plans.statements import consumption_by, meters_by
from meterlake.plans.views import AREA
from meterlake.schema import CRITICAL, FLAGS, STATUSES, WARNING

# Bin widths of the distribution charts.
BIN_WIDTHS = {"rssi": 5, "voltage": 5, "power_factor": 0.01, "current": 1, "battery_pct": 10}

# Bars of the feeder ranking.
TOP_FEEDERS = 20


def kpi(df: DataFrame, measure: str, digits: int = 2) -> DataFrame:
    return components(df).agg(rounded_mean(measure, digits).alias(f"average_{measure}"))


def total_meters(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("meter_id").alias("total_meters"))


def mean_by(df: DataFrame, key: str, measure: str, digits: int = 2) -> DataFrame:
    return (
        components(df)
        .groupBy(key)
        .agg(rounded_mean(measure, digits).alias(f"average_{measure}"))
        .orderBy(key)
    )


def meters_with_status(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct meters per status, side by side.

    A meter is folded to one row per key first, so three distinct counts cost
    one pass and no row is copied per count.
    """
    seen = df.groupBy(*keys, "meter_id").agg(
        *(F.bool_or(F.col("health_status") == status).alias(status) for status in STATUSES)
    )
    counts = (F.count_if(status).alias(f"{status.lower()}_meters") for status in STATUSES)
    return seen.groupBy(*keys).agg(*counts)


def status_meters(df: DataFrame, status: str) -> DataFrame:
    name = f"{status.lower()}_meters"
    return df.filter(F.col("health_status") == status).agg(F.count_distinct("meter_id").alias(name))


def health_trend(df: DataFrame) -> DataFrame:
    return meters_by(df, "event_date", "health_status").orderBy("event_date", "health_status")


def fleet_table(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy(*AREA)
        .agg(
            meters().alias("meters"),
            rounded_mean("voltage").alias("average_voltage"),
            rounded_mean("rssi").alias("average_rssi"),
            rounded_mean("battery_pct").alias("average_battery_pct"),
            status_rows(WARNING).alias("warning"),
            status_rows(CRITICAL).alias("critical"),
        )
        .orderBy(*AREA)
    )


def status_heatmap(df: DataFrame, key: str = "district") -> DataFrame:
    """Key by status, cells filled with distinct meters.

    The distinct count runs on the long form; only its small result is pivoted.
    """
    long = meters_by(df, key, "health_status")
    wide = long.groupBy(key).pivot("health_status", list(STATUSES)).agg(F.first("meters"))
    cells = (F.coalesce(status, F.lit(0)).alias(status.lower()) for status in STATUSES)
    return wide.select(key, *cells).orderBy(key)


def distribution(df: DataFrame, column: str) -> DataFrame:
    return histogram(df, column, BIN_WIDTHS[column])


def flag_by(df: DataFrame, key: str, flag: str, name: str) -> DataFrame:
    return components(df).groupBy(key).agg(flag_rows(flag).alias(name)).orderBy(F.desc(name), key)


def signal_quality_histogram(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(signal_quality().alias("signal_quality"))
        .agg(F.count("*").alias("readings"))
        .orderBy("signal_quality")
    )


def worst_signal_devices(df: DataFrame, k: int | None = None) -> DataFrame:
    """Readings from the weakest signal on; all of them unless ``k`` is given."""
    shown = ("meter_id", *AREA, "rssi", "last_communication_time", "health_status")
    ranked = df.orderBy("rssi", "meter_id", "timestamp").select(*shown)
    return ranked if k is None else ranked.limit(k)


def electrical_devices(df: DataFrame) -> DataFrame:
    return df.select("meter_id", "voltage", "current", "power_factor", *FLAGS)


def device_details(df: DataFrame, **filters) -> DataFrame:
    """Filtered readings as a device table."""
    return apply_filters(df, **filters).select(
        "meter_id",
        "timestamp",
        *AREA,
        "feeder_id",
        "firmware_version",
        "health_status",
        "issue_count",
        "voltage",
        "rssi",
        "battery_pct",
        "consumption_kwh",
    )


def ranked_consumption(df: DataFrame, key: str, k: int | None = None) -> DataFrame:
    ranked = consumption_by(df, key).orderBy(F.desc("consumption_kwh"), key)
    return ranked if k is None else ranked.limit(k)


def firmware_issue_table(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy("firmware_version")
        .agg(
            flag_rows("comm_issue").alias("communication_issues"),
            flag_rows("signal_issue").alias("signal_issues"),
            flag_rows("voltage_issue").alias("voltage_issues"),
            status_rows(CRITICAL).alias("critical"),
        )
        .orderBy("firmware_version")
    )
