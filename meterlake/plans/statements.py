"""The ad-hoc statements. Each takes the processed table; ties are broken by the keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.measures import (
    components,
    flag_rows,
    meters,
    rounded_mean,
    total,
)
from meterlake.plans import views
from meterlake.plans.views import AREA

# Rows of the consumer ranking.
TOP_CONSUMERS = 100

DEVICE_COLUMNS = ("meter_id", *AREA, "battery_pct", "battery_status", "timestamp")


def meters_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct("meter_id").alias("meters"))


def consumption_by(df: DataFrame, *keys: str, name: str = "consumption_kwh") -> DataFrame:
    return components(df).groupBy(*keys).agg(total("consumption_kwh").alias(name))


def meters_by_status(df: DataFrame) -> DataFrame:
    return meters_by(df, "health_status").orderBy(F.desc("meters"), "health_status")


def communication_totals(df: DataFrame) -> DataFrame:
    return components(df).agg(
        flag_rows("offline").alias("offline_meters"),
        flag_rows("comm_issue").alias("communication_issues"),
        rounded_mean("rssi").alias("average_rssi"),
    )


def signal_by_state(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy("state")
        .agg(F.min("rssi__min").alias("worst_rssi"), rounded_mean("rssi").alias("average_rssi"))
        .orderBy("worst_rssi", "state")
    )


def electrical_totals(df: DataFrame) -> DataFrame:
    return components(df).agg(
        flag_rows("voltage_issue").alias("voltage_violations"),
        flag_rows("power_factor_issue").alias("low_power_factor"),
        rounded_mean("voltage").alias("average_voltage"),
        rounded_mean("current").alias("average_current"),
    )


def electrical_hotspots(df: DataFrame) -> DataFrame:
    return (
        views.electrical_health(df)
        .select(*AREA, "voltage_violations", "low_power_factor", "average_voltage", "average_current")
        .orderBy(F.desc("voltage_violations"), *AREA)
    )


def battery_by_status(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy("battery_status")
        .agg(meters().alias("meters"), rounded_mean("battery_pct").alias("average_battery_pct"))
        .orderBy(F.desc("meters"), "battery_status")
    )


def low_battery_devices(df: DataFrame) -> DataFrame:
    return (
        df.filter("battery_issue")
        .select(*DEVICE_COLUMNS)
        .orderBy("battery_pct", F.desc("timestamp"), "meter_id")
    )


def daily_totals(df: DataFrame) -> DataFrame:
    return consumption_by(df, "event_date", name="daily_consumption_kwh").orderBy("event_date")


def monthly_totals(df: DataFrame) -> DataFrame:
    return consumption_by(df, "year", "month", name="monthly_consumption_kwh").orderBy("year", "month")


def biggest_consumers(df: DataFrame, k: int = TOP_CONSUMERS) -> DataFrame:
    return (
        views.top_consumers(df)
        .select("meter_id", *AREA, "feeder_id", "total_consumption_kwh")
        .orderBy(F.desc("total_consumption_kwh"), "meter_id", *AREA, "feeder_id")
        .limit(k)
    )


def consumption_by_discom(df: DataFrame) -> DataFrame:
    return consumption_by(df, "discom").orderBy(F.desc("consumption_kwh"), "discom")


def status_by_state(df: DataFrame) -> DataFrame:
    return meters_by(df, "state", "health_status").orderBy("state", "health_status")


def status_by_district(df: DataFrame) -> DataFrame:
    return meters_by(df, "district", "health_status").orderBy("district", F.desc("meters"), "health_status")


def status_by_discom(df: DataFrame) -> DataFrame:
    return meters_by(df, "discom", "health_status").orderBy("discom", F.desc("meters"), "health_status")


def meters_by_firmware(df: DataFrame) -> DataFrame:
    return meters_by(df, "firmware_version").orderBy(F.desc("meters"), "firmware_version")


def firmware_health(df: DataFrame) -> DataFrame:
    return views.firmware_distribution(df).orderBy("firmware_version", "health_status")
