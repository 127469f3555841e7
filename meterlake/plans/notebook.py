"""Exploration queries that aggregate a view a second time.

The averages of averages are unweighted, and a meter seen with two statuses
counts twice; both are what these reports have always shown. The ``exact_*``
variants below give the weighted mean and the true distinct count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.measures import (
    components,
    exact_avg,
    exact_sum,
    flag_rows,
    meters,
    rounded_mean,
    row_count,
)
from meterlake.plans import views
from meterlake.schema import WARNING


def _rounded_avg(column: str):
    return F.round(exact_avg(column), 2).alias(column)


def health_split(df: DataFrame) -> DataFrame:
    return views.health_by_status(df).orderBy(F.desc("readings"), "health_status")


def weakest_states(df: DataFrame) -> DataFrame:
    return (
        views.communication_health(df)
        .groupBy("state")
        .agg(F.min("worst_rssi").alias("worst_rssi"), _rounded_avg("average_rssi"))
        .orderBy("worst_rssi", "state")
    )


def electrical_by_state(df: DataFrame) -> DataFrame:
    return (
        views.electrical_health(df)
        .groupBy("state")
        .agg(
            F.sum("voltage_violations").alias("voltage_violations"),
            F.sum("low_power_factor").alias("low_power_factor"),
            _rounded_avg("average_voltage"),
        )
        .orderBy(F.desc("voltage_violations"), "state")
    )


def battery_by_status(df: DataFrame) -> DataFrame:
    return (
        views.battery_health(df)
        .groupBy("battery_status")
        .agg(F.sum("devices").alias("devices"), _rounded_avg("average_battery_pct"))
        .orderBy(F.desc("devices"), "battery_status")
    )


def consumption_trend(df: DataFrame) -> DataFrame:
    return (
        views.daily_consumption(df)
        .groupBy("event_date")
        .agg(exact_sum("total_consumption_kwh").alias("total_consumption_kwh"))
        .orderBy("event_date")
    )


def firmware_issues(df: DataFrame) -> DataFrame:
    counts = ("meters", "communication_issues", "signal_issues", "voltage_issues")
    return (
        views.firmware_distribution(df)
        .groupBy("firmware_version")
        .agg(*(F.sum(name).alias(name) for name in counts))
        .orderBy(F.desc("meters"), "firmware_version")
    )


def leading_consumers(df: DataFrame, k: int = 10) -> DataFrame:
    keys = ("meter_id", *views.AREA, "feeder_id")
    return views.top_consumers(df).orderBy(F.desc("total_consumption_kwh"), *keys).limit(k)


def warning_districts(df: DataFrame, k: int = 5) -> DataFrame:
    return (
        df.filter(F.col("health_status") == WARNING)
        .groupBy("district")
        .agg(F.count("*").alias("warning_readings"))
        .orderBy(F.desc("warning_readings"), "district")
        .limit(k)
    )


def exact_weakest_states(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy("state")
        .agg(F.min("rssi__min").alias("worst_rssi"), rounded_mean("rssi").alias("average_rssi"))
        .orderBy("worst_rssi", "state")
    )


def exact_electrical_by_state(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy("state")
        .agg(
            flag_rows("voltage_issue").alias("voltage_violations"),
            flag_rows("power_factor_issue").alias("low_power_factor"),
            rounded_mean("voltage").alias("average_voltage"),
        )
        .orderBy(F.desc("voltage_violations"), "state")
    )


def exact_battery_by_status(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy("battery_status")
        .agg(row_count().alias("devices"), rounded_mean("battery_pct").alias("average_battery_pct"))
        .orderBy(F.desc("devices"), "battery_status")
    )


def exact_firmware_issues(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy("firmware_version")
        .agg(
            meters().alias("meters"),
            flag_rows("comm_issue").alias("communication_issues"),
            flag_rows("signal_issue").alias("signal_issues"),
            flag_rows("voltage_issue").alias("voltage_issues"),
        )
        .orderBy(F.desc("meters"), "firmware_version")
    )
