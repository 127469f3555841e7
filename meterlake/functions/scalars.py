"""Column expressions over one reading."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.schema import CRITICAL, FLAGS, HEALTHY, OFFLINE_MINUTES, WARNING

MICRO = 1_000_000


def parse_sql(column: str, dtype: str) -> str:
    """The cell as ``dtype``, or null if it does not parse. ``5.7`` as an int is 5."""
    source = f"try_cast(`{column}` AS double)" if dtype == "int" else f"`{column}`"
    return f"try_cast({source} AS {dtype})"


def parse(column: str, dtype: str) -> Column:
    return F.expr(parse_sql(column, dtype))


def lag_minutes(at="timestamp", last="last_communication_time", mode: str = "elapsed") -> Column:
    """Minutes since the last communication.

    ``elapsed`` counts whole seconds and divides by 60; ``boundary`` counts the
    minute boundaries in between.
    """
    at, last = F.unix_timestamp(at), F.unix_timestamp(last)
    if mode == "elapsed":
        return (at - last) / 60.0
    if mode == "boundary":
        return (F.floor(at / 60) - F.floor(last / 60)).cast("double")
    raise ValueError(f"unknown lag mode: {mode}")


def issue_count(flags=FLAGS) -> Column:
    return reduce(add, (F.col(flag).cast("int") for flag in flags))


def health_status(count="issue_count") -> Column:
    """Three or more issues are critical, one or two a warning; an unknown count is healthy."""
    count = F.col(count)
    return F.when(count >= 3, CRITICAL).when(count >= 1, WARNING).otherwise(HEALTHY)


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def unhealthy_flag(status="health_status") -> Column:
    return F.when(F.col(status) == HEALTHY, 0).otherwise(1)


def offline(lag="communication_lag_minutes", limit: float = OFFLINE_MINUTES) -> Column:
    """True above the limit; a meter that never communicated has no lag and is not offline."""
    return F.coalesce(F.col(lag) > limit, F.lit(False))


def offline_flag(lag="communication_lag_minutes", limit: float = OFFLINE_MINUTES) -> Column:
    return F.when(F.col(lag) > limit, 1).otherwise(0)


def low_battery_flag(status="battery_status") -> Column:
    return F.when(F.col(status) == "Low", 1).otherwise(0)


def signal_quality(rssi="rssi") -> Column:
    rssi = F.col(rssi)
    return F.when(rssi < -90, "Poor").when(rssi < -80, "Weak").otherwise("Good")


def micros(value: Column) -> Column:
    """The value in whole millionths as a bigint, so sums do not depend on row order."""
    return F.floor(value * float(MICRO) + 0.5)


def bin_floor(value, width: float) -> Column:
    """Lower edge of the histogram bin, cut on whole millionths to avoid edge drift."""
    step = round(width * MICRO)
    return F.floor(micros(F.col(value)) / step) * step / MICRO


def alert_severity(
    lag="communication_lag_minutes",
    battery="battery_pct",
    count="issue_count",
    lag_limit: float = OFFLINE_MINUTES,
    battery_limit: int = 20,
) -> Column:
    """Alert label from issue count, communication lag and battery charge."""
    late = F.coalesce(F.col(lag) > lag_limit, F.lit(False))
    flat = F.coalesce(F.col(battery) < battery_limit, F.lit(False))
    count = F.coalesce(F.col(count), F.lit(0))
    return (
        F.when((count >= 3) | (late & flat), "Severe")
        .when((count == 2) | late, "Major")
        .when((count == 1) | flat, "Minor")
        .otherwise("None")
    )
