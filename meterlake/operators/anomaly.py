"""Rolling and group outliers, alert labels and voltage bands."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.scalars import MICRO, alert_severity, micros
from meterlake.schema import UNKNOWN_METER

_WIDE = "decimal(38,0)"


def _square(value: Column) -> Column:
    value = value.cast("decimal(19,0)")
    return (value * value).cast(_WIDE)


def _mean(n: Column, total: Column) -> Column:
    return F.try_divide(total.cast("double") / float(MICRO), n)


def _deviation(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from exact sums in millionths; null below two values."""
    spread = (n.cast(_WIDE) * squares - _square(total)).cast("double")
    return F.when(n > 1, F.sqrt(F.try_divide(spread, (n * (n - 1)).cast("double"))) / float(MICRO))


def _scored(df: DataFrame, value: str, n: str, total: str, squares: str, threshold: float) -> DataFrame:
    n, total, squares = F.col(n), F.col(total), F.col(squares)
    mean, deviation = _mean(n, total), _deviation(n, total, squares)
    z = F.when(deviation > 0, (F.col(value) - mean) / deviation)
    return df.withColumns(
        {
            "mean_value": F.round(mean, 4),
            "deviation": F.round(deviation, 4),
            "z_score": F.round(z, 4),
            "is_outlier": F.coalesce(F.abs(z) > threshold, F.lit(False)),
        }
    )


def rolling_outliers(
    df: DataFrame,
    measure: str = "consumption_kwh",
    window: int = 24,
    threshold: float = 3.0,
    chunk: str = "month",
) -> DataFrame:
    """Each reading against the ``window`` readings of its meter before it.

    A reading with fewer predecessors, or with no spread among them, has no
    score and is not flagged. Nor has a reading without a meter name, since the
    readings under that label come from different meters.

    A meter's history is cut into time chunks, so no task holds all of it. In a
    chunk, all but the first ``window`` rows see their whole frame. The others
    need rows from earlier chunks, of which only the last ``window`` rows of
    each can matter. So the second pass, per meter, handles at most
    ``2 * window`` rows per chunk, whatever the number of readings. A chunk should
    hold many windows: with a month, hourly readings are nearly all seen in the first pass.
    """
    everything = df.select("meter_id", "timestamp", F.col(measure).alias("value"))
    readings = everything.filter(F.col("meter_id") != UNKNOWN_METER).withColumns(
        {"_chunk": F.date_trunc(chunk, "timestamp"), "_micros": micros(F.col("value"))}
    )
    # Both passes read this projection, so Spark shuffles it once and reuses the exchange.
    readings = readings.withColumn("_square", _square(F.col("_micros")))

    def preceding(ordered) -> dict[str, Column]:
        frame = ordered.rowsBetween(-window, -1)
        return {
            "_rows": F.count("*").over(frame),
            "_n": F.count("_micros").over(frame),
            "_total": F.sum("_micros").over(frame),
            "_squares": F.sum("_square").over(frame),
        }

    within = Window.partitionBy("meter_id", "_chunk")
    ordered = within.orderBy("timestamp")
    chunked = readings.withColumns(
        {
            **preceding(ordered),
            "_position": F.row_number().over(ordered),
            "_size": F.count("*").over(within),
        }
    )
    head = F.col("_position") <= window
    tail = F.col("_position") > F.col("_size") - window
    complete = chunked.filter(~head)
    edges = chunked.filter(head | tail).withColumns(preceding(Window.partitionBy("meter_id").orderBy("timestamp")))
    framed = complete.unionByName(edges.filter(head))
    enough = framed.withColumn("_n", F.when(F.col("_rows") == window, F.col("_n")))
    scored = _scored(enough, "value", "_n", "_total", "_squares", threshold)
    mean = F.when(F.col("_n").isNotNull(), F.col("mean_value"))
    named = scored.select(
        "meter_id", "timestamp", "value", mean.alias("mean_value"), "deviation", "z_score", "is_outlier"
    )
    unnamed = everything.filter(F.col("meter_id") == UNKNOWN_METER).withColumn("is_outlier", F.lit(False))
    return named.unionByName(unnamed, allowMissingColumns=True)


def group_outliers(
    rows: DataFrame,
    group: str | Sequence[str],
    measure: str,
    threshold: float = 3.0,
) -> DataFrame:
    """Each row of a rollup against the other rows of its group.

    Group statistics are one small row per group, joined back. A window over
    the group would put a large group into one task.
    """
    keys = [group] if isinstance(group, str) else list(group)
    value = micros(F.col(measure))
    stats = rows.groupBy(*keys).agg(
        F.count(measure).alias("_n"),
        F.sum(value).alias("_total"),
        F.sum(_square(value)).alias("_squares"),
    )
    # Rows whose group is null are a group too.
    named = stats.select(*(F.col(key).alias(f"_key{i}") for i, key in enumerate(keys)), "_n", "_total", "_squares")
    same = reduce(Column.__and__, (rows[key].eqNullSafe(named[f"_key{i}"]) for i, key in enumerate(keys)))
    scored = _scored(rows.join(named, same, "left"), measure, "_n", "_total", "_squares", threshold)
    return scored.drop("_n", "_total", "_squares", *(f"_key{i}" for i in range(len(keys))))


def with_severity(df: DataFrame, **limits) -> DataFrame:
    return df.withColumn("severity", alert_severity(**limits))


def voltage_bands(
    df: DataFrame, *keys: str, low: float = 200.0, high: float = 250.0
) -> DataFrame:
    """Readings below and above the voltage limits per area."""
    voltage = F.col("voltage")
    return df.groupBy(*keys).agg(
        F.count("*").alias("readings"),
        F.count_if(voltage < low).alias("under_voltage"),
        F.count_if(voltage > high).alias("over_voltage"),
    )
