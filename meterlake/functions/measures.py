"""Additive measures that give the same result on readings and on a rollup of readings.

``components`` turns a reading into counters and fixed-point parts that can be
summed in any order and any number of steps. Every view aggregates components,
so it can read the table itself or the much smaller meter-day rollup.

Double sums depend on the order in which Spark merges partitions, and a mean
such as 223.625 then rounds either way. The parts below are bigints: a value in
millionths, cut at 2**20 into a high and a low half. Each half stays inside a
bigint for about 8e12 rows per group; past that, ANSI mode raises. Digits beyond the sixth decimal are
rounded. Values beyond 9.2e12 don't fit and are summed as plain doubles beside the others; `wide.wide_sums`
is exact for them too, and for any decimals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.scalars import MICRO
from meterlake.schema import DOUBLES, FLAGS, OFFLINE_MINUTES

_LOW_BITS = 20
_LOW = 1 << _LOW_BITS

ROWS = "rows__n"
DIMENSIONS = (
    "meter_id",
    "state",
    "district",
    "discom",
    "feeder_id",
    "firmware_version",
    "battery_status",
    "health_status",
    "event_date",
    "year",
    "month",
)


#: Larger magnitudes in millionths don't fit a bigint; floor would silently give the nearest one that does.
LARGEST = 9.2e12


def _micros_sql(column: str) -> str:
    return f"floor(if(abs({column}) > {LARGEST:g}D, 0D, {column}) * {MICRO}D + 0.5D)"


def _wide_sql(column: str) -> str:
    """A value that is not among the millionths, else 0."""
    return f"if(abs({column}) > {LARGEST:g}D, {column}, 0D)"


def _halves_sql(column: str) -> tuple[str, str]:
    whole = _micros_sql(column)
    return f"shiftright({whole}, {_LOW_BITS})", f"{whole} & {_LOW - 1}L"


def _joined(high: Column, low: Column, wide: Column) -> Column:
    whole = "decimal(20,0)"
    total = high.cast(whole) * F.lit(_LOW).cast("decimal(7,0)") + low.cast(whole)
    return total.cast("double") / float(MICRO) + wide


def _component_sql() -> tuple[str, ...]:
    """The parts of one reading as SQL text: one call instead of a hundred column objects."""
    parts = {ROWS: "1L", "offline__n": f"if(communication_lag_minutes > {OFFLINE_MINUTES}, 1L, 0L)"}
    for flag in FLAGS:
        parts[f"{flag}__n"] = f"if({flag}, 1L, 0L)"
    for name in DOUBLES:
        parts[f"{name}__high"], parts[f"{name}__low"] = _halves_sql(name)
        parts[f"{name}__wide"] = _wide_sql(name)
        parts[f"{name}__n"] = f"if({name} IS NULL, 0L, 1L)"
    parts["battery_pct__sum"] = "CAST(battery_pct AS bigint)"
    parts["battery_pct__n"] = "if(battery_pct IS NULL, 0L, 1L)"
    parts["issue_count__sum"] = "CAST(issue_count AS bigint)"
    parts["rssi__min"] = "rssi"
    parts["timestamp__max"] = "timestamp"
    return tuple(f"{part} AS {name}" for name, part in parts.items())


def components(df: DataFrame) -> DataFrame:
    """Readings with their additive parts; a rollup is returned as it is."""
    if ROWS in df.columns:
        return df
    return df.selectExpr(*DIMENSIONS, *_component_sql())


def meter_day_rollup(df: DataFrame) -> DataFrame:
    """One row per meter, day and label combination: one pass over the readings serves every view."""
    parts = components(df)
    measures = [name for name in parts.columns if name not in DIMENSIONS]

    def merged(name: str) -> Column:
        how = {"rssi__min": F.min, "timestamp__max": F.max}.get(name, F.sum)
        return how(name).alias(name)

    return parts.groupBy(*DIMENSIONS).agg(*(merged(name) for name in measures))


# Aggregates over components.

def row_count() -> Column:
    return F.coalesce(F.sum(ROWS), F.lit(0).cast("bigint"))


def rows_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(ROWS)).otherwise(0)), F.lit(0)).cast("bigint")


def status_rows(status: str) -> Column:
    return rows_where(F.col("health_status") == status)


def flag_rows(flag: str) -> Column:
    """Rows with the flag set; 0, not null, on empty input."""
    return F.coalesce(F.sum(f"{flag}__n"), F.lit(0).cast("bigint"))


def total(measure: str) -> Column:
    if measure in DOUBLES:
        return _joined(F.sum(f"{measure}__high"), F.sum(f"{measure}__low"), F.sum(f"{measure}__wide"))
    return F.sum(f"{measure}__sum")


def mean(measure: str) -> Column:
    return F.try_divide(total(measure).cast("double"), F.sum(f"{measure}__n"))


def rounded_mean(measure: str, digits: int = 2) -> Column:
    return F.round(mean(measure), digits)


#: Column of a sketch rollup that stands for its meters.
SKETCH = "meters__sketch"
#: Registers of a sketch, as a power of two: a relative standard error of 1.04 / 2 ** (LG_REGISTERS / 2), 0.8 % here.
LG_REGISTERS = 14


def sketch_rollup(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per day and label combination, or per ``keys``, with a mergeable sketch in place of the meters.

    It is as small as the label combinations, however many meters there are. Views that count meters can read it
    with ``approx``: they merge sketches of fixed size, so no meter is shuffled.
    """
    parts = components(df)
    keys = [name for name in DIMENSIONS if name != "meter_id"] if keys is None else list(keys)
    measures = [name for name in parts.columns if name not in DIMENSIONS]
    how = {"rssi__min": F.min, "timestamp__max": F.max}
    merged = (how.get(name, F.sum)(name).alias(name) for name in measures)
    return parts.groupBy(*keys).agg(*merged, F.hll_sketch_agg("meter_id", LG_REGISTERS).alias(SKETCH))


def sketched(df: DataFrame) -> DataFrame:
    return df if SKETCH in df.columns else sketch_rollup(df)


def meters(approx: bool = False) -> Column:
    """Distinct meters, exact unless ``approx``: then from the sketches of a sketch rollup, merged."""
    if approx:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)), F.lit(0).cast("bigint"))
    return F.count_distinct("meter_id")


def pct_of_rows(condition: Column) -> Column:
    return F.round(F.try_divide(100.0 * rows_where(condition), row_count()), 2)


# The same arithmetic over any double column, such as a rounded average of a view.

def exact_sum(column: str) -> Column:
    high, low = _halves_sql(column)
    return _joined(F.sum(F.expr(high)), F.sum(F.expr(low)), F.sum(F.expr(_wide_sql(column))))


def exact_avg(column: str) -> Column:
    return F.try_divide(exact_sum(column), F.count(column))
