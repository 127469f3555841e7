"""Profiles, checks, drift and reconciliation. Every check is a DataFrame of findings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.measures import exact_avg
from meterlake.functions.scalars import health_status, issue_count, parse
from meterlake.operators.clean import add_missing, conform
from meterlake.operators.filters import on_days
from meterlake.schema import (
    FLAGS,
    IDENTITY,
    PARTITION_KEYS,
    RAW_COLUMNS,
    RAW_TYPES,
    REQUIRED_FIELDS,
    UNKNOWN_METER,
)
from meterlake.session import fresh_path

# Columns the published profile describes.
PROFILED_NUMBERS = ("voltage", "current", "power_factor", "rssi", "battery_pct")
PROFILED_LABELS = ("health_status", "battery_status", "state", "discom", "firmware_version")

# Plausible ranges; the limits are ours and meant to be passed in.
DEFAULT_RANGES = {"voltage": (200.0, 250.0), "rssi": (-110.0, -40.0)}


def _rows(pairs: Iterable[Mapping[str, Column]]) -> Column:
    """One output row per mapping, so that a single pass feeds a report with many lines."""
    return F.inline(F.array(*(F.struct(*(c.alias(n) for n, c in row.items())) for row in pairs)))


def _row_fact() -> Column:
    return F.count("*").alias("_rows")


def _shape_report(facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    return facts.select(
        F.col("_rows").alias("row_count"),
        F.lit(len(columns)).alias("column_count"),
        F.lit(",".join(columns)).alias("column_names"),
    )


def shape(df: DataFrame) -> DataFrame:
    return _shape_report(df.agg(_row_fact()), df.columns)


def missing_required(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> list[str]:
    return [name for name in required if name not in df.columns]


def _present(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [name for name in required if name in df.columns]


def _null_facts(present: Sequence[str]) -> list[Column]:
    return [F.count(name).alias(f"{name}__filled") for name in present]


def _null_report(facts: DataFrame, present: Sequence[str], required: Sequence[str]) -> DataFrame:
    def nulls(name: str) -> Column:
        if name not in present:
            return F.lit(None).cast("bigint")
        return F.col("_rows") - F.col(f"{name}__filled")

    return facts.select(
        _rows(
            {"field": F.lit(name), "present": F.lit(name in present), "null_count": nulls(name)}
            for name in required
        )
    )


def null_counts(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Presence and null count per required field; an absent field has no count."""
    present = _present(df, required)
    return _null_report(df.agg(_row_fact(), *_null_facts(present)), present, required)


def _range_facts(columns: Sequence[str]) -> list[Column]:
    facts = []
    for name in columns:
        facts += [
            F.min(name).cast("double").alias(f"{name}__min"),
            F.max(name).cast("double").alias(f"{name}__max"),
            F.round(exact_avg(name), 3).alias(f"{name}__mean"),
        ]
    return facts


def _range_report(facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    return facts.select(
        _rows(
            {
                "column_name": F.lit(name),
                "min_value": F.col(f"{name}__min"),
                "max_value": F.col(f"{name}__max"),
                "mean_value": F.col(f"{name}__mean"),
            }
            for name in columns
        )
    )


def numeric_ranges(df: DataFrame, columns: Sequence[str] = PROFILED_NUMBERS) -> DataFrame:
    return _range_report(df.agg(*_range_facts(columns)), columns)


def _rate_facts(flags: Sequence[str]) -> list[Column]:
    facts = []
    for flag in flags:
        facts += [F.count_if(flag).alias(f"{flag}__set"), F.count(flag).alias(f"{flag}__known")]
    return facts


def _rate_report(facts: DataFrame, flags: Sequence[str]) -> DataFrame:
    def rate(flag: str) -> Column:
        return F.round(F.try_divide(100.0 * F.col(f"{flag}__set"), F.col(f"{flag}__known")), 2)

    return facts.select(_rows({"flag": F.lit(flag), "issue_rate_pct": rate(flag)} for flag in flags))


def issue_rates(df: DataFrame, flags: Sequence[str] = FLAGS) -> DataFrame:
    """Share of set flags among known ones, in percent."""
    return _rate_report(df.agg(*_rate_facts(flags)), flags)


def _key_facts(df: DataFrame, present: Sequence[str] = ()) -> DataFrame:
    """Row, meter, copy and null counts and the time range, in one pass.

    Two distinct counts in one aggregate would copy every row. Folding by
    (meter, time), then by meter, needs no copies, and a meter or key that holds
    a large part of the rows shrinks before each shuffle.
    """
    zero = F.lit(0).cast("bigint")
    empty_cells = sum((F.col(name).isNull().cast("bigint") for name in present), zero)
    by_key = df.groupBy(*IDENTITY).agg(F.count("*").alias("copies"), F.sum(empty_cells).alias("empty"))
    by_meter = by_key.groupBy("meter_id").agg(
        F.sum("copies").alias("copies"),
        F.sum("empty").alias("empty"),
        F.count("*").alias("keys"),
        F.min("timestamp").alias("first_at"),
        F.max("timestamp").alias("last_at"),
    )
    return by_meter.agg(
        F.coalesce(F.sum("copies"), zero).alias("row_count"),
        F.count("meter_id").alias("unique_meters"),
        F.coalesce(F.sum("copies") - F.sum("keys"), zero).alias("duplicate_rows"),
        F.min("first_at").alias("first_reading_at"),
        F.max("last_at").alias("last_reading_at"),
        F.coalesce(F.sum("empty"), zero).alias("null_cells"),
    )


def _identity_report(keys: DataFrame) -> DataFrame:
    return keys.drop("null_cells")


def identity_profile(df: DataFrame) -> DataFrame:
    """Rows, distinct meters, surplus copies and time range."""
    return _identity_report(_key_facts(df))


def _verdict_report(keys: DataFrame, complete: bool) -> DataFrame:
    fit = F.lit(complete) & (F.col("null_cells") == 0) & (F.col("duplicate_rows") == 0)
    return keys.select("row_count", "null_cells", "duplicate_rows", fit.alias("fit_for_use"))


def verdict(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Fit for use: nothing required is absent or null, and no key occurs twice.

    Without the key columns the copies cannot be counted and the answer is no.
    """
    present = _present(df, required)
    if missing_required(df, IDENTITY):
        unknown = F.lit(None).cast("bigint")
        return df.agg(F.count("*").alias("row_count")).select(
            "row_count",
            unknown.alias("null_cells"),
            unknown.alias("duplicate_rows"),
            F.lit(False).alias("fit_for_use"),
        )
    return _verdict_report(_key_facts(df, present), len(present) == len(required))


def category_counts(df: DataFrame, columns: Sequence[str] = PROFILED_LABELS) -> DataFrame:
    """Rows per label of each column.

    The labels are counted together first. That result is small, so unpivoting
    it does not multiply the readings.
    """
    together = df.groupBy(*columns).agg(F.count("*").alias("rows"))
    lines = together.select(
        "rows",
        _rows({"column_name": F.lit(name), "label": F.col(name)} for name in columns),
    )
    return lines.groupBy("column_name", "label").agg(F.sum("rows").alias("row_count"))


def profile(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS) -> dict[str, DataFrame]:
    """The whole report on typed raw readings, before filling.

    The delivery is read three times in all: for the plain aggregates, for the
    keys and for the labels. Their small results are written to the shared
    folder, so looking at a report does not read the delivery again.
    """
    spark = df.sparkSession
    present = _present(df, required)

    def kept(small: DataFrame) -> DataFrame:
        path = fresh_path(spark, "profile")
        small.write.parquet(path)
        return spark.read.schema(small.schema).parquet(path)

    facts = kept(
        df.agg(_row_fact(), *_null_facts(present), *_range_facts(PROFILED_NUMBERS), *_rate_facts(FLAGS))
    )
    keys = kept(_key_facts(df, present))
    return {
        "shape": _shape_report(facts, df.columns),
        "null_counts": _null_report(facts, present, required),
        "identity": _identity_report(keys),
        "numeric_ranges": _range_report(facts, PROFILED_NUMBERS),
        "category_counts": kept(category_counts(df)),
        "issue_rates": _rate_report(facts, FLAGS),
        "verdict": _verdict_report(keys, len(present) == len(required)),
    }


def load_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("meter_id").alias("meters"),
        F.min("event_date").alias("min_date"),
        F.max("event_date").alias("max_date"),
    )


def assert_counts(df: DataFrame, rows: int, meters: int) -> None:
    found = df.agg(F.count("*"), F.count_distinct("meter_id")).first()
    if tuple(found) != (rows, meters):
        raise AssertionError(f"expected {rows} rows and {meters} meters, found {found[0]} and {found[1]}")


def assert_views(spark: SparkSession, names: Sequence[str]) -> None:
    missing = [name for name in names if not spark.catalog.tableExists(name)]
    if missing:
        raise AssertionError(f"missing views: {', '.join(missing)}")


def range_violations(df: DataFrame, ranges: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """One row per reading and measure outside its range."""
    ranges = ranges or DEFAULT_RANGES
    outside = {name: ~F.col(name).between(*limits) for name, limits in ranges.items()}
    found = F.array(
        *(
            F.when(
                broken,
                F.struct(
                    F.lit(name).alias("measure"),
                    F.col(name).alias("value"),
                    F.lit(float(ranges[name][0])).alias("lower_limit"),
                    F.lit(float(ranges[name][1])).alias("upper_limit"),
                ),
            )
            for name, broken in outside.items()
        )
    )
    return (
        df.filter(reduce(or_, outside.values()))
        .select(*IDENTITY, F.explode(F.array_compact(found)).alias("finding"))
        .select(*IDENTITY, "finding.*")
    )


def duplicate_readings(raw: DataFrame) -> DataFrame:
    """Keys that occur more than once in typed raw readings."""
    return (
        raw.filter(F.col("timestamp").isNotNull())
        .groupBy(*IDENTITY)
        .agg(F.count("*").alias("copies"))
        .filter("copies > 1")
    )


def missing_timestamps(raw: DataFrame) -> DataFrame:
    """Readings without a time, per meter; they are dropped by the load."""
    return (
        raw.filter(F.col("timestamp").isNull())
        .groupBy("meter_id")
        .agg(F.count("*").alias("readings"))
    )


def load_losses(raw: DataFrame) -> DataFrame:
    """What cleaning does to a delivery: unnamed meters, missing times, surplus copies."""
    named = raw.select(F.coalesce("meter_id", F.lit(UNKNOWN_METER)).alias("meter_id"), "timestamp")
    by_key = named.groupBy(*IDENTITY).agg(F.count("*").alias("copies"))
    timed, copies = F.col("timestamp").isNotNull(), F.col("copies")

    def rows(condition: Column, value: Column = copies) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))

    return by_key.agg(
        rows(F.lit(True)).alias("raw_rows"),
        rows(F.col("meter_id") == UNKNOWN_METER).alias("unknown_meter_rows"),
        rows(~timed).alias("untimed_rows"),
        rows(timed, copies - 1).alias("surplus_copies"),
        F.count_if(timed).alias("kept_rows"),
    )


def unparseable_counts(raw: DataFrame) -> DataFrame:
    """Cells per column that are there but do not give a value of the column's type."""
    present = [name for name in RAW_COLUMNS if name in raw.columns]

    def bad(name: str) -> Column:
        value = parse(name, RAW_TYPES[name])
        lost = value.isNull()
        if RAW_TYPES[name] == "double":
            lost = lost | ~(F.abs(value) < float("inf"))
        return F.count_if(F.col(name).isNotNull() & lost)

    return raw.agg(*(bad(name).alias(name) for name in present)).select(
        _rows({"column_name": F.lit(name), "unparseable_cells": F.col(name)} for name in present)
    )


def drift_report(raw: DataFrame) -> DataFrame:
    """Delivered columns against the expected ones, with how many cells each carries.

    Order is reported but harmless: columns are matched by name.
    """
    delivered = list(raw.columns)
    lines = []
    for at, name in enumerate(RAW_COLUMNS):
        if name not in delivered:
            lines.append((name, "missing"))
        else:
            lines.append((name, "ok" if delivered.index(name) == at else "moved"))
    lines += [(name, "unexpected") for name in delivered if name not in RAW_COLUMNS]
    counted = raw.agg(*(F.count(name).alias(name) for name in delivered))
    return counted.select(
        _rows(
            {
                "column_name": F.lit(name),
                "status": F.lit(status),
                "present_cells": F.col(name) if name in delivered else F.lit(0).cast("bigint"),
            }
            for name, status in lines
        )
    )


def declared_mismatches(raw: DataFrame) -> DataFrame:
    """Readings whose delivered health status is not the one their flags give."""
    declared = raw.transform(add_missing).withColumn("declared", F.col("health_status"))
    known = conform(declared, keep=("declared",))
    return (
        known.withColumn("issue_count", issue_count())
        .withColumn("derived", health_status())
        .filter(F.col("declared").isNotNull() & (F.col("declared") != F.col("derived")))
        .groupBy("declared", "derived")
        .agg(F.count("*").alias("readings"))
    )


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that the two results do not hold equally often, with both counts.

    One shuffle covers both directions, and equal rows collapse before it.
    """
    columns = left.columns
    marked = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return (
        marked.groupBy(*columns)
        .agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))
        .filter("left_rows <> right_rows")
    )


def _digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per partition the number of rows and two digests of them that don't depend on their order."""
    row = F.xxhash64(*(F.col(c).isNull() for c in columns), *columns), F.xxhash64(F.lit(1), *columns)
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(row[0].cast("decimal(38,0)")).alias("total"), F.bit_xor(row[1]).alias("mixed")
    )


def differing_partitions(left: DataFrame, right: DataFrame, keys: Sequence[str] = PARTITION_KEYS) -> DataFrame:
    """Keys of the partitions whose rows are not the same on both sides. Only one row a partition is shuffled."""
    sides = [_digests(df, keys, left.columns).withColumnsRenamed({k: f"{k}{i}" for k in keys}) for i, df in enumerate((left, right))]
    sides = [df.select(*(F.col(f"{k}{i}") for k in keys), F.struct("n", "total", "mixed").alias(f"digest{i}")) for i, df in enumerate(sides)]
    same_keys = reduce(and_, (F.col(f"{k}0").eqNullSafe(F.col(f"{k}1")) for k in keys))
    both = sides[0].join(sides[1], same_keys, "full_outer").where(~F.col("digest0").eqNullSafe(F.col("digest1")))
    return both.select(*(F.when(F.col("digest0").isNull(), F.col(f"{k}1")).otherwise(F.col(f"{k}0")).alias(k) for k in keys))


def partition_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """`row_differences` of two day-partitioned tables at the price of the days that differ.

    Days are compared by digests, which every task makes of its own rows. Only rows of days that differ, read again by
    their partitions, are shuffled. Days are collected: there are as many as the calendar has.
    """
    days = ["-".join(str(row[k]) for k in PARTITION_KEYS) for row in differing_partitions(left, right).collect()]
    return row_differences(on_days(left, days), on_days(right, days))


#: Types a text cell may have, the narrower ones first; every whole number is a number, and every cell is text.
CELL_TYPES = ("boolean", "int", "double", "timestamp", "string")


_BLANK = r"[\x00-\x20\x7F]*"
#: What a cell looks like that may be cast to a type. Asking first is far cheaper than a cast that fails.
_MAYBE = {
    "boolean": f"(?i)^{_BLANK}(?:t|true|y|yes|1|f|false|n|no|0){_BLANK}$",
    "int": f"^{_BLANK}[-+]?[0-9]+{_BLANK}$",
    "double": f"^{_BLANK}[-+]?[0-9.iInN][^:]*$",
    "timestamp": f"^{_BLANK}[-+T]?[0-9]",
}


def _fits(dtype: str) -> Column:
    return F.when(F.col("cell").rlike(_MAYBE[dtype]), F.col("cell").try_cast(dtype).isNotNull()).otherwise(False)


def sniffed_types(raw: DataFrame, share: float = 0.9) -> DataFrame:
    """For each column of text cells its likely type, how many cells it has, and how many conflict with that type.

    One aggregation over the cells of all columns, with the same few counts for each column. The likely type is the narrowest
    one that at least ``share`` of the cells have, so a few bad cells don't make a column text; they are counted instead. Cells stay as they are.
    """
    cells = raw.select(F.posexplode(F.array(*(F.col(f"`{name}`") for name in raw.columns))).alias("at", "cell")).where("cell is not null")
    by_column = cells.groupBy("at").agg(F.count("*").alias("cells"), *(F.count_if(_fits(t)).alias(t) for t in CELL_TYPES[:-1]))
    # At most a row a column comes in, and one row goes out, without any cell too.
    one = by_column.agg(
        *(
            F.struct(*(F.coalesce(F.max(F.when(F.col("at") == at, F.col(c))), F.lit(0).cast("bigint")).alias(c) for c in by_column.columns[1:])).alias(name)
            for at, name in enumerate(raw.columns)
        )
    )
    lines = []
    for name in raw.columns:
        found = F.col(f"`{name}`")
        fitting, conflicts = F.lit("string"), F.lit(0).cast("bigint")
        for dtype in reversed(CELL_TYPES[:-1]):
            likely = (found["cells"] > 0) & (found[dtype] >= share * found["cells"])
            fitting, conflicts = F.when(likely, dtype).otherwise(fitting), F.when(likely, found["cells"] - found[dtype]).otherwise(conflicts)
        lines.append({"column_name": F.lit(name), "likely_type": fitting, "cells": found["cells"], "conflicts": conflicts})
    return one.select(_rows(lines))
