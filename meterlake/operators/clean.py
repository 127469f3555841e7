"""Cleaning: raw readings to the processed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions import scalars
from meterlake.schema import (
    DEFAULTS,
    DOUBLES,
    IDENTITY,
    PROCESSED_COLUMNS,
    RAW_COLUMNS,
    RAW_FIELDS,
    RAW_TYPES,
    UNDEFAULTED,
)


def _names(df: DataFrame) -> dict[str, str]:
    return {name.lower(): name for name in df.columns}


def add_missing(raw: DataFrame) -> DataFrame:
    """Add absent columns as their default. The two time columns have none, so they must be there."""
    present = _names(raw)
    lost = [name for name in UNDEFAULTED if name not in present]
    if lost:
        raise ValueError(f"readings lack required columns: {', '.join(lost)}")
    return raw.withColumns(
        {
            name: F.lit(default).cast(RAW_TYPES[name])
            for name, default in DEFAULTS.items()
            if name not in present
        }
    )


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value).lower()


def _cell(name: str, dtype: str, default, fill: bool) -> str:
    value = scalars.parse_sql(name, dtype)
    if fill and default is not None:
        value = f"CASE WHEN `{name}` IS NULL THEN CAST({_literal(default)} AS {dtype}) ELSE {value} END"
    return f"{value} AS `{name}`"


def conform(raw: DataFrame, fill_numeric: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """The raw columns with their types and defaults.

    Only a missing cell takes the default. A cell that is there but does not
    parse, or is no finite number, becomes null and stays null. ``fill_numeric``
    off leaves missing numbers null too, so they do not pull averages to zero.
    The cells are SQL text, which builds in one call whatever their number.
    """
    kept = [f"`{name}`" for name in keep]
    typed = raw.selectExpr(
        *(
            _cell(name, dtype, default, fill_numeric or dtype not in ("double", "int"))
            for name, dtype, default in RAW_FIELDS
        ),
        *kept,
    )
    finite = (
        f"CASE WHEN abs(`{name}`) < double('Infinity') THEN `{name}` END AS `{name}`" if name in DOUBLES else f"`{name}`"
        for name in RAW_COLUMNS
    )
    return typed.selectExpr(*finite, *kept)


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.filter(F.col("meter_id").isNotNull() & F.col("timestamp").isNotNull())


def dedupe(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One row per meter and timestamp.

    Without ``order`` the remaining columns decide, so the survivor depends on
    row content only and reruns, replays and merges agree. The rank filter lets
    Spark cut each map task to one row per key before the shuffle, so a group of
    many copies never travels to one task. The time leads the sort because its
    prefix tells rows apart, which a shared id prefix does not.
    """
    ties = list(order) or [name for name in df.columns if name not in IDENTITY]
    window = Window.partitionBy("timestamp", "meter_id").orderBy(*ties)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def derive(df: DataFrame, lag_mode: str = "elapsed") -> DataFrame:
    """Lag, issue count, health status and calendar columns."""
    return df.withColumns(
        {
            "communication_lag_minutes": scalars.lag_minutes(mode=lag_mode),
            "issue_count": scalars.issue_count(),
            "event_date": F.to_date("timestamp"),
            "year": F.year("timestamp"),
            "month": scalars.two_digits(F.month("timestamp")),
            "day": scalars.two_digits(F.dayofmonth("timestamp")),
        }
    ).withColumn("health_status", scalars.health_status())


def project(df: DataFrame) -> DataFrame:
    return df.select(*PROCESSED_COLUMNS)


def clean(
    raw: DataFrame,
    order: Sequence[str] = (),
    lag_mode: str = "elapsed",
    fill_numeric: bool = True,
) -> DataFrame:
    """Raw readings to the 27 processed columns. ``order`` names source columns that rank duplicates."""
    return (
        raw.transform(add_missing)
        .transform(conform, fill_numeric, order)
        .drop("health_status")
        .transform(drop_incomplete)
        .transform(dedupe, order)
        .transform(derive, lag_mode)
        .transform(project)
    )
