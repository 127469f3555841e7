"""Generic chart query: group a view, apply metrics, order, limit."""

from __future__ import annotations

from collections.abc import Sequence
from math import floor, log10

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.measures import exact_avg, exact_sum
from meterlake.functions.scalars import bin_floor


#: Quartiles are exact up to one in so many rows.
QUANTILE_ACCURACY = 100_000


def _metric(df: DataFrame, how: str, column: str) -> Column:
    fractional = dict(df.dtypes)[column] == "double"
    if how == "sum":
        value = exact_sum(column) if fractional else F.sum(column)
    elif how == "avg":
        value = exact_avg(column) if fractional else F.avg(column)
    elif how in ("min", "max"):
        value = getattr(F, how)(column)
    elif how == "count":
        value = F.count(column)
    elif how == "count_distinct":
        value = F.count_distinct(column)
    else:
        raise ValueError(f"unknown metric: {how}")
    return value.alias(column)


def chart_query(
    view: DataFrame,
    groupby: Sequence[str],
    metrics: Sequence[tuple[str, str]],
    order: Sequence[str] | None = None,
    limit: int | None = None,
    time_column: str | None = None,
    time_range: tuple | None = None,
) -> DataFrame:
    """``metrics`` are (aggregate, column) pairs; each result carries its column's name.

    Without ``order`` the first metric leads, largest first. The keys always
    break ties, so a row limit, if asked for, cuts at the same place on every run.
    """
    if time_range is not None:
        view = view.filter(F.col(time_column).between(*time_range))
    values = [_metric(view, how, column) for how, column in metrics]
    if not groupby:
        return view.agg(*values)
    ranked = [F.col(key) for key in order] if order else [F.desc(metrics[0][1])]
    ordered = view.groupBy(*groupby).agg(*values).orderBy(*ranked, *groupby)
    return ordered if limit is None else ordered.limit(limit)


def histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    """Readings per bin of ``width``; the bin is named by its lower edge. Missing values have no bin."""
    binned = df.filter(F.col(column).isNotNull()).withColumn("bin_low", bin_floor(column, width))
    return binned.groupBy("bin_low").agg(F.count("*").alias("readings")).orderBy("bin_low")


def bin_width(df: DataFrame, column: str) -> float:
    """A bin width that suits the column's values: twice the middle half's span over the cube root of their number,
    rounded to 1, 2 or 5 times a power of ten.

    Quartiles come from mergeable quantile summaries, so one pass is enough. Never below a millionth, on which bins are cut; 1
    for a column without a span.
    """
    value = F.col(column).cast("double")
    quartiles = F.percentile_approx(value, [0.25, 0.75], F.lit(QUANTILE_ACCURACY)).alias("q")
    facts = df.agg(F.count(value).alias("n"), quartiles, F.max(value).alias("high"), F.min(value).alias("low")).first()
    if not facts["n"] or facts["high"] == facts["low"]:
        return 1.0
    span = facts["q"][1] - facts["q"][0] or facts["high"] - facts["low"]
    raw = max(2 * span / facts["n"] ** (1 / 3), 1e-6)
    power = floor(log10(raw))
    lead = raw / 10.0**power
    step = 1 if lead < 1.5 else 2 if lead < 3.5 else 5 if lead < 7.5 else 10
    return round(step * 10.0**power, 6)


def fitted_histogram(df: DataFrame, column: str) -> DataFrame:
    """Histogram with a width taken from the data, which the column `bin_width` tells."""
    width = bin_width(df, column)
    return histogram(df, column, width).withColumn("bin_width", F.lit(width))
