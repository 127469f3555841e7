"""Row filters: dashboard controls and row-level access."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import product
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions import scalars
from meterlake.schema import PARTITION_KEYS

#: Levels of the area that access may be granted on.
AREA_LEVELS = ("state", "district", "discom")

Choice = str | Iterable[str] | None


def _date(value) -> dt.date | None:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def _not_before(day: dt.date) -> Column:
    year, month, dom = (F.col(key) for key in PARTITION_KEYS)
    same_year = (month > f"{day:%m}") | ((month == f"{day:%m}") & (dom >= f"{day:%d}"))
    return (year > day.year) | ((year == day.year) & same_year)


def _not_after(day: dt.date) -> Column:
    year, month, dom = (F.col(key) for key in PARTITION_KEYS)
    same_year = (month < f"{day:%m}") | ((month == f"{day:%m}") & (dom <= f"{day:%d}"))
    return (year < day.year) | ((year == day.year) & same_year)


def in_dates(df: DataFrame, date_from=None, date_to=None) -> DataFrame:
    """Readings of the days from ``date_from`` to ``date_to``, both included.

    The table is partitioned by year, month and day, so a test on ``event_date``
    alone would read every partition. The same bound is stated on the keys too.
    """
    date_from, date_to = _date(date_from), _date(date_to)
    if date_from is not None:
        df = df.filter(_not_before(date_from) & (F.col("event_date") >= F.lit(date_from)))
    if date_to is not None:
        df = df.filter(_not_after(date_to) & (F.col("event_date") <= F.lit(date_to)))
    return df


def in_partition(df: DataFrame, year: int, month: int | str | None = None, day: int | str | None = None) -> DataFrame:
    """Readings of a year, month or day by partition key."""
    df = df.filter(F.col("year") == int(year))
    for key, value in (("month", month), ("day", day)):
        if value is not None:
            df = df.filter(F.col(key) == f"{int(value):02d}")
    return df


def on_days(df: DataFrame, days) -> DataFrame:
    """Readings of the given days, by partition keys: one term a month."""
    months: dict[tuple[str, str], list[str]] = {}
    for day in days:
        year, month, dom = day.split("-")
        months.setdefault((year, month), []).append(dom)
    terms = [f"(year = {int(y)} AND month = '{m}' AND day IN ({', '.join(repr(d) for d in sorted(ds))}))" for (y, m), ds in sorted(months.items())]
    return df.where(" OR ".join(terms) or "false")


def apply_filters(
    df: DataFrame,
    date_from=None,
    date_to=None,
    state: Choice = None,
    district: Choice = None,
    discom: Choice = None,
    firmware_version: Choice = None,
    health_status: Choice = None,
) -> DataFrame:
    """The six dashboard controls; one left out does not filter."""
    df = in_dates(df, date_from, date_to)
    choices = {
        "state": state,
        "district": district,
        "discom": discom,
        "firmware_version": firmware_version,
        "health_status": health_status,
    }
    for name, choice in choices.items():
        if choice is not None:
            df = df.filter(F.col(name).isin([choice] if isinstance(choice, str) else list(choice)))
    return df


def with_flags(df: DataFrame) -> DataFrame:
    """The calculated dashboard fields."""
    return df.withColumns(
        {
            "unhealthy_flag": scalars.unhealthy_flag(),
            "offline_flag": scalars.offline_flag(),
            "low_battery_flag": scalars.low_battery_flag(),
            "signal_quality": scalars.signal_quality(),
        }
    )


def restrict(df: DataFrame, grants: DataFrame, principal: str, by: Sequence[str] = ("state",)) -> DataFrame:
    """The rows ``principal`` may see.

    ``grants`` has a ``principal`` column and the columns in ``by``. A semi join
    keeps each reading once however many grants match. Spark broadcasts the
    grants only if their size allows it; else adaptive execution splits a state
    that holds a large part of the rows.
    """
    allowed = grants.filter(F.col("principal") == principal).select(*by)
    return df.join(allowed, list(by), "left_semi")


def entitled_areas(grants: DataFrame, principal: str, areas: DataFrame, levels: Sequence[str] = AREA_LEVELS) -> DataFrame:
    """The areas that ``principal`` may see, by grants on any level and denials.

    A grant names a state, a district, a discom or any of them together; null stands for all. A grant whose `denied` is
    true takes its areas away, whatever else allows them. Grants are spread over the areas there are, so the
    readings need no expansion: one equality join for every set of levels that a grant may name, 2 to the number of
    levels, each over areas and grants only.
    """
    denied = F.coalesce(F.col("denied"), F.lit(False)) if "denied" in grants.columns else F.lit(False)
    own = grants.where(F.col("principal") == principal).select(denied.alias("denied"), *levels)
    areas = areas.select(*levels).distinct()
    spread = []
    for named in product((False, True), repeat=len(levels)):
        chosen = [c for c, is_named in zip(levels, named) if is_named]
        these = own.where(reduce(and_, (F.col(c).isNotNull() if n else F.col(c).isNull() for c, n in zip(levels, named))))
        if chosen:
            spread.append(areas.join(these.select("denied", *chosen), chosen))
        else:
            spread += [areas.withColumn("denied", F.lit(row["denied"])) for row in these.select("denied").distinct().collect()]
    closure = reduce(DataFrame.unionByName, spread).groupBy(*levels)
    return closure.agg(F.bool_or("denied").alias("denied")).where("not denied").drop("denied")


def restrict_levels(
    df: DataFrame, grants: DataFrame, principal: str, areas: DataFrame | None = None, levels: Sequence[str] = AREA_LEVELS
) -> DataFrame:
    """The rows ``principal`` may see by grants on several levels; each row once.

    ``areas`` holds the areas there are, such as a maintained extract; without it they are taken from the readings,
    by a scan of these columns alone. Rows whose area has a null are seen by nobody but through a grant that leaves
    that level open.
    """
    areas = df if areas is None else areas
    allowed = entitled_areas(grants, principal, areas, levels)
    allowed = allowed.select(*(F.col(c).alias(f"_{c}") for c in levels))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in levels))
    return df.join(allowed, same, "left_semi")
