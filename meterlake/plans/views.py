"""The named views over the processed table.

Each builder takes readings or a meter-day rollup and gives the same rows.
"Offline", "critical" and "warning" columns count readings, as the names of the
count columns beside them (``readings``, ``devices``) suggest; ``meters`` and
``total_meters`` count distinct meters.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.measures import (
    components,
    flag_rows,
    mean,
    meter_day_rollup,
    meters,
    pct_of_rows,
    rounded_mean,
    row_count,
    sketched,
    status_rows,
    total,
)
from meterlake.operators.filters import on_days
from meterlake.schema import CRITICAL, HEALTHY, PARTITION_KEYS, WARNING
from meterlake.sinks.versions import current, publish, resolve, retire
from meterlake.sources.paths import delete, exists

AREA = ("state", "district", "discom")


def fleet_summary(df: DataFrame, approx: bool = False) -> DataFrame:
    return components(sketched(df) if approx else df).agg(
        meters(approx).alias("total_meters"),
        status_rows(HEALTHY).alias("healthy"),
        status_rows(WARNING).alias("warning"),
        status_rows(CRITICAL).alias("critical"),
        rounded_mean("voltage").alias("average_voltage"),
        rounded_mean("rssi").alias("average_rssi"),
        rounded_mean("battery_pct").alias("average_battery_pct"),
        rounded_mean("consumption_kwh", 3).alias("average_consumption_kwh"),
    )


def health_by_status(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy("health_status")
        .agg(row_count().alias("readings"), meters().alias("meters"))
    )


def communication_health(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy(*AREA)
        .agg(
            row_count().alias("readings"),
            flag_rows("comm_issue").alias("communication_issues"),
            flag_rows("offline").alias("offline_meters"),
            rounded_mean("rssi").alias("average_rssi"),
            F.min("rssi__min").alias("worst_rssi"),
        )
    )


def electrical_health(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy(*AREA)
        .agg(
            row_count().alias("readings"),
            flag_rows("voltage_issue").alias("voltage_violations"),
            flag_rows("power_factor_issue").alias("low_power_factor"),
            rounded_mean("voltage").alias("average_voltage"),
            rounded_mean("current").alias("average_current"),
            rounded_mean("power_factor", 3).alias("average_power_factor"),
        )
    )


def battery_health(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy(*AREA, "battery_status")
        .agg(
            row_count().alias("devices"),
            rounded_mean("battery_pct").alias("average_battery_pct"),
            flag_rows("battery_issue").alias("low_battery_devices"),
        )
    )


def _consumption(df: DataFrame, *keys: str) -> DataFrame:
    return (
        components(df)
        .groupBy(*keys)
        .agg(
            total("consumption_kwh").alias("total_consumption_kwh"),
            mean("consumption_kwh").alias("average_consumption_kwh"),
            meters().alias("meters"),
        )
    )


def daily_consumption(df: DataFrame) -> DataFrame:
    return _consumption(df, "event_date", *AREA)


def monthly_consumption(df: DataFrame) -> DataFrame:
    return _consumption(df, "year", "month", "state", "discom")


def geographic_health(df: DataFrame, approx: bool = False) -> DataFrame:
    return (
        components(sketched(df) if approx else df)
        .groupBy(*AREA, "health_status")
        .agg(
            row_count().alias("meter_readings"),
            meters(approx).alias("meters"),
            rounded_mean("voltage").alias("average_voltage"),
            rounded_mean("rssi").alias("average_rssi"),
            rounded_mean("battery_pct").alias("average_battery_pct"),
        )
    )


def firmware_distribution(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy("firmware_version", "health_status")
        .agg(
            meters().alias("meters"),
            flag_rows("comm_issue").alias("communication_issues"),
            flag_rows("signal_issue").alias("signal_issues"),
            flag_rows("voltage_issue").alias("voltage_issues"),
        )
    )


def top_consumers(df: DataFrame) -> DataFrame:
    """Every meter at its place with its consumption; ranking is left to the reader."""
    return (
        components(df)
        .groupBy("meter_id", *AREA, "feeder_id")
        .agg(
            total("consumption_kwh").alias("total_consumption_kwh"),
            mean("voltage").alias("average_voltage"),
            mean("current").alias("average_current"),
            F.max("timestamp__max").alias("last_seen_at"),
        )
    )


# Label of each issue flag in the issue mix.
ISSUE_LABELS = (
    ("Voltage Issues", "voltage_issue"),
    ("Power Factor Issues", "power_factor_issue"),
    ("Communication Issues", "comm_issue"),
    ("Signal Issues", "signal_issue"),
    ("Battery Issues", "battery_issue"),
)


def issue_mix(df: DataFrame) -> DataFrame:
    """One labelled row per flag, from a single pass."""
    counted = components(df).agg(*(flag_rows(flag).alias(flag) for _, flag in ISSUE_LABELS))
    pairs = (F.struct(F.lit(label).alias("issue_type"), F.col(flag).alias("issue_count"))
             for label, flag in ISSUE_LABELS)
    return counted.select(F.inline(F.array(*pairs)))


def state_health_summary(df: DataFrame, approx: bool = False) -> DataFrame:
    status = F.col("health_status")
    return (
        components(sketched(df) if approx else df)
        .groupBy("state")
        .agg(
            meters(approx).alias("total_meters"),
            status_rows(HEALTHY).alias("healthy"),
            status_rows(WARNING).alias("warning"),
            status_rows(CRITICAL).alias("critical"),
            pct_of_rows(status == WARNING).alias("warning_pct"),
            pct_of_rows(status == CRITICAL).alias("critical_pct"),
            rounded_mean("rssi").alias("average_rssi"),
            rounded_mean("battery_pct").alias("average_battery_pct"),
        )
    )


def feeder_risk(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy("feeder_id", *AREA)
        .agg(
            meters().alias("meters"),
            status_rows(CRITICAL).alias("critical_meters"),
            status_rows(WARNING).alias("warning_meters"),
            total("issue_count").alias("total_issues"),
            rounded_mean("rssi").alias("average_rssi"),
            rounded_mean("voltage").alias("average_voltage"),
            F.round(total("consumption_kwh"), 2).alias("total_consumption_kwh"),
        )
    )


def battery_status_summary(df: DataFrame) -> DataFrame:
    return (
        components(df)
        .groupBy("battery_status")
        .agg(
            meters().alias("meters"),
            rounded_mean("battery_pct").alias("average_battery_pct"),
            flag_rows("battery_issue").alias("low_battery_devices"),
        )
    )


VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "fleet_summary": fleet_summary,
    "health_by_status": health_by_status,
    "communication_health": communication_health,
    "electrical_health": electrical_health,
    "battery_health": battery_health,
    "daily_consumption": daily_consumption,
    "monthly_consumption": monthly_consumption,
    "geographic_health": geographic_health,
    "firmware_distribution": firmware_distribution,
    "top_consumers": top_consumers,
    "issue_mix": issue_mix,
    "state_health_summary": state_health_summary,
    "feeder_risk": feeder_risk,
    "battery_status_summary": battery_status_summary,
}


def register_views(df: DataFrame, prefix: str = "vw_") -> list[str]:
    """Create or replace a temp view per builder; each is recomputed when queried."""
    names = []
    for name, build in VIEWS.items():
        build(df).createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names


ROLLUP = "meter_day_rollup"
_DAYS = "days"


def _write_views(rollup: DataFrame, folder: str, names, at_once: int) -> None:
    """The views are small jobs; a few run at once, so that one's last tasks do not leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        list(pool.map(lambda name: VIEWS[name](rollup).write.parquet(f"{folder}/{name}"), names))


def materialise_views(df: DataFrame, base: str, names=tuple(VIEWS), at_once: int = 4) -> dict[str, str]:
    """Build the views as Parquet extracts, reading the table once; gives their folders.

    The rollup is written first and all views read it, so N views cost one scan
    of the readings rather than N. All extracts are one version of ``base``: they become visible together when all are
    complete, and a failed refresh leaves the old ones.
    """
    spark = df.sparkSession

    def write(folder: str) -> None:
        meter_day_rollup(df).write.parquet(f"{folder}/{ROLLUP}")
        _write_views(spark.read.parquet(f"{folder}/{ROLLUP}"), folder, names, at_once)

    folder = publish(spark, base, write)
    retire(spark, base)
    return {name: f"{folder}/{name}" for name in names}


def extract(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A materialised view, as of the last complete refresh."""
    return spark.read.parquet(f"{resolve(spark, base)}/{name}")


def day_fingerprints(df: DataFrame) -> dict[str, str]:
    """For each stored day of a partitioned table a digest of its files' names, which no two writes share."""
    files: dict[str, list[str]] = {}
    for path in df.inputFiles():
        keys = dict(part.split("=", 1) for part in path.split("/")[-4:-1])
        files.setdefault("-".join(keys[key] for key in PARTITION_KEYS), []).append(path.rsplit("/", 1)[1])
    return {day: sha256("\n".join(sorted(names)).encode()).hexdigest() for day, names in files.items()}


def refresh_views(df: DataFrame, base: str, names=tuple(VIEWS), at_once: int = 4) -> dict[str, str]:
    """Bring the extracts up to date at the price of the days that changed; gives their folders.

    df is the stored table. Its rollup, one row for each meter, day and label combination, is kept by day under ``base``.
    A day is rolled up again if its files are not those of the last refresh; no other reading is read. All views add up
    parts of the rollup, and count distinct meters over its rows, so they equal those of a full recomputation. If a refresh
    dies, the record of days is still the old one, and the next refresh repeats the days.
    """
    spark, base = df.sparkSession, base.rstrip("/")
    kept, last = f"{base}/_rollup", current(spark, base)
    now, known = day_fingerprints(df), {}
    if last is not None and exists(spark, f"{last}/{_DAYS}") and exists(spark, kept):
        known = {row["day"]: row["digest"] for row in spark.read.parquet(f"{last}/{_DAYS}").collect()}
    changed = sorted(day for day, digest in now.items() if known.get(day) != digest)
    gone = sorted(set(known) - set(now))
    complete = last is not None and all(exists(spark, f"{last}/{name}") for name in names)
    if complete and known and not changed and not gone:
        return {name: f"{last}/{name}" for name in names}
    fresh = meter_day_rollup(on_days(df, changed) if known else df).withColumn("of_day", F.col("event_date").cast("string"))
    if changed or not known:
        writer = fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if known else "static")
        writer.partitionBy("of_day").parquet(kept)
    for day in gone:
        delete(spark, f"{kept}/of_day={day}")

    def write(folder: str) -> None:
        schema = fresh.select([c for c in fresh.columns if c != "of_day"]).schema
        _write_views(spark.read.schema(schema).parquet(kept), folder, names, at_once)
        spark.createDataFrame(sorted(now.items()), "day string, digest string").coalesce(1).write.parquet(f"{folder}/{_DAYS}")

    folder = publish(spark, base, write)
    retire(spark, base)
    return {name: f"{folder}/{name}" for name in names}
