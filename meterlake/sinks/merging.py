"""Merging deliveries into the processed table, one row per key."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators.clean import clean, dedupe, derive, project
from meterlake.operators.filters import in_dates
from meterlake.schema import PARTITION_KEYS
from meterlake.sinks.tables import write_partitioned
from meterlake.sources.files import read_processed
from meterlake.sources.paths import delete, exists, siblings, stamp

_DERIVED = ("event_date", "communication_lag_minutes", "issue_count", "health_status", *PARTITION_KEYS)
_STAGING = "__merge-"


def stored_on_days_of(fresh: DataFrame, stored: DataFrame, days_path: str) -> DataFrame:
    """The stored readings of the days that ``fresh`` touches; no other partition is listed or read.

    The span of days becomes a literal range on the partition keys, so Spark prunes when it plans. Days inside
    the span that the delivery does not touch are pruned at run time: the touched days are written as a small table
    (one row a day, so bounded by the calendar), which Spark broadcasts by its size and hands to the scan.
    """
    spark = fresh.sparkSession
    fresh.select("event_date", *PARTITION_KEYS).distinct().coalesce(1).write.mode("overwrite").parquet(days_path)
    touched = spark.read.parquet(days_path)
    span = touched.agg(F.min("event_date").alias("first"), F.max("event_date").alias("last")).first()
    if span["first"] is None:
        return stored.limit(0)
    # Dynamic pruning wants a filter on the side that prunes.
    days = touched.filter(F.col("event_date").between(F.lit(span["first"]), F.lit(span["last"]))).select(*PARTITION_KEYS)
    return in_dates(stored, span["first"], span["last"]).join(days, list(PARTITION_KEYS), "left_semi")


def merge_delivery(raw: DataFrame, target: str, staging: str, number: int = 0, lag_mode: str = "elapsed") -> None:
    """Add a raw delivery to ``target``: stored rows of its days stay, and of each key one row is kept.

    The survivor depends on row content only, so deliveries in any split end in the table that one load gives.
    Only the days that the delivery touches are read. The merged days are complete under ``staging`` before any day of
    the target is replaced. If the job dies in between, a replay of the same ``number`` finds them finished and only
    repeats the replacement.
    """
    spark = raw.sparkSession
    merged = f"{staging.rstrip('/')}/batch-{number}"
    landed = f"{staging.rstrip('/')}/fresh-{number}"
    touched = f"{staging.rstrip('/')}/days-{number}"
    if not exists(spark, f"{merged}/_SUCCESS"):
        fresh = clean(raw, lag_mode=lag_mode)
        if exists(spark, target):
            fresh.write.mode("overwrite").parquet(landed)
            fresh = spark.read.parquet(landed)
            stored = stored_on_days_of(fresh, read_processed(spark, target), touched)
            both = stored.unionByName(fresh).drop(*_DERIVED)
            fresh = both.transform(dedupe).transform(derive, lag_mode).transform(project)
        write_partitioned(fresh, merged, "rebuild")
    replace_days(spark, merged, target)
    delete(spark, landed)
    delete(spark, touched)


def replace_days(spark: SparkSession, merged: str, target: str) -> None:
    """Put the complete days under ``merged`` in place of the target's."""
    write_partitioned(read_processed(spark, merged), target, balance=False)


def delivery_name(delivered: DataFrame) -> str:
    """A name that the same files have on every run: from their paths, sizes and times."""
    spark = delivered.sparkSession
    files = sorted(delivered.inputFiles())
    text = "\n".join(f"{path} {stamp(spark, path)}" for path in files)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()[:32]


def staging_of(delivered: DataFrame, target: str) -> str:
    return f"{target.rstrip('/')}{_STAGING}{delivery_name(delivered)}"


def finish_pending(spark: SparkSession, target: str) -> list[str]:
    """Complete what earlier loads of ``target`` left behind when they died; gives the staging folders found.

    Merged days that are complete take their place, as they would have; it does not matter how many of them
    already had. Incomplete ones go, and their delivery has to come again. Run this before any other change to the
    target, by its one writer: staged days are those of the table as it was.
    """
    found = siblings(spark, f"{target.rstrip('/')}{_STAGING}")
    for staging in found:
        for merged in siblings(spark, f"{staging}/batch-"):
            if exists(spark, f"{merged}/_SUCCESS"):
                replace_days(spark, merged, target)
        delete(spark, staging)
    return found


def merge_files(delivered: DataFrame, target: str, lag_mode: str = "elapsed") -> None:
    """Merge a delivery read from files, after finishing what an earlier run may have left."""
    finish_pending(delivered.sparkSession, target)
    staging = staging_of(delivered, target)
    merge_delivery(delivered, target, staging, lag_mode=lag_mode)
    delete(delivered.sparkSession, staging)
