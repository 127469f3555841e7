"""Readings from files and catalog tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from meterlake.schema import PROCESSED
from meterlake.sinks.versions import resolve
from meterlake.sources.deliveries import read_delivery
from meterlake.sources.paths import exists


def read_csv(spark: SparkSession, path, sniff: bool = False, sampling_ratio: float = 1.0) -> DataFrame:
    """Raw CSV with a header; bad rows are kept.

    Every column is text by default, so that cleaning can tell a missing cell
    from one that does not parse, and no extra pass is spent on inference.
    ``sniff`` infers types instead, from a sample of rows if asked. Files whose
    header differs from the first one's are an error here: Spark would otherwise
    take their cells by position. ``deliveries.read_delivery`` reads them by name.
    """
    reader = (
        spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    )
    if sniff:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_readings(spark: SparkSession, parquet: str | None = None, csv: str | None = None) -> DataFrame:
    """Parquet if it is there, else CSV files, each by its own header, else an error."""
    if parquet and exists(spark, parquet):
        return read_parquet(spark, parquet)
    if csv and exists(spark, csv):
        return read_delivery(spark, csv)
    raise FileNotFoundError(f"no readings at {parquet!r} or {csv!r}")


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """The partitioned table by path, in its current version. The schema is given, so month and day keep their leading zero."""
    return spark.read.schema(PROCESSED).parquet(resolve(spark, path)).select(*PROCESSED.names)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    try:
        return spark.table(name)
    except AnalysisException as error:
        raise LookupError(f"no such table: {name}") from error
