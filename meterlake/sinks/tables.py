"""Writing the processed table, and the catalog entries over it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterlake.schema import PARTITION_KEYS, PROCESSED


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def balanced_by_day(df: DataFrame) -> DataFrame:
    """Cluster rows by day without tying a day to one task.

    A plain repartition by day would put a whole day, however large, into one
    task and one file. The rebalance hint lets adaptive execution split a large
    day and merge small ones towards the advisory partition size. Rows are
    sorted inside each day, so meter filters can skip row groups.
    """
    clustered = df.hint("rebalance", *PARTITION_KEYS)
    return clustered.sortWithinPartitions(*PARTITION_KEYS, "meter_id", "timestamp")


def write_partitioned(df: DataFrame, path: str, mode: str = "partitions", balance: bool = True) -> None:
    """Snappy Parquet under year=/month=/day=.

    ``partitions`` replaces only the days in ``df``, so a rerun of the same days
    changes nothing. ``rebuild`` clears the target first. ``balance`` off saves
    the shuffle for rows that are clustered by day already.
    """
    overwrite = {"partitions": "dynamic", "rebuild": "static"}[mode]
    (
        (balanced_by_day(df) if balance else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("compression", "snappy")
        .partitionBy(*PARTITION_KEYS)
        .parquet(path)
    )


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType = PROCESSED
) -> DataFrame:
    """(Re)create the external table over ``path`` with its partitions. Files are not touched.

    The new entry is complete, partitions listed, before it takes the name, so
    readers wait for two catalog calls rather than for the listing.
    """
    following = f"{name}__next"
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(following)}")
    spark.sql(
        f"CREATE TABLE {_quoted(following)} ({_columns_ddl(schema)}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITION_KEYS)}) LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(following)
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    spark.sql(f"ALTER TABLE {_quoted(following)} RENAME TO {_quoted(name)}")
    return spark.table(name)


def table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}")
    return described.filter("col_name = 'Location'").first()["data_type"]


def load_table(df: DataFrame, name: str, path: str, mode: str = "partitions") -> DataFrame:
    """Write and keep the catalog entry in step.

    A table that is there already is written where it lives, which after a
    rebuild is not ``path``.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        write_partitioned(df, path, mode)
        return register_table(spark, name, path)
    write_partitioned(df, table_location(spark, name), mode)
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def rebuild_table(df: DataFrame, name: str, base: str) -> DataFrame:
    """Full rebuild that never leaves the table empty.

    The rows go to a fresh folder under ``base``; only when they are complete
    does the name move there. A failed write leaves the old table as it was.
    The old folder stays for readers that still use it; removing it is up to
    the caller.
    """
    spark = df.sparkSession
    path = f"{base.rstrip('/')}/build-{uuid.uuid4().hex}"
    write_partitioned(df, path, "rebuild")
    return register_table(spark, name, path)


def discovered_schema(spark: SparkSession, path: str, known: T.StructType = PROCESSED) -> T.StructType:
    """Known columns as declared, then columns that only the files have, in their merged type."""
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    extra = [field for field in found.fields if field.name not in known.names]
    return T.StructType([*known.fields, *extra])


def discover_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Catalog the columns and partitions found under ``path``; columns no file has any more stay."""
    known = spark.table(name).schema if spark.catalog.tableExists(name) else PROCESSED
    return register_table(spark, name, path, discovered_schema(spark, path, known))


def save_full(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Full-refresh table, replaced as a whole on every run."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)
