"""The batch load as one call, and its schema preview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.operators.clean import add_missing, clean, conform
from meterlake.operators.quality import load_summary
from meterlake.plans.views import refresh_views
from meterlake.sinks.merging import finish_pending, merge_files
from meterlake.sinks.tables import rebuild_table, register_table, table_location, write_partitioned
from meterlake.sources.files import read_processed, read_readings, read_table
from meterlake.sinks.versions import publish, resolve, retire


def load(
    spark: SparkSession,
    target: str,
    parquet: str | None = None,
    csv: str | None = None,
    table: str | None = None,
    rebuild: bool = False,
    extracts: str | None = None,
    lag_mode: str = "elapsed",
    replace_days: bool = False,
) -> DataFrame:
    """Read, clean and write readings; gives the load summary.

    By default the delivery is merged: stored readings stay, and of each meter and time one is kept. A merge that died
    halfway is finished first. With
    ``replace_days`` the delivered days are replaced as a whole. With ``rebuild`` the whole table is written afresh and
    takes the old one's place only when that is complete. ``extracts`` names a folder for the materialised
    views, of which only the changed days are rolled up again.
    """
    delivered = read_readings(spark, parquet, csv)
    known = table is not None and spark.catalog.tableExists(table)
    live = table_location(spark, table) if known else resolve(spark, target)
    if not rebuild:
        finish_pending(spark, live)
    if rebuild:
        cleaned = clean(delivered, lag_mode=lag_mode)
        if table is not None:
            rebuild_table(cleaned, table, target)
        else:
            publish(spark, target, lambda path: write_partitioned(cleaned, path, "rebuild"))
            retire(spark, target)
    elif replace_days:
        write_partitioned(clean(delivered, lag_mode=lag_mode), live)
    else:
        merge_files(delivered, live, lag_mode)
    if table is None:
        loaded = read_processed(spark, target)
    else:
        if known and not rebuild:
            spark.catalog.recoverPartitions(table)
            spark.catalog.refreshTable(table)
        elif not rebuild:
            register_table(spark, table, live)
        loaded = spark.table(table)
    if extracts:
        refresh_views(loaded, extracts)
    return load_summary(loaded)


def preview(spark: SparkSession, table: str, path: str, rows: int | None = None) -> DataFrame:
    """A raw catalog table with the schema applied, kept as Parquet; any ``rows`` of it if asked for."""
    mapped = read_table(spark, table).transform(add_missing).transform(conform)
    (mapped if rows is None else mapped.limit(rows)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
