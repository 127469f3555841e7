"""Discovery over the raw zone: which columns deliveries had, and a log of those that came and went.

The catalogue holds one row for each delivered file and column. The log and the versions of the schema follow
from it, so discovering the same files again changes nothing, and files may be found in any number of runs.
"""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.sources.deliveries import columns_of, delivered_files, headers, read_by_header
from meterlake.sources.paths import depth, exists


def delivered_columns(spark: SparkSession, zone: str, only: str | None = None) -> DataFrame:
    """(delivery, file, column_name, position) of all files. A delivery is a folder or file right below the zone."""
    found = headers(spark, delivered_files(spark, zone if only is None else only))
    at = depth(spark, zone)
    rows = []
    for file, header in found.items():
        delivery = urlparse(file).path.split("/")[at]
        rows += [(unquote(delivery), file, name.lower(), i) for i, name in enumerate(columns_of(header))]
    return spark.createDataFrame(rows, "delivery string, file string, column_name string, position int")


def discover_zone(spark: SparkSession, zone: str, catalogue: str, only: str | None = None) -> DataFrame:
    """Add the files of the zone, or ``only`` those below a part of it, that the catalogue does not know yet.

    Gives the catalogue. Runs may be repeated and may come in any order.
    """
    found = delivered_columns(spark, zone, only)
    if exists(spark, catalogue):
        known = spark.read.parquet(catalogue).select("file").distinct()
        found = found.join(known, "file", "left_anti")
    found.write.mode("append").parquet(catalogue)
    return spark.read.parquet(catalogue)


def _numbered(catalogue: DataFrame) -> DataFrame:
    """Deliveries in order of their name, from 1. There is one row a delivery, so the order is taken at once."""
    return catalogue.select("delivery").distinct().withColumn("number", F.row_number().over(Window.orderBy("delivery")))


def column_log(catalogue: DataFrame) -> DataFrame:
    """(delivery, column_name, event): columns that appeared, vanished or returned with a delivery.

    A column counts as there if any file of the delivery has it. Vanished columns are logged and stay in the
    schema.
    """
    numbers = _numbered(catalogue)
    last = F.lit(numbers.agg(F.max("number")).first()[0])
    present = catalogue.select("delivery", "column_name").distinct().join(numbers, "delivery")
    of_column = Window.partitionBy("column_name").orderBy("number")
    present = present.withColumns({"before": F.lag("number").over(of_column), "after": F.lead("number").over(of_column)})
    came = present.select("number", "column_name", F.when(F.col("before").isNull(), "appeared").when(F.col("before") < F.col("number") - 1, "returned").alias("event"))
    gap = F.coalesce("after", last + 1) > F.col("number") + 1
    went = present.where(gap).select((F.col("number") + 1).alias("number"), "column_name", F.lit("vanished").alias("event"))
    events = came.where("event is not null").unionByName(went)
    return events.join(numbers, "number").select("delivery", "column_name", "event")


def schema_versions(catalogue: DataFrame) -> DataFrame:
    """(version, delivery, columns, known_columns): a version for each delivery with an event in the log.

    columns are those of the delivery in order of name; known_columns counts all that any delivery had up to then.
    """
    log = column_log(catalogue)
    changed = log.groupBy("delivery").agg(F.count_if(F.col("event") == "appeared").alias("new"))
    columns = catalogue.groupBy("delivery").agg(F.array_join(F.sort_array(F.collect_set("column_name")), ",").alias("columns"))
    so_far = Window.orderBy("delivery")
    versions = changed.join(columns, "delivery").withColumns(
        {"version": F.row_number().over(so_far), "known_columns": F.sum("new").over(so_far)}
    )
    return versions.select("version", "delivery", "columns", "known_columns")


def read_zone(spark: SparkSession, zone: str, catalogue: DataFrame) -> DataFrame:
    """All readings of the zone as text, with every column that any delivery had; columns are matched by name."""
    known = catalogue.groupBy("column_name").agg(F.min(F.struct("delivery", "position")).alias("first"))
    columns = [row["column_name"] for row in known.orderBy("first", "column_name").collect()]
    return read_by_header(spark, headers(spark, delivered_files(spark, zone)), columns, required=(), fill=False)
