"""Deliveries of CSV files whose headers differ: each file is read by its own header, columns meet by name."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.schema import DEFAULTS, RAW_COLUMNS, UNDEFAULTED
from meterlake.sources.paths import first_line


def lines_of(spark: SparkSession, path) -> DataFrame:
    """Text lines with the file they stand in."""
    return with_file(spark.read.text(path, recursiveFileLookup=True))


def with_file(text: DataFrame) -> DataFrame:
    # Local paths are written with one slash or with three; both mean one file.
    return text.select("value", F.regexp_replace("_metadata.file_path", "^file:/+", "file:///").alias("file"))


def delivered_files(spark: SparkSession, path) -> list[str]:
    """Files below the path, or paths, as Spark lists them; nothing is read."""
    listed = spark.read.text(path, recursiveFileLookup=True).inputFiles()
    return sorted(re.sub("^file:/+", "file:///", file) for file in listed)


def headers(spark: SparkSession, files: Iterable[str], at_once: int = 32) -> dict[str, str]:
    """The header of each file; a file without any line has none.

    One short read a file, as listing it takes, several at once. Only headers reach the driver.
    """
    files = list(files)
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return {file: line for file, line in zip(files, pool.map(lambda f: first_line(spark, f), files)) if line is not None}


def columns_of(header: str) -> list[str]:
    return [name.strip() for name in next(csv.reader([header]))]


def _header_state(header: str) -> tuple[list[str], list[str], list[str], bool]:
    """Columns that are missing, unexpected or there twice, and whether the known ones stand in another order."""
    names = [name.lower() for name in columns_of(header)]
    known = [name for name in names if name in RAW_COLUMNS]
    missing = [name for name in RAW_COLUMNS if name not in names]
    unexpected = [name for name in names if name not in RAW_COLUMNS]
    twice = sorted({name for name in names if names.count(name) > 1})
    return missing, unexpected, twice, known != [name for name in RAW_COLUMNS if name in known]


def header_report(spark: SparkSession, path) -> DataFrame:
    """One line for each delivered file: how its header differs from the expected one, and whether it can be read."""
    judged = []
    for file, header in headers(spark, delivered_files(spark, path)).items():
        missing, unexpected, twice, moved = _header_state(header)
        readable = not twice and not set(missing) & set(UNDEFAULTED)
        judged.append((file, ",".join(missing), ",".join(unexpected), ",".join(twice), moved, readable))
    schema = "file string, missing string, unexpected string, twice string, moved boolean, readable boolean"
    lines = lines_of(spark, path).where(F.trim("value") != "").groupBy("file").agg((F.count("*") - 1).alias("readings"))
    return lines.join(spark.createDataFrame(judged, schema), "file")


def _default(name: str | None) -> Column:
    """The text that cleaning reads as the column's default; null if it has none."""
    value = DEFAULTS.get(name)
    return F.lit(None if value is None else str(value).lower() if isinstance(value, bool) else str(value)).cast("string")


def read_by_header(spark: SparkSession, found: dict[str, str], columns=RAW_COLUMNS, required=UNDEFAULTED, fill: bool = True) -> DataFrame:
    """The given columns, as text, of all files in ``found``, given with their headers.

    One scan for each different header, all in one frame. An absent column becomes its default, as in a
    whole delivery without it. Columns that nobody expects are left out. A file that lacks a time column, which has no
    default, or names a column twice is an error that names the file. Other columns without a default are null where absent,
    and so are all without ``fill``.
    """
    files: dict[str, list[str]] = {}
    for file, header in found.items():
        files.setdefault(header, []).append(file)
    parts = []
    for header in sorted(files):
        names = [name.lower() for name in columns_of(header)]
        _, _, twice, _ = _header_state(header)
        if twice:
            raise ValueError(f"columns named twice, {', '.join(twice)}, in {files[header][0]}")
        if lost := [name for name in required if name not in names]:
            raise ValueError(f"no column {', '.join(lost)} in {files[header][0]}")
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
        reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
        cells = (F.col(f"`{name}`") if name in names else _default(name if fill else None) for name in columns)
        parts.append(reader.csv(sorted(files[header])).select(*(cell.alias(name) for cell, name in zip(cells, columns))))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(name, T.StringType()) for name in columns]))
    return reduce(DataFrame.unionByName, parts)


def read_delivery(spark: SparkSession, path) -> DataFrame:
    """Raw CSV readings of a delivery, whatever the order and number of columns of its files."""
    return read_by_header(spark, headers(spark, delivered_files(spark, path)))
