"""Compare a Spark result with DuckDB's, column by column and value by value."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _kind(type_name: str) -> str:
    names = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "TIMESTAMP": "timestamp"}
    return names.get(str(type_name), str(type_name).lower())


def differences(spark_df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    expected_types = {c: _kind(t) for c, t in zip(relation.columns, relation.types)}
    found_types = dict(spark_df.dtypes)
    if expected_types != found_types:
        wrong = set(expected_types.items()) ^ set(found_types.items())
        return [f"columns or types differ: {sorted(wrong)}"]
    columns = sorted(found_types)

    def rows(names, data):
        at = [names.index(c) for c in columns]
        return sorted((tuple(_cell(row[i]) for i in at) for row in data), key=repr)

    found = rows(spark_df.columns, spark_df.collect())
    expected = rows(relation.columns, relation.fetchall())
    out = []
    if len(found) != len(expected):
        out.append(f"{len(found)} rows, expected {len(expected)}")
    for have, want in zip(found, expected):
        if have != want:
            out.append(f"{dict(zip(columns, have))} != {dict(zip(columns, want))}"[:900])
            if len(out) > 2:
                break
    return out
