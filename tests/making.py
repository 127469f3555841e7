"""Small hand-made raw readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.schema import RAW_COLUMNS, RAW_STRINGS

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"

GOOD = {
    "meter_id": "M1",
    "timestamp": "2024-03-05 10:00:00",
    "voltage": "230.5",
    "current": "4.25",
    "power_factor": "0.91",
    "last_communication_time": "2024-03-05 09:30:00",
    "battery_status": "Good",
    "battery_pct": "80",
    "rssi": "-70",
    "firmware_version": "FW-1",
    "state": "S1",
    "district": "D1",
    "discom": "C1",
    "feeder_id": "F1",
    "consumption_kwh": "1.5",
    "voltage_issue": "false",
    "power_factor_issue": "false",
    "comm_issue": "false",
    "signal_issue": "false",
    "battery_issue": "false",
    "health_status": None,
}


def raw(spark: SparkSession, *changes: dict) -> DataFrame:
    """One text row per mapping: the good row with the given cells changed."""
    rows = [tuple({**GOOD, **change}[name] for name in RAW_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, RAW_STRINGS)


def records(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan_nodes(df: DataFrame) -> list:
    """Nodes of the plan that ran, those inside query stages included."""

    def below(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        inner = [node.plan()] if "QueryStage" in node.nodeName() else []
        children = node.children()
        return [node, *(x for c in [*inner, *(children.apply(i) for i in range(children.size()))] for x in below(c))]

    return below(df._jdf.queryExecution().executedPlan())


def scan_metric(df: DataFrame, metric: str) -> int:
    """A metric of all file scans, after running the frame."""
    df.collect()
    scans = (node.metrics().get(metric) for node in plan_nodes(df) if node.nodeName().startswith("Scan "))
    return sum(found.get().value() for found in scans if found.isDefined())


def scanned_partitions(df: DataFrame) -> int:
    return scan_metric(df, "numPartitions")
