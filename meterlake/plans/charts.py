"""The registered charts: parameters of the generic chart query."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from meterlake.operators.charts import chart_query
from meterlake.plans.views import AREA, VIEWS

# The column a chart's time filter applies to, per dataset.
TIME_COLUMNS = {
    "readings": "event_date",
    "daily_consumption": "event_date",
    "top_consumers": "last_seen_at",
}


@dataclass(frozen=True)
class Chart:
    view: str
    groupby: tuple[str, ...]
    metrics: tuple[tuple[str, str], ...]
    order: tuple[str, ...] | None = None

    def query(self, df: DataFrame, limit: int | None = None, time_range: tuple | None = None) -> DataFrame:
        """The chart's rows over the processed table or its rollup."""
        return chart_query(
            VIEWS[self.view](df),
            self.groupby,
            self.metrics,
            self.order,
            limit,
            TIME_COLUMNS.get(self.view),
            time_range,
        )


def _sums(*columns: str):
    return tuple(("sum", column) for column in columns)


def _avgs(*columns: str):
    return tuple(("avg", column) for column in columns)


CHARTS: dict[str, Chart] = {
    "total_meters": Chart("fleet_summary", (), _sums("total_meters")),
    "healthy": Chart("fleet_summary", (), _sums("healthy")),
    "warning": Chart("fleet_summary", (), _sums("warning")),
    "critical": Chart("fleet_summary", (), _sums("critical")),
    "fleet_health": Chart("health_by_status", ("health_status",), _sums("readings")),
    "daily_consumption": Chart(
        "daily_consumption",
        ("event_date", "state"),
        _sums("total_consumption_kwh"),
        order=("event_date", "state"),
    ),
    "state_health": Chart(
        "state_health_summary",
        ("state",),
        _sums("total_meters", "healthy", "warning", "critical")
        + _avgs("warning_pct", "critical_pct", "average_rssi"),
    ),
    "communication_hotspots": Chart(
        "communication_health",
        AREA,
        (("sum", "communication_issues"), ("avg", "average_rssi"), ("min", "worst_rssi")),
    ),
    "issue_mix": Chart("issue_mix", ("issue_type",), _sums("issue_count")),
    "battery_status": Chart("battery_status_summary", ("battery_status",), _sums("meters")),
    "firmware_mix": Chart("firmware_distribution", ("firmware_version",), _sums("meters")),
    "electrical_risk": Chart(
        "electrical_health",
        AREA,
        _sums("voltage_violations", "low_power_factor")
        + _avgs("average_voltage", "average_current", "average_power_factor"),
    ),
    "feeder_risk": Chart(
        "feeder_risk",
        ("feeder_id", *AREA),
        (
            ("sum", "critical_meters"),
            ("sum", "warning_meters"),
            ("sum", "total_issues"),
            ("avg", "average_rssi"),
            ("sum", "total_consumption_kwh"),
        ),
    ),
}
