"""Oracle SQL per registered query."""

from __future__ import annotations

from meterlake_oracle.base import (
    BOUNDARY,
    count_if,
    exact_avg,
    exact_sum,
    over_filled,
    over_raw,
    over_readings,
    rnd,
    rnd_avg,
    total,
)
from meterlake_oracle.views import VIEW_SQL, view_cte

METERS = "COUNT(DISTINCT meter_id) AS meters"
AREA = "state, district, discom"
FLAGS = ("voltage_issue", "power_factor_issue", "comm_issue", "signal_issue", "battery_issue")
LABELS = ("health_status", "battery_status", "state", "discom", "firmware_version")

ORACLE_SQL: dict[str, str] = {}


def add(name: str, query: str, *extra: str, **options) -> None:
    ORACLE_SQL[name] = over_readings(query, *extra, **options)


# Sources, sinks, catalog.

WHOLE_TABLE = "SELECT * FROM readings"
for key in ("s01_csv_scan", "s02_csv_sniffed", "s03_parquet_scan", "s04_source_choice",
            "s07_partitioned_sink", "s14_fixed_projection", "s17_arriving_files", "s09_merge_same_day"):
    add(key, WHOLE_TABLE)
ORACLE_SQL["s05_missing_columns"] = over_readings(
    """SELECT * REPLACE (0.0::DOUBLE AS rssi, 'Unknown' AS firmware_version, false AS signal_issue,
         issue_count - CAST(signal_issue AS INTEGER) AS issue_count,
         CASE WHEN issue_count - CAST(signal_issue AS INTEGER) >= 3 THEN 'Critical'
              WHEN issue_count - CAST(signal_issue AS INTEGER) >= 1 THEN 'Warning' ELSE 'Healthy' END AS health_status)
       FROM readings"""
)
add("s06_catalog_scan", VIEW_SQL["fleet_summary"])
SUMMARY = f"SELECT COUNT(*) AS row_count, {METERS}, MIN(event_date) AS min_date, MAX(event_date) AS max_date FROM readings"
add("s08_rebuild", SUMMARY)
add("s16_load_summary", SUMMARY)
add(
    "s09_partition_overwrite",
    """SELECT event_date, CAST(SUM(CAST(consumption_kwh AS DECIMAL(18,6))
         * CASE WHEN event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-06' THEN 2 ELSE 1 END) AS DOUBLE) AS daily_consumption_kwh
       FROM readings GROUP BY event_date""",
)
add("s10_catalog_partitions", "SELECT year, month, day, COUNT(*) AS readings FROM readings GROUP BY year, month, day")
add(
    "s11_discovery",
    """SELECT day, COUNT(*) AS readings, COUNT(CASE WHEN event_date >= DATE '2024-01-16' THEN voltage END) AS with_tariff
       FROM readings GROUP BY day""",
)
add("s12_full_refresh", VIEW_SQL["health_by_status"])
VIEW_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS view_name, COUNT(*) AS row_count FROM {name}" for name in VIEW_SQL
)
for key in ("s13_view_registry", "k12_view_presence", "s18_materialised_views"):
    add(key, VIEW_COUNTS, *(view_cte(name) for name in VIEW_SQL))
ORACLE_SQL["s15_schema_preview"] = over_filled(
    """SELECT battery_status, firmware_version, COUNT(*) AS readings, COUNT(timestamp) AS timed, MIN(voltage) AS lowest_voltage
       FROM filled GROUP BY battery_status, firmware_version"""
)

# Cleaning, predicates, scalars.

ORACLE_SQL["p01_null_fill"] = over_filled("SELECT * FROM filled")
ORACLE_SQL["p01b_null_fill_labels_only"] = over_raw(
    """SELECT event_id, dup, coalesce(meter_id, 'UNKNOWN') AS meter_id, voltage,
         coalesce(signal_issue, false) AS signal_issue, coalesce(firmware_version, 'Unknown') AS firmware_version
       FROM raw"""
)
ORACLE_SQL["p02_cast_projection"] = over_filled(
    """SELECT * REPLACE (
         CASE WHEN event_id % 509 <> 11 THEN timestamp END AS timestamp,
         CASE WHEN event_id % 61 <> 7 THEN voltage END AS voltage,
         CASE WHEN event_id % 71 <> 5 THEN comm_issue END AS comm_issue)
       FROM filled"""
)
ORACLE_SQL["p03_parse_time"] = over_raw(
    "SELECT event_id, dup, CASE WHEN event_id % 509 <> 11 THEN timestamp END AS timestamp, last_communication_time FROM raw"
)
ORACLE_SQL["p04_drop_incomplete"] = over_filled(
    "SELECT meter_id, COUNT(*) AS readings FROM filled WHERE timestamp IS NOT NULL GROUP BY meter_id"
)
ORACLE_SQL["p05_dedupe"] = over_filled(
    """SELECT meter_id, timestamp, consumption_kwh, event_id, dup FROM filled WHERE timestamp IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY meter_id, timestamp ORDER BY event_id, dup) = 1"""
)
ORACLE_SQL["p06_dedupe_by_content"] = over_filled(
    """SELECT meter_id, timestamp, voltage, rssi, consumption_kwh FROM filled WHERE timestamp IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY meter_id, timestamp
         ORDER BY voltage, current, power_factor, last_communication_time NULLS FIRST, battery_status, battery_pct,
           rssi, firmware_version, state, district, discom, feeder_id, consumption_kwh) = 1"""
)
add("p07_lag_elapsed", "SELECT meter_id, timestamp, communication_lag_minutes AS lag_minutes FROM readings")
add("p08_lag_boundary", "SELECT meter_id, timestamp, communication_lag_minutes AS lag_minutes FROM readings", lag=BOUNDARY)
add("p09_issue_count", "SELECT issue_count, COUNT(*) AS readings FROM readings GROUP BY issue_count")
add("p10_health_status", "SELECT issue_count, health_status, COUNT(*) AS readings FROM readings GROUP BY issue_count, health_status")
add("p11_event_date", "SELECT meter_id, timestamp, event_date FROM readings")
add("p12_calendar_keys", "SELECT meter_id, timestamp, year, month, day FROM readings")
add("p13_flag_filter", "SELECT meter_id, timestamp, rssi FROM readings WHERE signal_issue = true")
add("p14_label_filter", "SELECT meter_id, timestamp, issue_count FROM readings WHERE health_status = 'Warning'")
add("p15_offline_threshold", f"SELECT state, {count_if('communication_lag_minutes > 180')} AS offline_readings FROM readings GROUP BY state")
add(
    "p16_partition_filter",
    """SELECT year, month, day, state, COUNT(*) AS readings FROM readings
       WHERE year = 2024 AND month = '01' AND day = '15' GROUP BY year, month, day, state""",
)
DISTRICTS = ", ".join(f"'NATION_{n}'" for n in range(20))
DISCOMS = ", ".join(f"'DISCOM-{n}'" for n in range(8))
add(
    "p17_dashboard_filters",
    f"""SELECT * FROM readings WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
        AND state IN ('ASIA', 'EUROPE', 'AFRICA') AND district IN ({DISTRICTS}) AND discom IN ({DISCOMS})
        AND firmware_version IN ('FW-2.0.0', 'FW-2.1.0', 'FW-2.3.0', 'Unknown') AND health_status IN ('Healthy', 'Warning')""",
)
for key, columns, flag in (
    ("p18_unhealthy_flag", "health_status", "CASE WHEN health_status = 'Healthy' THEN 0 ELSE 1 END AS unhealthy_flag"),
    ("p19_offline_flag", "comm_issue", "CASE WHEN communication_lag_minutes > 180 THEN 1 ELSE 0 END AS offline_flag"),
    ("p20_low_battery_flag", "battery_status", "CASE WHEN battery_status = 'Low' THEN 1 ELSE 0 END AS low_battery_flag"),
    ("p21_signal_quality", "rssi", "CASE WHEN rssi < -90 THEN 'Poor' WHEN rssi < -80 THEN 'Weak' ELSE 'Good' END AS signal_quality"),
):
    add(key, f"SELECT {columns}, {flag}, COUNT(*) AS readings FROM readings GROUP BY ALL")
add("p22_constant_label", "SELECT 'All readings' AS label, COUNT(*) AS readings FROM readings")

# Aggregation and ordering.

add("a01_count", "SELECT COUNT(*) AS readings FROM readings")
add("a02_count_distinct", f"SELECT feeder_id, {METERS} FROM readings GROUP BY feeder_id")
add("a03_count_if", "SELECT " + ", ".join(f"{count_if(f)} AS {f}" for f in FLAGS) + " FROM readings")
add(
    "a04_conditional_sum",
    "SELECT discom, "
    + ", ".join(f"CAST(SUM(CASE WHEN {f} THEN 1 ELSE 0 END) AS BIGINT) AS {f}" for f in FLAGS)
    + " FROM readings GROUP BY discom",
)
add("a05_sum", f"SELECT district, {exact_sum('consumption_kwh')} AS consumption_kwh, {total('issue_count')} AS issues FROM readings GROUP BY district")
add(
    "a06_avg",
    "SELECT district, "
    + ", ".join(f"{exact_avg(m)} AS average_{m}" for m in ("voltage", "current", "power_factor", "rssi", "battery_pct"))
    + " FROM readings GROUP BY district",
)
add("a07_min", "SELECT district, MIN(rssi) AS worst_rssi, MIN(voltage) AS lowest_voltage FROM readings GROUP BY district")
add(
    "a08_time_bounds",
    """SELECT meter_id, MAX(timestamp) AS last_seen_at, MIN(event_date) AS first_day, MAX(event_date) AS last_day
       FROM readings GROUP BY meter_id""",
)
add("a09_rounding", f"SELECT meter_id, {rnd_avg('voltage')} AS voltage_2, {rnd_avg('power_factor', 3)} AS power_factor_3 FROM readings GROUP BY meter_id")
PCT_CRITICAL = "100.0::DOUBLE * COUNT_IF(health_status = 'Critical') / COUNT(*)"
add("a10_row_percentage", f"SELECT feeder_id, {rnd(PCT_CRITICAL)} AS critical_pct FROM readings GROUP BY feeder_id")
add("a11_global", f"SELECT COUNT(*) AS readings, {METERS}, {exact_sum('consumption_kwh')} AS consumption_kwh FROM readings")
add("a12_five_keys", f"SELECT meter_id, {AREA}, feeder_id, COUNT(*) AS readings FROM readings GROUP BY meter_id, {AREA}, feeder_id")
add(
    "a13_reaggregation",
    f"""SELECT discom, {total('meters')} AS feeder_meters, MIN(average_rssi) AS lowest_average_rssi, {total('total_issues')} AS total_issues
        FROM feeder_risk GROUP BY discom""",
    view_cte("feeder_risk"),
)
add("a14_ordering", "SELECT district, battery_status, COUNT(*) AS readings FROM readings GROUP BY district, battery_status ORDER BY district, readings DESC, battery_status")
TOP = f"""SELECT meter_id, {AREA}, feeder_id, total_consumption_kwh FROM top_consumers
    ORDER BY total_consumption_kwh DESC, meter_id, {AREA}, feeder_id LIMIT """
add("a15_top_k", TOP + "25", view_cte("top_consumers"))
add("a16_labelled_counts", VIEW_SQL["issue_mix"])
add("a17_row_number", "SELECT event_date, COUNT(*) AS readings FROM (SELECT DISTINCT meter_id, timestamp, event_date FROM readings) GROUP BY event_date")

# Views.

for n, (name, sql) in enumerate(VIEW_SQL.items(), start=1):
    add(f"v{n:02d}_{name}", sql)

# Statements.

BY_STATUS = f"SELECT health_status, {METERS} FROM readings GROUP BY health_status ORDER BY meters DESC"
BY_BATTERY = f"SELECT battery_status, {METERS}, {rnd_avg('battery_pct')} AS average_battery_pct FROM readings GROUP BY battery_status ORDER BY meters DESC"
LOW_BATTERY = f"""SELECT meter_id, {AREA}, battery_pct, battery_status, timestamp FROM readings
    WHERE battery_issue = true ORDER BY battery_pct ASC, timestamp DESC"""
BY_DISCOM_KWH = f"SELECT discom, {exact_sum('consumption_kwh')} AS consumption_kwh FROM readings GROUP BY discom ORDER BY consumption_kwh DESC"
BY_FIRMWARE = f"SELECT firmware_version, {METERS} FROM readings GROUP BY firmware_version ORDER BY meters DESC"


def status_by(key: str) -> str:
    return f"SELECT {key}, health_status, {METERS} FROM readings GROUP BY {key}, health_status"


add("q01_fleet_summary", VIEW_SQL["fleet_summary"])
add("q02_meters_by_status", BY_STATUS)
add(
    "q03_communication_totals",
    f"""SELECT {count_if('communication_lag_minutes > 180')} AS offline_meters, {count_if('comm_issue')} AS communication_issues,
        {rnd_avg('rssi')} AS average_rssi FROM readings""",
)
SIGNAL_BY_STATE = f"SELECT state, MIN(rssi) AS worst_rssi, {rnd_avg('rssi')} AS average_rssi FROM readings GROUP BY state ORDER BY worst_rssi"
add("q04_signal_by_state", SIGNAL_BY_STATE)
add(
    "q05_electrical_totals",
    f"""SELECT {count_if('voltage_issue')} AS voltage_violations, {count_if('power_factor_issue')} AS low_power_factor,
        {rnd_avg('voltage')} AS average_voltage, {rnd_avg('current')} AS average_current FROM readings""",
)
add(
    "q06_electrical_hotspots",
    f"""SELECT {AREA}, voltage_violations, low_power_factor, average_voltage, average_current
        FROM electrical_health ORDER BY voltage_violations DESC""",
    view_cte("electrical_health"),
)
add("q07_battery_by_status", BY_BATTERY)
add("q08_low_battery_devices", LOW_BATTERY)
add("q09_daily_totals", f"SELECT event_date, {exact_sum('consumption_kwh')} AS daily_consumption_kwh FROM readings GROUP BY event_date")
add("q10_monthly_totals", f"SELECT year, month, {exact_sum('consumption_kwh')} AS monthly_consumption_kwh FROM readings GROUP BY year, month")
add("q11_biggest_consumers", TOP + "100", view_cte("top_consumers"))
add("q12_consumption_by_discom", BY_DISCOM_KWH)
for n, key in ((13, "state"), (14, "district"), (15, "discom")):
    add(f"q{n}_status_by_{key}", status_by(key))
add("q16_meters_by_firmware", BY_FIRMWARE)
add("q17_firmware_health", VIEW_SQL["firmware_distribution"])

# Notebook.

add("n01_fleet_summary", VIEW_SQL["fleet_summary"])
add("n02_health_split", VIEW_SQL["health_by_status"])
add(
    "n03_weakest_states",
    f"SELECT state, MIN(worst_rssi) AS worst_rssi, {rnd_avg('average_rssi')} AS average_rssi FROM communication_health GROUP BY state",
    view_cte("communication_health"),
)
add(
    "n04_electrical_by_state",
    f"""SELECT state, {total('voltage_violations')} AS voltage_violations, {total('low_power_factor')} AS low_power_factor,
        {rnd_avg('average_voltage')} AS average_voltage FROM electrical_health GROUP BY state""",
    view_cte("electrical_health"),
)
add(
    "n05_battery_by_status",
    f"""SELECT battery_status, {total('devices')} AS devices, {rnd_avg('average_battery_pct')} AS average_battery_pct
        FROM battery_health GROUP BY battery_status""",
    view_cte("battery_health"),
)
add(
    "n06_consumption_trend",
    f"SELECT event_date, {exact_sum('total_consumption_kwh')} AS total_consumption_kwh FROM daily_consumption GROUP BY event_date",
    view_cte("daily_consumption"),
)
FIRMWARE_SUMS = ", ".join(
    f"{total(c)} AS {c}" for c in ("meters", "communication_issues", "signal_issues", "voltage_issues")
)
add(
    "n07_firmware_issues",
    f"SELECT firmware_version, {FIRMWARE_SUMS} FROM firmware_distribution GROUP BY firmware_version",
    view_cte("firmware_distribution"),
)
add(
    "n08_leading_consumers",
    f"SELECT * FROM top_consumers ORDER BY total_consumption_kwh DESC, meter_id, {AREA}, feeder_id LIMIT 10",
    view_cte("top_consumers"),
)
add(
    "n09_warning_districts",
    """SELECT district, COUNT(*) AS warning_readings FROM readings WHERE health_status = 'Warning'
       GROUP BY district ORDER BY warning_readings DESC, district LIMIT 5""",
)
add("n03x_weakest_states_exact", SIGNAL_BY_STATE)
add(
    "n04x_electrical_by_state_exact",
    f"""SELECT state, {count_if('voltage_issue')} AS voltage_violations, {count_if('power_factor_issue')} AS low_power_factor,
        {rnd_avg('voltage')} AS average_voltage FROM readings GROUP BY state""",
)
add(
    "n05x_battery_by_status_exact",
    f"SELECT battery_status, COUNT(*) AS devices, {rnd_avg('battery_pct')} AS average_battery_pct FROM readings GROUP BY battery_status",
)
add(
    "n07x_firmware_issues_exact",
    f"""SELECT firmware_version, {METERS}, {count_if('comm_issue')} AS communication_issues,
        {count_if('signal_issue')} AS signal_issues, {count_if('voltage_issue')} AS voltage_issues
        FROM readings GROUP BY firmware_version""",
)

# Charts.

for n, column in enumerate(("total_meters", "healthy", "warning", "critical"), start=1):
    add(f"c{n:02d}_{column}", f"SELECT {total(column)} AS {column} FROM fleet_summary", view_cte("fleet_summary"))


def chart(name: str, view: str, groupby: str, metrics: str, order: str) -> None:
    add(name, f"SELECT {groupby}, {metrics} FROM {view} GROUP BY {groupby} ORDER BY {order}, {groupby}", view_cte(view))


def sums(*columns: str) -> str:
    return ", ".join(f"{total(c)} AS {c}" for c in columns)


def avgs(*columns: str) -> str:
    return ", ".join(f"{exact_avg(c)} AS {c}" for c in columns)


KWH_SUM = f"{exact_sum('total_consumption_kwh')} AS total_consumption_kwh"
chart("c05_fleet_health", "health_by_status", "health_status", sums("readings"), "SUM(readings) DESC")
chart("c06_daily_consumption", "daily_consumption", "event_date, state", KWH_SUM, "event_date")
chart(
    "c07_state_health", "state_health_summary", "state",
    sums("total_meters", "healthy", "warning", "critical") + ", " + avgs("warning_pct", "critical_pct", "average_rssi"),
    "SUM(total_meters) DESC",
)
chart(
    "c08_communication_hotspots", "communication_health", AREA,
    f"{sums('communication_issues')}, {avgs('average_rssi')}, MIN(worst_rssi) AS worst_rssi",
    "SUM(communication_issues) DESC",
)
chart("c09_issue_mix", "issue_mix", "issue_type", sums("issue_count"), "SUM(issue_count) DESC")
chart("c10_battery_status", "battery_status_summary", "battery_status", sums("meters"), "SUM(meters) DESC")
chart("c11_firmware_mix", "firmware_distribution", "firmware_version", sums("meters"), "SUM(meters) DESC")
chart(
    "c12_electrical_risk", "electrical_health", AREA,
    sums("voltage_violations", "low_power_factor") + ", " + avgs("average_voltage", "average_current", "average_power_factor"),
    "SUM(voltage_violations) DESC",
)
chart(
    "c13_feeder_risk", "feeder_risk", f"feeder_id, {AREA}",
    sums("critical_meters", "warning_meters", "total_issues") + ", " + avgs("average_rssi") + ", " + KWH_SUM,
    "SUM(critical_meters) DESC",
)

# Deployed and specified visuals.

TOTAL_METERS = "SELECT COUNT(DISTINCT meter_id) AS total_meters FROM readings"


def kpi(measure: str, digits: int = 2) -> str:
    return f"SELECT {rnd_avg(measure, digits)} AS average_{measure} FROM readings"


def mean_by(key: str, measure: str) -> str:
    return f"SELECT {key}, {rnd_avg(measure)} AS average_{measure} FROM readings GROUP BY {key}"


def kwh_by(key: str, k: int | None = None) -> str:
    limit = f" LIMIT {k}" if k else ""
    return f"SELECT {key}, {exact_sum('consumption_kwh')} AS consumption_kwh FROM readings GROUP BY {key} ORDER BY consumption_kwh DESC, {key}{limit}"


def issues_by(key: str, flag: str, name: str) -> str:
    return f"SELECT {key}, {count_if(flag)} AS {name} FROM readings GROUP BY {key}"


def status_meters(*statuses: str) -> str:
    return ", ".join(
        f"COUNT(DISTINCT CASE WHEN health_status = '{s}' THEN meter_id END) AS {s.lower()}_meters" for s in statuses
    )


def histogram(column: str, width: float) -> str:
    step = round(width * 1_000_000)
    return f"""SELECT floor(CAST(round({column} * 1000000) AS BIGINT) / {step}) * {step} / 1000000 AS bin_low, COUNT(*) AS readings
        FROM readings WHERE {column} IS NOT NULL GROUP BY 1"""


FLEET_TABLE = f"""SELECT {AREA}, {METERS}, {rnd_avg('voltage')} AS average_voltage, {rnd_avg('rssi')} AS average_rssi,
    {rnd_avg('battery_pct')} AS average_battery_pct, {count_if("health_status = 'Warning'")} AS warning,
    {count_if("health_status = 'Critical'")} AS critical FROM readings GROUP BY {AREA}"""

for key in ("d01_total_meters", "e01_total_meters"):
    add(key, TOTAL_METERS)
for prefix, measure, digits in (
    ("d02_average_voltage", "voltage", 2), ("d03_average_rssi", "rssi", 2),
    ("d04_average_battery", "battery_pct", 2), ("d05_average_kwh", "consumption_kwh", 3),
    ("e05_average_voltage", "voltage", 2), ("e06_average_rssi", "rssi", 2),
    ("e07_average_battery", "battery_pct", 2), ("e08_average_kwh", "consumption_kwh", 3),
):
    add(prefix, kpi(measure, digits))
for key in ("d06_fleet_health", "e09_health_donut"):
    add(key, BY_STATUS)
for key in ("d07_state_health", "e12_state_health"):
    add(key, status_by("state"))
add("d08_consumption_by_discom", BY_DISCOM_KWH)
add("d09_battery_status", BY_BATTERY)
for key in ("d10_fleet_table", "e11_fleet_table"):
    add(key, FLEET_TABLE)
add("d11_firmware", BY_FIRMWARE)
add("d12_district_health", status_by("district"))
add("d13_voltage_by_state", mean_by("state", "voltage"))
add("d14_rssi_by_discom", mean_by("discom", "rssi"))
add("d15_consumption_by_feeder", kwh_by("feeder_id"))
add(
    "d16_device_details",
    f"""SELECT meter_id, timestamp, {AREA}, feeder_id, firmware_version, health_status, issue_count, voltage, rssi, battery_pct, consumption_kwh
        FROM readings WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'
        AND state IN ('AMERICA', 'ASIA') AND health_status IN ('Warning', 'Critical')""",
)
for key, status in (("e02_healthy_meters", "Healthy"), ("e03_warning_meters", "Warning"), ("e04_critical_meters", "Critical")):
    add(key, f"SELECT {status_meters(status)} FROM readings")
add("e02_04_meters_with_status", f"SELECT {status_meters('Healthy', 'Warning', 'Critical')} FROM readings")
add("e10_health_trend", status_by("event_date"))
add(
    "e13_district_heatmap",
    "SELECT district, " + ", ".join(
        f"COUNT(DISTINCT CASE WHEN health_status = '{s}' THEN meter_id END) AS {s.lower()}" for s in ("Healthy", "Warning", "Critical")
    ) + " FROM readings GROUP BY district",
)
add("e14_discom_comparison", f"SELECT discom, {status_meters('Healthy', 'Warning', 'Critical')} FROM readings GROUP BY discom")
for key, column, width in (
    ("e15_rssi_distribution", "rssi", 5), ("e19_voltage_distribution", "voltage", 5),
    ("e20_power_factor_distribution", "power_factor", 0.01), ("e22_current_distribution", "current", 1),
    ("e24_battery_distribution", "battery_pct", 10),
):
    add(key, histogram(column, width))
add("e16_comm_issues_by_state", issues_by("state", "comm_issue", "communication_issues"))
add("e16_comm_issues_by_discom", issues_by("discom", "comm_issue", "communication_issues"))
add(
    "e17_signal_quality",
    """SELECT CASE WHEN rssi < -90 THEN 'Poor' WHEN rssi < -80 THEN 'Weak' ELSE 'Good' END AS signal_quality, COUNT(*) AS readings
       FROM readings GROUP BY 1""",
)
add(
    "e18_worst_signal_devices",
    f"SELECT meter_id, {AREA}, rssi, last_communication_time, health_status FROM readings ORDER BY rssi, meter_id, timestamp",
)
add("e21_voltage_issues_by_state", issues_by("state", "voltage_issue", "voltage_violations"))
add("e23_electrical_devices", "SELECT meter_id, voltage, current, power_factor, " + ", ".join(FLAGS) + " FROM readings")
add("e25_low_battery_devices", LOW_BATTERY)
add("e26_battery_by_firmware", mean_by("firmware_version", "battery_pct"))
add("e27_consumption_by_state", kwh_by("state"))
add("e28_top_feeders", kwh_by("feeder_id", 20))
add("e29_top_districts", kwh_by("district"))
add("e30_firmware_health", status_by("firmware_version"))
add(
    "e31_firmware_issue_table",
    f"""SELECT firmware_version, {count_if('comm_issue')} AS communication_issues, {count_if('signal_issue')} AS signal_issues,
        {count_if('voltage_issue')} AS voltage_issues, {count_if("health_status = 'Critical'")} AS critical
        FROM readings GROUP BY firmware_version""",
)

# Data quality.

RAW_COLUMNS = (
    "meter_id", "timestamp", "voltage", "current", "power_factor", "last_communication_time", "battery_status",
    "battery_pct", "rssi", "firmware_version", "state", "district", "discom", "feeder_id", "consumption_kwh",
    *FLAGS, "health_status",
)
REQUIRED = (
    "meter_id", "timestamp", "voltage", "current", "power_factor", "last_communication_time", "battery_status",
    "rssi", "firmware_version", "state", "district", "discom",
)


def raw(name: str, query: str) -> None:
    ORACLE_SQL[name] = over_raw(query)


raw("k01_shape", f"SELECT COUNT(*) AS row_count, {len(RAW_COLUMNS)} AS column_count, '{','.join(RAW_COLUMNS)}' AS column_names FROM raw")


def null_counts(absent=()) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS field, false AS present, CAST(NULL AS BIGINT) AS null_count" if c in absent
        else f"SELECT '{c}' AS field, true AS present, {count_if(f'{c} IS NULL')} AS null_count FROM raw"
        for c in REQUIRED
    )


raw("k02_required_fields", null_counts(("rssi", "discom")))
raw("k03_null_counts", null_counts())
KEYS = "(SELECT COUNT(*) FROM (SELECT DISTINCT meter_id, timestamp FROM raw))"
raw("k04_duplicates", f"SELECT COUNT(*) AS row_count, COUNT(*) - {KEYS} AS duplicate_rows FROM raw")
raw("k05_unique_meters", "SELECT COUNT(DISTINCT meter_id) AS unique_meters FROM raw")
raw("k06_time_range", "SELECT MIN(timestamp) AS first_reading_at, MAX(timestamp) AS last_reading_at FROM raw")
raw(
    "k07_numeric_ranges",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value,
            {rnd_avg(c, 3)} AS mean_value FROM raw"""
        for c in ("voltage", "current", "power_factor", "rssi", "battery_pct")
    ),
)
add(
    "k08_category_counts",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {c} AS label, COUNT(*) AS row_count FROM readings GROUP BY {c}" for c in LABELS
    ),
)
raw(
    "k09_issue_rates",
    "\nUNION ALL\n".join(
        f"SELECT '{f}' AS flag, {rnd(f'100.0::DOUBLE * COUNT_IF({f}) / COUNT({f})')} AS issue_rate_pct FROM raw" for f in FLAGS
    ),
)


def verdict(relation: str, required) -> str:
    empty = " + ".join(f"CAST(COUNT_IF({c} IS NULL) AS BIGINT)" for c in required)
    keys = f"(SELECT COUNT(*) FROM (SELECT DISTINCT meter_id, timestamp FROM {relation}))"
    return f"""SELECT *, null_cells = 0 AND duplicate_rows = 0 AS fit_for_use FROM (
        SELECT COUNT(*) AS row_count, {empty} AS null_cells, COUNT(*) - {keys} AS duplicate_rows FROM {relation})"""


raw("k10_verdict_raw", verdict("raw", REQUIRED))
add("k10_verdict_processed", verdict("readings", [c for c in REQUIRED if c != "last_communication_time"]))
add(
    "k11_expected_counts",
    """SELECT *, row_count = expected_rows AS as_expected FROM (
       SELECT COUNT(*) AS row_count, COUNT(DISTINCT meter_id) AS unique_meters,
         (SELECT COUNT(*) FROM (SELECT DISTINCT meter_id, timestamp FROM filled WHERE timestamp IS NOT NULL)) AS expected_rows
       FROM readings)""",
)
add("k13_status_counts", "SELECT health_status, COUNT(*) AS readings FROM readings GROUP BY health_status")
add(
    "k14_range_violations",
    "\nUNION ALL\n".join(
        f"""SELECT meter_id, timestamp, '{c}' AS measure, {c} AS value, CAST({lo} AS DOUBLE) AS lower_limit, CAST({hi} AS DOUBLE) AS upper_limit
            FROM readings WHERE {c} NOT BETWEEN {lo} AND {hi}"""
        for c, lo, hi in (("voltage", 200, 250), ("rssi", -110, -40))
    ),
)
raw(
    "k15_duplicate_readings",
    "SELECT meter_id, timestamp, COUNT(*) AS copies FROM raw WHERE timestamp IS NOT NULL GROUP BY meter_id, timestamp HAVING COUNT(*) > 1",
)
raw("k15_missing_timestamps", "SELECT meter_id, COUNT(*) AS readings FROM raw WHERE timestamp IS NULL GROUP BY meter_id")
ORACLE_SQL["k15_load_losses"] = over_filled(
    f"""SELECT COUNT(*) AS raw_rows, {count_if("meter_id = 'UNKNOWN'")} AS unknown_meter_rows,
        {count_if('timestamp IS NULL')} AS untimed_rows, COUNT(timestamp) - kept AS surplus_copies, kept AS kept_rows
        FROM filled, (SELECT COUNT(*) AS kept FROM (SELECT DISTINCT meter_id, timestamp FROM filled WHERE timestamp IS NOT NULL))
        GROUP BY kept"""
)
DELIVERED = ["timestamp", "meter_id", *(c for c in RAW_COLUMNS[2:] if c != "rssi"), "batch_no"]


def drift_line(column: str) -> str:
    if column == "batch_no":
        return "SELECT 'batch_no' AS column_name, 'unexpected' AS status, COUNT(event_id) AS present_cells FROM raw"
    if column == "rssi":
        return "SELECT 'rssi' AS column_name, 'missing' AS status, CAST(0 AS BIGINT) AS present_cells"
    status = "ok" if DELIVERED.index(column) == RAW_COLUMNS.index(column) else "moved"
    return f"SELECT '{column}' AS column_name, '{status}' AS status, COUNT({column}) AS present_cells FROM raw"


raw("k16_schema_drift", "\nUNION ALL\n".join(drift_line(c) for c in (*RAW_COLUMNS, "batch_no")))
FAULTS = {
    "timestamp": "event_id % 509 = 11",
    "voltage": "event_id % 61 = 7",
    "comm_issue": "event_id % 71 = 5",
}
raw(
    "k16_unparseable_cells",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {count_if(FAULTS.get(c, 'false'))} AS unparseable_cells FROM raw" for c in RAW_COLUMNS
    ),
)
ORACLE_SQL["k16_declared_status"] = over_filled(
    """SELECT declared, derived, COUNT(*) AS readings FROM (
         SELECT CASE WHEN voltage_issue THEN 'Critical' ELSE 'Healthy' END AS declared,
           CASE WHEN issues >= 3 THEN 'Critical' WHEN issues >= 1 THEN 'Warning' ELSE 'Healthy' END AS derived
         FROM (SELECT *, CAST(voltage_issue AS INTEGER) + CAST(power_factor_issue AS INTEGER) + CAST(comm_issue AS INTEGER)
           + CAST(signal_issue AS INTEGER) + CAST(battery_issue AS INTEGER) AS issues FROM filled))
       WHERE declared <> derived GROUP BY declared, derived"""
)
COMM = VIEW_SQL["communication_health"]
BOUNDARY_COMM = COMM.replace("communication_lag_minutes > 180", f"{BOUNDARY} > 180")
add(
    "k17_reconcile",
    """SELECT *, 1::BIGINT AS left_rows, 0::BIGINT AS right_rows FROM (SELECT * FROM elapsed EXCEPT ALL SELECT * FROM bounded)
       UNION ALL
       SELECT *, 0::BIGINT AS left_rows, 1::BIGINT AS right_rows FROM (SELECT * FROM bounded EXCEPT ALL SELECT * FROM elapsed)""",
    f"elapsed AS ({COMM})",
    f"bounded AS ({BOUNDARY_COMM})",
)

# Named future analytics.


def whole(expression: str) -> str:
    """An exact integer as the nearest double."""
    return f"CAST(CAST({expression} AS VARCHAR) AS DOUBLE)"


def scored(source: str, value: str, keep: str, threshold: float) -> str:
    """Score ``value`` by the exact sums ``n``, ``total`` and ``squares`` of ``source``."""
    return f"""
      SELECT {keep}, {rnd('mean', 4)} AS mean_value, {rnd('deviation', 4)} AS deviation, {rnd('z', 4)} AS z_score,
        coalesce(abs(z) > {threshold}, false) AS is_outlier
      FROM (SELECT *, CASE WHEN deviation > 0 THEN ({value} - mean) / deviation END AS z FROM (
        SELECT *, {whole('total')} / 1000000.0::DOUBLE / n AS mean,
          CASE WHEN n > 1 THEN sqrt({whole('n * squares - total * total')} / {whole('n * (n - 1)')}) / 1000000.0::DOUBLE END AS deviation
        FROM {source}))"""


add(
    "x01_rolling_outliers",
    scored("framed", "value", "meter_id, timestamp, value", 2.5)
    + """ UNION ALL SELECT meter_id, timestamp, consumption_kwh, NULL, NULL, NULL, false FROM readings WHERE meter_id = 'UNKNOWN'""",
    """micro AS (
         SELECT meter_id, timestamp, consumption_kwh AS value, CAST(round(consumption_kwh * 1000000) AS HUGEINT) AS m
         FROM readings WHERE meter_id <> 'UNKNOWN')""",
    """framed AS (
         SELECT meter_id, timestamp, value,
           CASE WHEN COUNT(*) OVER w = 12 THEN CAST(COUNT(*) OVER w AS HUGEINT) END AS n,
           CAST(SUM(m) OVER w AS HUGEINT) AS total, CAST(SUM(m * m) OVER w AS HUGEINT) AS squares
         FROM micro
         WINDOW w AS (PARTITION BY meter_id ORDER BY timestamp ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))""",
)
add(
    "x02_alert_severity",
    """SELECT health_status, CASE
         WHEN issue_count >= 3 OR (coalesce(communication_lag_minutes > 180, false) AND battery_pct < 20) THEN 'Severe'
         WHEN issue_count = 2 OR coalesce(communication_lag_minutes > 180, false) THEN 'Major'
         WHEN issue_count = 1 OR battery_pct < 20 THEN 'Minor' ELSE 'None' END AS severity, COUNT(*) AS readings
       FROM readings GROUP BY 1, 2""",
)
add(
    "x03_row_level_access",
    """SELECT state, district, COUNT(*) AS readings FROM readings
       WHERE state IN (SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name = 'NATION_7')
       GROUP BY state, district""",
)
add(
    "x04_feeder_outliers",
    scored("grouped", "total_consumption_kwh", f"feeder_id, {AREA}, total_consumption_kwh", 2.0),
    view_cte("feeder_risk"),
    """stats AS (
         SELECT discom, CAST(COUNT(*) AS HUGEINT) AS n, CAST(SUM(m) AS HUGEINT) AS total, CAST(SUM(m * m) AS HUGEINT) AS squares
         FROM (SELECT discom, CAST(round(total_consumption_kwh * 1000000) AS HUGEINT) AS m FROM feeder_risk) GROUP BY discom)""",
    "grouped AS (SELECT * FROM feeder_risk JOIN stats USING (discom))",
)
add(
    "x05_voltage_bands",
    f"""SELECT state, district, COUNT(*) AS readings, {count_if('voltage < 200')} AS under_voltage, {count_if('voltage > 250')} AS over_voltage
        FROM readings GROUP BY state, district""",
)

# Deliveries, raw zone, refreshes, sketches and access on several levels.

SHORT = "event_id % 4 = 1"
ISSUES = f"issue_count - CASE WHEN {SHORT} THEN CAST(signal_issue AS INTEGER) ELSE 0 END"
add(
    "s01_several_headers",
    f"""SELECT * EXCLUDE (event_id, dup) REPLACE (
          CASE WHEN {SHORT} THEN 0.0 ELSE rssi END AS rssi,
          CASE WHEN {SHORT} THEN 'Unknown' ELSE firmware_version END AS firmware_version,
          signal_issue AND NOT {SHORT} AS signal_issue, CAST({ISSUES} AS INTEGER) AS issue_count,
          CASE WHEN {ISSUES} >= 3 THEN 'Critical' WHEN {ISSUES} >= 1 THEN 'Warning' ELSE 'Healthy' END AS health_status)
        FROM (SELECT r.*, k.event_id, k.dup FROM readings r JOIN kept k USING (meter_id, timestamp))""",
)
FORMS = ("a_complete", "b_short", "c_reordered", "d_extended")
PER_FORM = f"SELECT [{', '.join(repr(form) for form in FORMS)}][event_id % 4 + 1] AS delivery, COUNT(*) AS readings FROM raw GROUP BY event_id % 4"
LOST = ("rssi", "firmware_version", "signal_issue")
EVENTS = (
    [("a_complete", c, "appeared") for c in RAW_COLUMNS]
    + [("b_short", c, "vanished") for c in LOST]
    + [("c_reordered", c, "returned") for c in LOST]
    + [("d_extended", c, "appeared") for c in ("tariff", "batch_no")]
)
ORACLE_SQL["s11_raw_zone_log"] = over_raw(
    f"""SELECT delivery, column_name, event, readings
        FROM (VALUES {", ".join(map(repr, EVENTS))}) AS events(delivery, column_name, event) JOIN ({PER_FORM}) USING (delivery)"""
)
ORACLE_SQL["s11_raw_zone_versions"] = over_raw(
    """SELECT CAST(version AS INTEGER) AS version, delivery, CAST(known_columns AS BIGINT) AS known_columns, with_tariff, with_rssi
       FROM (VALUES (1, 'a_complete', 21), (2, 'b_short', 21), (3, 'c_reordered', 21), (4, 'd_extended', 23))
         AS versions(version, delivery, known_columns),
       (SELECT COUNT(CASE WHEN event_id % 4 = 3 THEN 1 END) AS with_tariff, COUNT(CASE WHEN event_id % 4 <> 1 THEN rssi END) AS with_rssi FROM raw)"""
)
ORACLE_SQL["k16_delivery_headers"] = over_raw(
    f"""SELECT delivery, readings, CASE delivery WHEN 'b_short' THEN 'rssi,firmware_version,signal_issue' ELSE '' END AS missing,
          CASE delivery WHEN 'd_extended' THEN 'tariff,batch_no' ELSE '' END AS unexpected, '' AS twice,
          delivery = 'c_reordered' AS moved, true AS readable
        FROM ({PER_FORM})"""
)
add(
    "s18_incremental_refresh",
    """SELECT event_date, state, district, discom,
         CAST(SUM(CAST(kwh AS DECIMAL(18,6))) AS DOUBLE) AS total_consumption_kwh,
         CAST(SUM(CAST(kwh AS DECIMAL(18,6))) AS DOUBLE) / COUNT(kwh) AS average_consumption_kwh, COUNT(DISTINCT meter_id) AS meters
       FROM (SELECT *, consumption_kwh * CASE WHEN event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-06' THEN 2 ELSE 1 END AS kwh FROM readings)
       GROUP BY event_date, state, district, discom""",
)
add(
    "a02_sketched_meters",
    f"SELECT {AREA}, health_status, {METERS}, true AS is_close FROM readings GROUP BY {AREA}, health_status",
)
add(
    "x03_levels",
    f"""SELECT {AREA}, COUNT(*) AS readings FROM readings
        WHERE (state = (SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey = 1)
            OR district IN (SELECT n_name FROM nation WHERE n_nationkey IN (2, 7)) OR discom = 'DISCOM-3'
            OR (district = (SELECT n_name FROM nation WHERE n_nationkey = 14) AND discom = 'DISCOM-4'))
          AND district NOT IN (SELECT n_name FROM nation WHERE n_nationkey = 11)
        GROUP BY {AREA}""",
)
SMALL = "(COUNT(*) * 0.5::DOUBLE + SUM(battery_pct) * 0.25::DOUBLE + SUM(issue_count) / 1048576::DOUBLE)"
add("a05_wide_sums", f"SELECT district, {SMALL} AS total, {SMALL} / (COUNT(*) * 6) AS average, COUNT(*) * 6 AS n FROM readings GROUP BY district")
add(
    "k17_reconcile_by_day",
    """SELECT event_date, CAST(COUNT(*) AS BIGINT) AS before, CAST(COUNT(*) AS BIGINT) AS after FROM readings
       WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-06' AND consumption_kwh <> 0 GROUP BY event_date""",
)
for column in ("voltage", "current", "power_factor", "battery_pct"):
    add(
        f"e19_fitted_bins_{column}",
        f"""SELECT floor(CAST(round({column} * 1000000) AS BIGINT) / step) * step / 1000000 AS bin_low, COUNT(*) AS readings, step / 1000000 AS bin_width
            FROM readings, steps WHERE {column} IS NOT NULL GROUP BY bin_low, step""",
        f"""spans AS (SELECT 2 * (quantile_disc({column}, 0.75) - quantile_disc({column}, 0.25)) / pow(COUNT({column}), 1 / 3.0) AS raw FROM readings)""",
        "leads AS (SELECT pow(10, floor(log10(raw))) AS power, raw / pow(10, floor(log10(raw))) AS lead FROM spans)",
        """steps AS (SELECT round(1000000 * power * CASE WHEN lead < 1.5 THEN 1 WHEN lead < 3.5 THEN 2 WHEN lead < 7.5 THEN 5 ELSE 10 END) AS step
           FROM leads)""",
    )
TYPES = {"timestamp": "timestamp", "last_communication_time": "timestamp"} | {c: "boolean" for c in FLAGS}
TYPES |= {c: "double" for c in ("voltage", "current", "power_factor", "rssi", "consumption_kwh")} | {"battery_pct": "int"}
ODD = FAULTS | {"battery_pct": "event_id % 67 = 3"}
raw(
    "s02_sniffed_types",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, '{TYPES.get(c, "string")}' AS likely_type, 
              {count_if(f"{c} IS NOT NULL OR {ODD.get(c, 'false')}")} AS cells, {count_if(ODD.get(c, 'false'))} AS conflicts FROM raw"""
        for c in RAW_COLUMNS
    ),
)
