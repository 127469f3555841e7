"""Oracle SQL of the named views, as SELECT bodies over ``readings``."""

from meterlake_oracle.base import count_if, exact_avg, exact_sum, rnd, rnd_avg, total

_STATUS = ",\n".join(
    f"{count_if(f'health_status = {chr(39)}{s}{chr(39)}')} AS {s.lower()}" for s in ("Healthy", "Warning", "Critical")
)
_METERS = "COUNT(DISTINCT meter_id)"

VIEW_SQL = {
    "fleet_summary": f"""SELECT {_METERS} AS total_meters, {_STATUS},
        {rnd_avg('voltage')} AS average_voltage, {rnd_avg('rssi')} AS average_rssi,
        {rnd_avg('battery_pct')} AS average_battery_pct, {rnd_avg('consumption_kwh', 3)} AS average_consumption_kwh
        FROM readings""",
    "health_by_status": f"""SELECT health_status, COUNT(*) AS readings, {_METERS} AS meters
        FROM readings GROUP BY health_status""",
    "communication_health": f"""SELECT state, district, discom, COUNT(*) AS readings,
        {count_if('comm_issue')} AS communication_issues,
        {count_if('communication_lag_minutes > 180')} AS offline_meters,
        {rnd_avg('rssi')} AS average_rssi, MIN(rssi) AS worst_rssi
        FROM readings GROUP BY state, district, discom""",
    "electrical_health": f"""SELECT state, district, discom, COUNT(*) AS readings,
        {count_if('voltage_issue')} AS voltage_violations, {count_if('power_factor_issue')} AS low_power_factor,
        {rnd_avg('voltage')} AS average_voltage, {rnd_avg('current')} AS average_current,
        {rnd_avg('power_factor', 3)} AS average_power_factor
        FROM readings GROUP BY state, district, discom""",
    "battery_health": f"""SELECT state, district, discom, battery_status, COUNT(*) AS devices,
        {rnd_avg('battery_pct')} AS average_battery_pct, {count_if('battery_issue')} AS low_battery_devices
        FROM readings GROUP BY state, district, discom, battery_status""",
    "daily_consumption": f"""SELECT event_date, state, district, discom,
        {exact_sum('consumption_kwh')} AS total_consumption_kwh,
        {exact_avg('consumption_kwh')} AS average_consumption_kwh, {_METERS} AS meters
        FROM readings GROUP BY event_date, state, district, discom""",
    "monthly_consumption": f"""SELECT year, month, state, discom,
        {exact_sum('consumption_kwh')} AS total_consumption_kwh,
        {exact_avg('consumption_kwh')} AS average_consumption_kwh, {_METERS} AS meters
        FROM readings GROUP BY year, month, state, discom""",
    "geographic_health": f"""SELECT state, district, discom, health_status, COUNT(*) AS meter_readings,
        {_METERS} AS meters, {rnd_avg('voltage')} AS average_voltage, {rnd_avg('rssi')} AS average_rssi,
        {rnd_avg('battery_pct')} AS average_battery_pct
        FROM readings GROUP BY state, district, discom, health_status""",
    "firmware_distribution": f"""SELECT firmware_version, health_status, {_METERS} AS meters,
        {count_if('comm_issue')} AS communication_issues, {count_if('signal_issue')} AS signal_issues,
        {count_if('voltage_issue')} AS voltage_issues
        FROM readings GROUP BY firmware_version, health_status""",
    "top_consumers": f"""SELECT meter_id, state, district, discom, feeder_id,
        {exact_sum('consumption_kwh')} AS total_consumption_kwh, {exact_avg('voltage')} AS average_voltage,
        {exact_avg('current')} AS average_current, MAX(timestamp) AS last_seen_at
        FROM readings GROUP BY meter_id, state, district, discom, feeder_id""",
    "issue_mix": "\nUNION ALL\n".join(
        f"SELECT '{label}' AS issue_type, {count_if(flag)} AS issue_count FROM readings"
        for label, flag in (
            ("Voltage Issues", "voltage_issue"),
            ("Power Factor Issues", "power_factor_issue"),
            ("Communication Issues", "comm_issue"),
            ("Signal Issues", "signal_issue"),
            ("Battery Issues", "battery_issue"),
        )
    ),
    "state_health_summary": f"""SELECT state, {_METERS} AS total_meters, {_STATUS},
        {rnd("100.0::DOUBLE * COUNT_IF(health_status = 'Warning') / COUNT(*)")} AS warning_pct,
        {rnd("100.0::DOUBLE * COUNT_IF(health_status = 'Critical') / COUNT(*)")} AS critical_pct,
        {rnd_avg('rssi')} AS average_rssi, {rnd_avg('battery_pct')} AS average_battery_pct
        FROM readings GROUP BY state""",
    "feeder_risk": f"""SELECT feeder_id, state, district, discom, {_METERS} AS meters,
        {count_if("health_status = 'Critical'")} AS critical_meters,
        {count_if("health_status = 'Warning'")} AS warning_meters, {total('issue_count')} AS total_issues,
        {rnd_avg('rssi')} AS average_rssi, {rnd_avg('voltage')} AS average_voltage,
        {rnd(exact_sum('consumption_kwh'))} AS total_consumption_kwh
        FROM readings GROUP BY feeder_id, state, district, discom""",
    "battery_status_summary": f"""SELECT battery_status, {_METERS} AS meters,
        {rnd_avg('battery_pct')} AS average_battery_pct, {count_if('battery_issue')} AS low_battery_devices
        FROM readings GROUP BY battery_status""",
}


def view_cte(name: str) -> str:
    return f"{name} AS ({VIEW_SQL[name]})"
