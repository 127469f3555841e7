"""SQL text shared by all oracle queries.

``readings`` derives the processed table from the test tables with plain SQL,
independently of the Spark code. Double sums go through DECIMAL so that both
engines give the same digits.
"""

RAW = """
base AS (
  SELECT event_id AS i, user_id AS u, ts, value, 0 AS dup FROM events
  UNION ALL
  SELECT event_id, user_id, ts, value, 1 FROM events WHERE event_id % 50 = 0
),
raw AS (
  SELECT
    CASE WHEN i % 401 <> 400 THEN 'MTR-' || lpad(CAST(u AS VARCHAR), 6, '0') END AS meter_id,
    CASE WHEN i % 503 <> 502 THEN ts END AS timestamp,
    CASE WHEN i % 97 <> 96 THEN (1980 + (i * 37) % 560) / 10 END AS voltage,
    ((i * 53) % 1435) / 100 AS current,
    (85 + (i * 7) % 11) / 100 AS power_factor,
    CASE WHEN i % 89 <> 88 THEN ts - to_seconds((i * 7919) % 11400) END AS last_communication_time,
    CASE WHEN 5 + (i * 13) % 96 >= 50 THEN 'Good' WHEN 5 + (i * 13) % 96 >= 20 THEN 'Medium' ELSE 'Low' END AS battery_status,
    CAST(5 + (i * 13) % 96 AS INTEGER) AS battery_pct,
    CAST(-115 + (i * 17) % 71 AS DOUBLE) AS rssi,
    CASE WHEN u % 11 <> 10 THEN 'FW-2.' || CAST(u % 5 AS VARCHAR) || '.0' END AS firmware_version,
    r_name AS state,
    n_name AS district,
    'DISCOM-' || CAST(c_nationkey % 10 AS VARCHAR) AS discom,
    'FDR-' || lpad(CAST(u % 40 AS VARCHAR), 3, '0') AS feeder_id,
    value + dup AS consumption_kwh,
    (i * 37) % 560 >= 530 AS voltage_issue,
    (i * 7) % 11 = 0 AS power_factor_issue,
    (i * 7919) % 11400 > 10800 AS comm_issue,
    CASE WHEN i % 79 <> 78 THEN (i * 17) % 71 < 25 END AS signal_issue,
    (i * 13) % 96 < 15 AS battery_issue,
    CAST(NULL AS VARCHAR) AS health_status,
    i AS event_id,
    dup
  FROM base
  JOIN customer ON c_custkey = u
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
)"""

FILLED = """
filled AS (
  SELECT
    coalesce(meter_id, 'UNKNOWN') AS meter_id,
    timestamp,
    coalesce(voltage, 0.0) AS voltage,
    coalesce(current, 0.0) AS current,
    coalesce(power_factor, 0.0) AS power_factor,
    last_communication_time,
    coalesce(battery_status, 'Unknown') AS battery_status,
    coalesce(battery_pct, 0) AS battery_pct,
    coalesce(rssi, 0.0) AS rssi,
    coalesce(firmware_version, 'Unknown') AS firmware_version,
    coalesce(state, 'Unknown') AS state,
    coalesce(district, 'Unknown') AS district,
    coalesce(discom, 'Unknown') AS discom,
    coalesce(feeder_id, 'Unknown') AS feeder_id,
    coalesce(consumption_kwh, 0.0) AS consumption_kwh,
    coalesce(voltage_issue, false) AS voltage_issue,
    coalesce(power_factor_issue, false) AS power_factor_issue,
    coalesce(comm_issue, false) AS comm_issue,
    coalesce(signal_issue, false) AS signal_issue,
    coalesce(battery_issue, false) AS battery_issue,
    event_id,
    dup
  FROM raw
)"""

ELAPSED = "date_diff('second', last_communication_time, timestamp) / 60.0"
BOUNDARY = "CAST(date_diff('minute', last_communication_time, timestamp) AS DOUBLE)"


def _readings(lag: str, order: str) -> str:
    return f"""
kept AS (
  SELECT * FROM filled
  WHERE meter_id IS NOT NULL AND timestamp IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY meter_id, timestamp ORDER BY {order}) = 1
),
counted AS (
  SELECT *,
    CAST(voltage_issue AS INTEGER) + CAST(power_factor_issue AS INTEGER) + CAST(comm_issue AS INTEGER)
      + CAST(signal_issue AS INTEGER) + CAST(battery_issue AS INTEGER) AS issue_count
  FROM kept
),
readings AS (
  SELECT
    meter_id, timestamp, CAST(timestamp AS DATE) AS event_date, voltage, current, power_factor,
    last_communication_time, CAST({lag} AS DOUBLE) AS communication_lag_minutes, battery_status, battery_pct, rssi,
    firmware_version, state, district, discom, feeder_id, consumption_kwh, voltage_issue,
    power_factor_issue, comm_issue, signal_issue, battery_issue, issue_count,
    CASE WHEN issue_count >= 3 THEN 'Critical' WHEN issue_count >= 1 THEN 'Warning' ELSE 'Healthy' END AS health_status,
    CAST(year(timestamp) AS INTEGER) AS year, strftime(timestamp, '%m') AS month, strftime(timestamp, '%d') AS day
  FROM counted
)"""


def over_raw(query: str) -> str:
    return f"WITH {RAW}\n{query}"


def over_filled(query: str) -> str:
    return f"WITH {RAW},{FILLED}\n{query}"


def over_readings(query: str, *extra: str, lag: str = ELAPSED, order: str = "event_id, dup") -> str:
    """``query`` may use ``readings`` and the CTEs in ``extra``, each ``name AS (...)``."""
    parts = ",\n".join([RAW, FILLED, _readings(lag, order), *extra])
    return f"WITH {parts}\n{query}"


def rnd(expression: str, digits: int = 2) -> str:
    """Half-up rounding on the shortest decimal form, which is how Spark rounds a double."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def exact_sum(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,6))) AS DOUBLE)"


def exact_avg(column: str) -> str:
    return f"({exact_sum(column)} / COUNT({column}))"


def rnd_avg(column: str, digits: int = 2) -> str:
    return rnd(exact_avg(column), digits)


def count_if(condition: str) -> str:
    return f"CAST(COUNT_IF({condition}) AS BIGINT)"


def total(column: str) -> str:
    """Sum of an integer column as BIGINT."""
    return f"CAST(SUM({column}) AS BIGINT)"
