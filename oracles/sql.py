"""The same questions in plain SQL, independent of the Spark code."""

from __future__ import annotations

import re

E_DAY = "DATE '2024-01-20'"
E_INSTANT = "TIMESTAMP '2024-01-20 12:00:00'"
L_DAY = "DATE '1998-06-15'"
CUT = "TIMESTAMP '2024-01-16 00:00:00'"


def rounded(expr: str, digits: int) -> str:
    """Half-up rounding of a double after dropping its last, order-dependent bits."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def stable(sql: str, *cols: str) -> str:
    """``sql`` with the named sums and means cut to six digits."""
    if not cols:
        return sql
    replaced = ", ".join(f"{rounded(c, 6)} AS {c}" for c in cols)
    return f"SELECT * REPLACE ({replaced}) FROM ({sql}) AS s"


HEALTH = "CASE WHEN {n} = 0 THEN NULL ELSE " + rounded("CAST({ok} AS DOUBLE) / {n} * 100", 2) + " END"
DEVICE_STATE = (
    "CASE WHEN {w} > {n} * 0.1 THEN 'UNHEALTHY' WHEN {w} > 0 THEN 'DEGRADED' ELSE 'HEALTHY' END"
)
CUSTOMER_STATE = (
    "CASE WHEN {w} > {n} * 0.05 THEN 'ACTION_REQUIRED' WHEN {w} > 0 THEN 'MONITOR' ELSE 'NORMAL' END"
)
DEVICE_HEALTH = (
    HEALTH.format(ok="ok_count", n="reading_count")
    + " AS health_score_pct, "
    + DEVICE_STATE.format(w="warning_count", n="reading_count")
    + " AS device_health_status"
)
COARSER = """
    sum(total_energy_kwh) AS total_energy_kwh, avg(avg_voltage) AS avg_voltage,
    min(min_voltage) AS min_voltage, max(max_voltage) AS max_voltage,
    avg(avg_battery_pct) AS avg_battery_pct,
    CAST(sum(reading_count) AS BIGINT) AS reading_count,
    CAST(sum(warning_count) AS BIGINT) AS warning_count,
    CAST(sum(ok_count) AS BIGINT) AS ok_count"""
CUSTOMER = """
    sum(total_energy_kwh) AS {energy}, avg(avg_voltage) AS avg_voltage,
    min(min_voltage) AS min_voltage, max(max_voltage) AS max_voltage,
    avg(avg_battery_pct) AS avg_battery_pct, count(DISTINCT device_id) AS {devices},
    CAST(sum(reading_count) AS BIGINT) AS total_readings,
    CAST(sum(warning_count) AS BIGINT) AS total_warnings,
    CAST(sum(ok_count) AS BIGINT) AS total_ok, """ + rounded("avg(health_score_pct)", 2) + """ AS avg_device_health_pct"""

# Month to date of a customer: output, aggregate.
_OF_MONTH = {
    "mtd_total_energy_kwh": "sum(daily_total_energy_kwh)",
    "mtd_avg_voltage": rounded("avg(avg_voltage)", 2),
    "mtd_min_voltage": "min(min_voltage)",
    "mtd_max_voltage": "max(max_voltage)",
    "mtd_avg_battery_pct": rounded("avg(avg_battery_pct)", 1),
    "max_active_devices": "max(active_devices)",
    "mtd_total_readings": "CAST(sum(total_readings) AS BIGINT)",
    "mtd_total_warnings": "CAST(sum(total_warnings) AS BIGINT)",
    "mtd_total_ok": "CAST(sum(total_ok) AS BIGINT)",
    "days_with_data": "count(DISTINCT reading_date)",
    "avg_daily_energy_kwh": rounded("avg(daily_total_energy_kwh)", 2),
    "projected_monthly_energy_kwh": rounded("avg(daily_total_energy_kwh) * day(last_day({day}))", 2),
    "first_reading_date": "min(reading_date)",
    "last_reading_date": "max(reading_date)",
    "latest_day_energy_kwh":
        "sum(daily_total_energy_kwh) FILTER (reading_date = (SELECT max(reading_date) FROM {month}))",
}
MONTH_TO_DATE = ", ".join(f"{aggregate} AS {output}" for output, aggregate in _OF_MONTH.items())

READING = """
    'MTR-' || (10000 + user_id) AS device_id, 'CUST-' || (8000 + user_id % 5) AS customer_id,
    ts AS reading_timestamp, value AS energy_kwh, 220::DOUBLE + k * 0.2::DOUBLE AS voltage,
    CAST(60 + k % 41 AS BIGINT) AS battery_pct,
    CASE WHEN event_type = 'error' AND k % 10 < 3 THEN 'WARNING' ELSE 'OK' END AS status"""
FIRST_LOAD = "TIMESTAMP '2024-02-01 00:00:00' AS ingested_at"
SECOND_LOAD = "TIMESTAMP '2024-02-02 00:00:00' AS ingested_at"
ISO = "strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"


def _chain(p: str) -> dict[str, str]:
    """The marts over the readings named ``<p>_readings``."""
    return {
        f"{p}_clean": f"""
            SELECT * FROM {p}_readings
            QUALIFY row_number() OVER (
                PARTITION BY device_id, reading_timestamp
                ORDER BY ingested_at DESC, customer_id DESC, energy_kwh DESC NULLS LAST,
                         voltage DESC NULLS LAST, battery_pct DESC NULLS LAST, status DESC NULLS LAST) = 1""",
        f"{p}_hourly": f"""
            SELECT *, CAST(reading_hour AS DATE) AS reading_date,
                   CAST(hour(reading_hour) AS INTEGER) AS hour_of_day, {DEVICE_HEALTH}
            FROM (SELECT device_id, customer_id, date_trunc('hour', reading_timestamp) AS reading_hour,
                         sum(energy_kwh) AS total_energy_kwh, avg(voltage) AS avg_voltage,
                         min(voltage) AS min_voltage, max(voltage) AS max_voltage,
                         avg(battery_pct) AS avg_battery_pct, count(*) AS reading_count,
                         count(*) FILTER (status = 'WARNING') AS warning_count,
                         count(*) FILTER (status = 'OK') AS ok_count
                  FROM {p}_clean GROUP BY ALL) AS h""",
        f"{p}_daily": f"""
            SELECT *, {DEVICE_HEALTH} FROM (
                SELECT device_id, customer_id, reading_date, {COARSER},
                       count(DISTINCT reading_hour) AS active_hours
                FROM {p}_hourly GROUP BY device_id, customer_id, reading_date) AS d""",
        f"{p}_monthly": f"""
            SELECT *, CAST(year(reading_month) AS INTEGER) AS year,
                   CAST(month(reading_month) AS INTEGER) AS month, {DEVICE_HEALTH} FROM (
                SELECT device_id, customer_id, CAST(date_trunc('month', reading_date) AS DATE) AS reading_month,
                       {COARSER}, count(DISTINCT reading_date) AS active_days
                FROM {p}_daily GROUP BY 1, 2, 3) AS m""",
        f"{p}_cust_daily": f"""
            SELECT *, {CUSTOMER_STATE.format(w="total_warnings", n="total_readings")} AS customer_alert_status
            FROM (SELECT customer_id, reading_date,
                         {CUSTOMER.format(energy="daily_total_energy_kwh", devices="active_devices")}
                  FROM {p}_daily GROUP BY 1, 2) AS c""",
        f"{p}_cust_monthly": f"""
            SELECT *, CAST(year(reading_month) AS INTEGER) AS year,
                   CAST(month(reading_month) AS INTEGER) AS month,
                   {CUSTOMER_STATE.format(w="total_warnings", n="total_readings")} AS customer_alert_status
            FROM (SELECT customer_id, reading_month,
                         {CUSTOMER.format(energy="monthly_total_energy_kwh", devices="total_devices")},
                         {rounded("avg(active_days)", 1)} AS avg_device_active_days
                  FROM {p}_monthly GROUP BY 1, 2) AS c""",
        f"{p}_month": f"""
            SELECT * FROM {p}_cust_daily
            WHERE date_trunc('month', reading_date) = date_trunc('month', {E_DAY if p != "l" else L_DAY})""",
        f"{p}_mtd": f"""
            SELECT *, CAST(date_trunc('month', {{day}}) AS DATE) AS current_month,
                   CAST(year({{day}}) AS INTEGER) AS year, CAST(month({{day}}) AS INTEGER) AS month,
                   {HEALTH.format(ok="mtd_total_ok", n="mtd_total_readings")} AS mtd_health_score_pct,
                   {CUSTOMER_STATE.format(w="mtd_total_warnings", n="mtd_total_readings")} AS mtd_alert_status
            FROM (SELECT customer_id, {MONTH_TO_DATE} FROM {p}_month GROUP BY customer_id) AS m""".replace(
            "{day}", E_DAY if p != "l" else L_DAY
        ).replace("{month}", f"{p}_month"),
    }


# What to look for in a log line, group 1 of each pattern.
PATTERNS = {
    "written": r"(\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2})",
    "level": r"\[(INFO|WARN|ERROR|CRITICAL)\]",
    "dev": r"(MTR-\d+)",
    "cust": r"(CUST-\d+)",
    "event": "(HEALTH_CHECK_OK|HEALTH_CHECK_DEGRADED|BATTERY_LOW|VOLTAGE_ANOMALY|CONNECTIVITY_ISSUE|SENSOR_FAULT"
    "|CALIBRATION_DRIFT|MEMORY_WARNING|TEMPERATURE_HIGH|FIRMWARE_UPDATE_REQUIRED)",
    "s1": r"status=(\w+)",
    "s2": r"Status: (\w+)",
    "s3": r"status is (\w+)",
    "bat": r"battery=(\d+)",
    "volt": r"voltage=([0-9.]+)",
    "temp": r"temp=([0-9.]+)",
    "m1": r"memory=(\d+)",
    "m2": r"mem=(\d+)",
    "u1": r"uptime=(\d+)",
    "u2": r"up=(\d+)",
    "e1": r"errors=(\d+)",
    "e2": r"err_cnt=(\d+)",
}
_TYPES = {"bat": "INTEGER", "volt": "DOUBLE", "temp": "DOUBLE", "m1": "INTEGER", "m2": "INTEGER",
          "u1": "INTEGER", "u2": "INTEGER", "e1": "INTEGER", "e2": "INTEGER"}


def _extract(name: str) -> str:
    found = f"nullif(regexp_extract(line, '{PATTERNS[name]}', 1), '')"
    return f"TRY_CAST({found} AS {_TYPES[name]})" if name in _TYPES else found


_FIELDS = ", ".join(f"{_extract(n)} AS {n}" for n in PATTERNS)

CTES: dict[str, str] = {
    "events_k": "SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "staged": f"""
        SELECT md5('MTR-' || (10000 + user_id) || '-' || {ISO.format(ts='ts')}) AS telemetry_id,
               {READING}, {FIRST_LOAD}, event_type FROM events_k""",
    "e_readings": f"""
        SELECT {READING}, {FIRST_LOAD} FROM events_k
        UNION ALL SELECT {READING}, {SECOND_LOAD} FROM events_k WHERE event_type = 'signup'""",
    "l_readings": f"""
        SELECT 'MTR-' || (10000 + l_suppkey) AS device_id, 'CUST-' || (8000 + l_suppkey // 2) AS customer_id,
               l_shipdate AS reading_timestamp, l_quantity AS energy_kwh,
               220::DOUBLE + (l_partkey % 100) * 0.2::DOUBLE AS voltage, 60 + l_partkey % 41 AS battery_pct,
               CASE WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN 'WARNING' ELSE 'OK' END AS status,
               {FIRST_LOAD} FROM lineitem""",
    # messages the staging step accepts, straight from the fields they were made of
    "accepted": f"""
        SELECT * FROM staged WHERE battery_pct IN (66, 67) OR battery_pct > 79""",
    # every message with what becomes of it, and whether the first load has it
    "sent_messages": f"""
        SELECT *, battery_pct IN (61, 68) AS blank, battery_pct IN (66, 67) OR battery_pct > 79 AS fine,
               reading_timestamp < {CUT} AS early FROM staged""",
    "m_readings": "SELECT * EXCLUDE (telemetry_id, event_type) FROM accepted",
    "device_master": """
        SELECT 'MTR-' || (10000 + c_custkey) AS device_id, 'CUST-' || (8000 + c_nationkey % 7) AS customer_id,
               c_mktsegment AS device_model, c_name AS location,
               CASE WHEN c_acctbal < 0 THEN 'INACTIVE' WHEN c_acctbal < 9000 THEN 'ACTIVE' END AS device_status
        FROM customer""",
    "customer_master": """
        SELECT 'CUST-' || (8000 + r_regionkey) AS customer_id, r_name AS customer_name,
               CASE WHEN r_regionkey < 4 THEN 'ACTIVE' END AS account_status FROM region""",
    "log_lines": """
        SELECT ts, CASE event_type
            WHEN 'click' THEN written || ' [INFO] ' || dev || ' ' || cust || ' HEALTH_CHECK_OK status=GOOD battery=' || k
                || ' voltage=' || v || ' temp=41.5 memory=' || k || ' uptime=' || k || ' errors=0'
            WHEN 'view' THEN '[WARN] ' || written || ' ' || dev || ' ' || cust || ' MEMORY_WARNING Status: DEGRADED mem='
                || k || ' up=300 err_cnt=' || k
            WHEN 'error' THEN written || ' [ERROR] Meter ' || dev || ' of ' || cust
                || ' reported SENSOR_FAULT, status is FAULTY voltage=' || v || '. battery=99999999' || k
                || ' temp=-5.0 backup=' || k
            WHEN 'purchase' THEN '[CRITICAL] ' || dev || ' BATTERY_LOW battery=' || k
            ELSE written || ' [INFO] no meter named, battery=' || k END AS line
        FROM (SELECT ts, event_type, k, 'MTR-' || (10000 + user_id) AS dev, 'CUST-' || (8000 + user_id % 5) AS cust,
                     strftime(ts, '%Y-%m-%d %H:%M:%S') AS written, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS v
              FROM events_k) AS f""",
    "log_fields": f"SELECT ts, line, {_FIELDS} FROM log_lines",
    "logs": """
        SELECT md5(dev || '-' || strftime(log_timestamp, '%Y-%m-%d %H:%M:%S.%f') || '-' || line) AS log_id,
               log_timestamp, level AS log_level, dev AS device_id, cust AS customer_id, event AS health_event,
               coalesce(s1, s2, s3, 'UNKNOWN') AS health_status, bat AS battery_pct, volt AS voltage_v,
               temp AS temperature_c, coalesce(m1, m2) AS memory_usage_pct, coalesce(u1, u2) AS uptime_hours,
               coalesce(e1, e2, 0) AS error_count, line AS raw_log_message,
               TIMESTAMP '2024-02-01 00:00:00' AS processed_at
        FROM (SELECT *, coalesce(CAST(written AS TIMESTAMP), ts) AS log_timestamp FROM log_fields) AS f
        WHERE dev IS NOT NULL""",
    **_chain("e"),
    **_chain("l"),
    **_chain("m"),
}


def query(sql: str) -> str:
    """``sql`` with a WITH clause holding the named parts it uses, directly or not."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[a-z_]+\b", text)):
            if name in CTES and name not in order:
                visit(CTES[name])
                order.append(name)

    visit(sql)
    parts = ",\n".join(f"{n} AS ({CTES[n]})" for n in order)
    return f"WITH {parts}\n{sql}" if parts else sql
