"""Column lists of every source, staging table and mart, in output order."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(), "DOUBLE": T.DoubleType(), "BIGINT": T.LongType(), "INT": T.IntegerType(),
    "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
    "DECIMAL(10,8)": T.DecimalType(10, 8), "DECIMAL(11,8)": T.DecimalType(11, 8),
}


def _schema(columns: str) -> T.StructType:
    """Columns as "name TYPE, name TYPE"; needs no running session."""
    pairs = (c.split(" ", 1) for c in re.split(r",\s*(?=[a-z_])", columns))
    return T.StructType([T.StructField(name, _TYPES[dtype]) for name, dtype in pairs])


# Rows of a message topic: key, text and broker time.
TOPIC = _schema("_key STRING, _message STRING, _timestamp TIMESTAMP")

# The JSON message. Leaves are read as text so that a wrongly typed value can
# be told apart from a missing one.
TELEMETRY_JSON = T.StructType(
    [
        *_schema("device_id STRING, customer_id STRING, timestamp STRING"),
        T.StructField("metrics", _schema("energy_kwh STRING, voltage STRING, battery_pct STRING")),
        *_schema("status STRING"),
    ]
)

# Messages of either topic that give no row, with the reason.
REJECTS = _schema(
    "reject_id STRING, topic STRING, _key STRING, _message STRING, _timestamp TIMESTAMP,"
    " reject_reason STRING, rejected_at TIMESTAMP"
)

# How far each load has read a topic: per partition the offsets, per file its messages.
LEDGER = _schema(
    "load_id STRING, topic STRING, split STRING, start_offset BIGINT, end_offset BIGINT,"
    " messages BIGINT, loaded_at TIMESTAMP"
)

# What became of the messages of each load.
LOAD_COUNTS = _schema(
    "load_id STRING, topic STRING, messages BIGINT, blank BIGINT, rejected BIGINT, lost BIGINT,"
    " copies BIGINT, staged BIGINT, loaded_at TIMESTAMP"
)

# Device hours whose marts are to be brought up to date; without a device the whole date, without a date everything.
PENDING = _schema("device_id STRING, reading_hour TIMESTAMP, reading_date DATE, note STRING")

STG_TELEMETRY = _schema(
    "telemetry_id STRING, device_id STRING, customer_id STRING, reading_timestamp TIMESTAMP,"
    " energy_kwh DOUBLE, voltage DOUBLE, battery_pct BIGINT, status STRING, ingested_at TIMESTAMP,"
    " sent_at TIMESTAMP"
)

# Readings that came behind their stream's watermark, by the batch that met them.
LATE_READINGS = T.StructType([*STG_TELEMETRY.fields, T.StructField("batch", T.LongType())])

STG_HEALTH_LOGS = _schema(
    "log_id STRING, log_timestamp TIMESTAMP, log_level STRING, device_id STRING, customer_id STRING,"
    " health_event STRING, health_status STRING, battery_pct INT, voltage_v DOUBLE,"
    " temperature_c DOUBLE, memory_usage_pct INT, uptime_hours INT, error_count INT,"
    " raw_log_message STRING, processed_at TIMESTAMP"
)

_DEVICE_MEASURES = (
    " total_energy_kwh DOUBLE, avg_voltage DOUBLE, min_voltage DOUBLE, max_voltage DOUBLE,"
    " avg_battery_pct DOUBLE, reading_count BIGINT, warning_count BIGINT, ok_count BIGINT,"
)

DEVICE_HOURLY = _schema(
    "device_id STRING, customer_id STRING, reading_hour TIMESTAMP, reading_date DATE, hour_of_day INT,"
    + _DEVICE_MEASURES
    + " health_score_pct DOUBLE, device_health_status STRING"
)

DEVICE_DAILY = _schema(
    "device_id STRING, customer_id STRING, reading_date DATE,"
    + _DEVICE_MEASURES
    + " active_hours BIGINT, health_score_pct DOUBLE, device_health_status STRING"
)

DEVICE_MONTHLY = _schema(
    "device_id STRING, customer_id STRING, reading_month DATE, year INT, month INT,"
    + _DEVICE_MEASURES
    + " active_days BIGINT, health_score_pct DOUBLE, device_health_status STRING"
)

CUSTOMER_DAILY = _schema(
    "customer_id STRING, reading_date DATE, daily_total_energy_kwh DOUBLE, avg_voltage DOUBLE,"
    " min_voltage DOUBLE, max_voltage DOUBLE, avg_battery_pct DOUBLE, active_devices BIGINT,"
    " total_readings BIGINT, total_warnings BIGINT, total_ok BIGINT, avg_device_health_pct DOUBLE,"
    " customer_alert_status STRING"
)

CUSTOMER_MONTHLY = _schema(
    "customer_id STRING, reading_month DATE, year INT, month INT, monthly_total_energy_kwh DOUBLE,"
    " avg_voltage DOUBLE, min_voltage DOUBLE, max_voltage DOUBLE, avg_battery_pct DOUBLE,"
    " total_devices BIGINT, total_readings BIGINT, total_warnings BIGINT, total_ok BIGINT,"
    " avg_device_active_days DOUBLE, avg_device_health_pct DOUBLE, customer_alert_status STRING"
)

CUSTOMER_MTD = _schema(
    "customer_id STRING, current_month DATE, year INT, month INT, mtd_total_energy_kwh DOUBLE,"
    " mtd_avg_voltage DOUBLE, mtd_min_voltage DOUBLE, mtd_max_voltage DOUBLE,"
    " mtd_avg_battery_pct DOUBLE, max_active_devices BIGINT, mtd_total_readings BIGINT,"
    " mtd_total_warnings BIGINT, mtd_total_ok BIGINT, days_with_data BIGINT,"
    " avg_daily_energy_kwh DOUBLE, projected_monthly_energy_kwh DOUBLE, first_reading_date DATE,"
    " last_reading_date DATE, latest_day_energy_kwh DOUBLE, mtd_health_score_pct DOUBLE,"
    " mtd_alert_status STRING"
)

# States of the grains: what their means and totals are made of, and how many finer rows there are.
_DEVICE_STATE = (
    " sum_total_energy_kwh DOUBLE, sum_reading_count BIGINT, sum_warning_count BIGINT, sum_ok_count BIGINT,"
    " sum_avg_voltage DOUBLE, sum_avg_battery_pct DOUBLE, n_total_energy_kwh BIGINT, n_reading_count BIGINT,"
    " n_warning_count BIGINT, n_ok_count BIGINT, n_avg_voltage BIGINT, n_avg_battery_pct BIGINT,"
    " min_voltage DOUBLE, max_voltage DOUBLE, _rows BIGINT"
)


def _customer_state(energy: str, more: str = "") -> str:
    sums = f"sum_{energy} DOUBLE, sum_total_readings BIGINT, sum_total_warnings BIGINT, sum_total_ok BIGINT,"
    means = " sum_avg_voltage DOUBLE, sum_avg_battery_pct DOUBLE, sum_avg_device_health_pct DOUBLE,"
    counted = [energy, "total_readings", "total_warnings", "total_ok", "avg_voltage", "avg_battery_pct"]
    counted += ["avg_device_health_pct", *([more] if more else [])]
    extra = f" sum_{more} BIGINT," if more else ""
    counts = "".join(f" n_{c} BIGINT," for c in counted)
    return sums + means + extra + counts + " min_voltage DOUBLE, max_voltage DOUBLE, _rows BIGINT"


DEVICE_DAILY_STATE = _schema("device_id STRING, customer_id STRING, reading_date DATE," + _DEVICE_STATE)
DEVICE_MONTHLY_STATE = _schema("device_id STRING, customer_id STRING, reading_month DATE," + _DEVICE_STATE)
CUSTOMER_DAILY_STATE = _schema(
    "customer_id STRING, reading_date DATE, " + _customer_state("daily_total_energy_kwh")
)
CUSTOMER_MONTHLY_STATE = _schema(
    "customer_id STRING, reading_month DATE, " + _customer_state("monthly_total_energy_kwh", "avg_device_active_days")
)

CUSTOMER_MASTER = _schema(
    "customer_id STRING, customer_name STRING, email STRING, phone STRING, address STRING,"
    " city STRING, state STRING, postal_code STRING, account_status STRING,"
    " created_at TIMESTAMP, updated_at TIMESTAMP"
)

DEVICE_MASTER = _schema(
    "device_id STRING, customer_id STRING, device_model STRING, firmware_version STRING,"
    " installation_date DATE, location STRING, latitude DECIMAL(10,8), longitude DECIMAL(11,8),"
    " device_status STRING, last_maintenance_date DATE, warranty_expiry_date DATE,"
    " created_at TIMESTAMP, updated_at TIMESTAMP"
)

# What the master tables promise: one row per key, no NULL where required, and
# every device's customer known.
MASTER_KEYS = {"customer_master": "customer_id", "device_master": "device_id"}
MASTER_REQUIRED = {
    "customer_master": ["customer_id", "customer_name"],
    "device_master": ["device_id", "customer_id"],
}
MASTER_REFERENCES = {"device_master": ("customer_id", "customer_master")}

# What a NULL becomes on insert. Times of creation and change
# become the time of the insert.
MASTER_DEFAULTS = {
    "customer_master": {"account_status": "ACTIVE"},
    "device_master": {"device_status": "ACTIVE"},
}
MASTER_TIMES = ["created_at", "updated_at"]

# The longest text each master column may hold.
MASTER_TEXT_LENGTHS = {
    "customer_master": {
        "customer_id": 20, "customer_name": 100, "email": 100, "phone": 20, "address": 200,
        "city": 50, "state": 50, "postal_code": 10, "account_status": 20,
    },
    "device_master": {
        "device_id": 20, "customer_id": 20, "device_model": 50, "firmware_version": 20,
        "location": 100, "device_status": 20,
    },
}
