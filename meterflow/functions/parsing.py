"""Column expressions that turn message text into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What to look for in a health log line, group 1 of each pattern.
LOG_PATTERNS = {
    "timestamp": r"(\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2})",
    "level": r"\[(INFO|WARN|ERROR|CRITICAL)\]",
    "device": r"(MTR-\d+)",
    "customer": r"(CUST-\d+)",
    "event": (
        "(HEALTH_CHECK_OK|HEALTH_CHECK_DEGRADED|BATTERY_LOW|VOLTAGE_ANOMALY|CONNECTIVITY_ISSUE"
        "|SENSOR_FAULT|CALIBRATION_DRIFT|MEMORY_WARNING|TEMPERATURE_HIGH|FIRMWARE_UPDATE_REQUIRED)"
    ),
    "status": r"status=(\w+)",
    "status_label": r"Status: (\w+)",
    "status_prose": r"status is (\w+)",
    "battery": r"battery=(\d+)",
    "voltage": r"voltage=([0-9.]+)",
    "temperature": r"temp=([0-9.]+)",
    "memory": r"memory=(\d+)",
    "memory_short": r"mem=(\d+)",
    "uptime": r"uptime=(\d+)",
    "uptime_short": r"up=(\d+)",
    "errors": r"errors=(\d+)",
    "errors_short": r"err_cnt=(\d+)",
}


def has_text(col: str | Column) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return col.isNotNull() & (col != "")


def log_field(line: Column, pattern: str) -> Column:
    """First match of a named pattern, NULL without one (Spark itself gives '')."""
    return F.nullif(F.regexp_extract(line, LOG_PATTERNS[pattern], 1), F.lit(""))


def first_log_field(line: Column, dtype: str, *patterns: str) -> Column:
    """First of several spellings of one field that is there and fits ``dtype``."""
    return F.coalesce(*[log_field(line, p).try_cast(dtype) for p in patterns])


def log_time(line: Column) -> Column:
    """The time written in a log line, NULL where there is none or it is impossible."""
    return F.regexp_replace(log_field(line, "timestamp"), r"\s+", " ").try_cast("timestamp")


# A date, T and a time of day, with an offset or none.
ISO_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?$"
NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def iso_time(text: Column) -> Column:
    """ISO-8601 text as an instant, NULL where it cannot be read or lacks the date or the time of day."""
    return F.when(text.rlike(ISO_TIME), text.try_cast("timestamp"))


def any_number(text: Column) -> Column:
    """Text as a number, infinite where it is too large; NULL for anything else."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def finite(value: Column) -> Column:
    return F.when(F.abs(value) < float("inf"), value)


def number(text: Column) -> Column:
    """Text as a finite number, NULL for anything else."""
    return finite(any_number(text))


def whole_number(text: Column) -> Column:
    """Text as a whole number; fractions are rounded, other text gives NULL."""
    whole = F.when(text.rlike(NUMBER), text.try_cast("bigint"))
    # An infinite number is no whole one either: the cast gives NULL.
    return F.coalesce(whole, F.round(any_number(text)).try_cast("bigint"))
