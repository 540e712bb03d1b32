"""Device and customer rollups: hour, day, month and month to date.

Each grain is built from the finer one. Averages are means of the finer means,
not weighted by readings. Counts of distinct hours, days and devices are plain
counts, because the finer grain holds each of them once per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow import schemas
from meterflow.functions import calendar as C
from meterflow.functions import rules as R
from meterflow.operators.dedup import dedup_latest
from meterflow.operators.lookup import tasks_by_size

# The time comes first: it tells rows apart by a fixed-width sort prefix, where
# device ids share theirs.
READING_KEY = ["reading_timestamp", "device_id"]


def latest_readings(readings: DataFrame) -> DataFrame:
    """One reading per device and time: the one ingested last and, of one load, sent last."""
    sent = ["sent_at"] if "sent_at" in readings.columns else []
    latest = dedup_latest(
        readings.select(
            "device_id", "customer_id", "reading_timestamp", "energy_kwh", "voltage",
            "battery_pct", "status", "ingested_at", *sent,
        ),
        READING_KEY,
        ["ingested_at", *sent],
    )
    return latest.drop(*sent)


def reading_measures() -> list[Column]:
    """Measures of a device hour from its readings."""
    return [
        F.sum("energy_kwh").alias("total_energy_kwh"),
        F.avg("voltage").alias("avg_voltage"),
        F.min("voltage").alias("min_voltage"),
        F.max("voltage").alias("max_voltage"),
        F.avg("battery_pct").alias("avg_battery_pct"),
        F.count(F.lit(1)).alias("reading_count"),
        R.count_where(F.col("status") == "WARNING").alias("warning_count"),
        R.count_where(F.col("status") == "OK").alias("ok_count"),
    ]


def coarser_measures() -> list[Column]:
    """Measures of a device grain from those of the finer grain."""
    return [
        F.sum("total_energy_kwh").alias("total_energy_kwh"),
        F.avg("avg_voltage").alias("avg_voltage"),
        F.min("min_voltage").alias("min_voltage"),
        F.max("max_voltage").alias("max_voltage"),
        F.avg("avg_battery_pct").alias("avg_battery_pct"),
        F.sum("reading_count").alias("reading_count"),
        F.sum("warning_count").alias("warning_count"),
        F.sum("ok_count").alias("ok_count"),
    ]


def _customer_measures(energy: str, devices: str) -> list[Column]:
    return [
        F.sum("total_energy_kwh").alias(energy),
        F.avg("avg_voltage").alias("avg_voltage"),
        F.min("min_voltage").alias("min_voltage"),
        F.max("max_voltage").alias("max_voltage"),
        F.avg("avg_battery_pct").alias("avg_battery_pct"),
        F.count("device_id").alias(devices),
        F.sum("reading_count").alias("total_readings"),
        F.sum("warning_count").alias("total_warnings"),
        F.sum("ok_count").alias("total_ok"),
        F.avg("health_score_pct").alias("avg_device_health_pct"),
    ]


def with_device_health(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "health_score_pct": R.health_score("ok_count", "reading_count"),
            "device_health_status": R.device_health_status("warning_count", "reading_count"),
        }
    )


def with_hour_columns(hours: DataFrame) -> DataFrame:
    return with_device_health(
        hours.withColumns({"reading_date": F.to_date("reading_hour"), "hour_of_day": F.hour("reading_hour")})
    )


def device_hourly(readings: DataFrame, unique: bool = False) -> DataFrame:
    """Device hours from readings.

    Readings are first cut to the latest of each device and time; pass
    ``unique`` where the table is known to hold each once, which saves that
    shuffle. The two steps shuffle on different keys on purpose: grouping raw
    rows by device and hour at once would bring all copies of one reading, and
    all readings of one busy device hour, to a single task.
    """
    readings = readings if unique else latest_readings(readings)
    hours = readings.groupBy(
        "device_id",
        "customer_id",
        F.date_trunc("hour", "reading_timestamp").alias("reading_hour"),
    ).agg(*reading_measures())
    return with_hour_columns(hours).select(*schemas.DEVICE_HOURLY.names)


def by_device(hours: DataFrame) -> DataFrame:
    """Hours with those of one device and customer in one task: the days and months made of them need no further shuffle.

    For a chain of grains in one job. Unlike readings, hours are few however busy a device is, at most 8,784
    a year, so a device that sends a third of all readings is a small group by now. A large input gets tasks by
    its size, as all its days, months and customer months are held in memory side by side.
    """
    tasks = tasks_by_size(hours)
    return hours.repartition(*([] if tasks is None else [tasks]), "device_id", "customer_id")


def device_daily(hourly: DataFrame) -> DataFrame:
    days = hourly.groupBy("device_id", "customer_id", "reading_date").agg(
        *coarser_measures(), F.count("reading_hour").alias("active_hours")
    )
    return with_device_health(days).select(*schemas.DEVICE_DAILY.names)


def device_monthly(daily: DataFrame) -> DataFrame:
    months = daily.groupBy(
        "device_id", "customer_id", C.month_start(F.col("reading_date")).alias("reading_month")
    ).agg(*coarser_measures(), F.count("reading_date").alias("active_days"))
    return with_device_health(
        months.withColumns({"year": F.year("reading_month"), "month": F.month("reading_month")})
    ).select(*schemas.DEVICE_MONTHLY.names)


def customer_daily(daily: DataFrame) -> DataFrame:
    """Customer days from device days."""
    days = daily.groupBy("customer_id", "reading_date").agg(
        *_customer_measures("daily_total_energy_kwh", "active_devices")
    )
    return finished_customer_day(days).select(*schemas.CUSTOMER_DAILY.names)


def finished_customer_day(days: DataFrame) -> DataFrame:
    return days.withColumns(
        {
            "avg_device_health_pct": R.round_average("avg_device_health_pct", 2),
            "customer_alert_status": R.customer_alert_status("total_warnings", "total_readings"),
        }
    )


def customer_monthly(monthly: DataFrame) -> DataFrame:
    """Customer months from device months."""
    months = monthly.groupBy("customer_id", "reading_month").agg(
        *_customer_measures("monthly_total_energy_kwh", "total_devices"),
        F.avg("active_days").alias("avg_device_active_days"),
    )
    return finished_customer_month(months).select(*schemas.CUSTOMER_MONTHLY.names)


def finished_customer_month(months: DataFrame) -> DataFrame:
    return months.withColumns(
        {
            "year": F.year("reading_month"),
            "month": F.month("reading_month"),
            "avg_device_active_days": R.round_average("avg_device_active_days", 1),
            "avg_device_health_pct": R.round_average("avg_device_health_pct", 2),
            "customer_alert_status": R.customer_alert_status("total_warnings", "total_readings"),
        }
    )


def latest_day(dates: DataFrame, as_of: C.AsOf = None, up_to_as_of: bool = False) -> DataFrame:
    """One row: the last ``reading_date`` with data in the month of ``as_of``."""
    return _month_to_date(dates, as_of, up_to_as_of).agg(F.max("reading_date").alias("latest_day"))


def _month_to_date(df: DataFrame, as_of: C.AsOf, up_to_as_of: bool) -> DataFrame:
    df = df.filter(C.in_month_of("reading_date", as_of))
    return df.filter(F.col("reading_date") <= C.as_date(as_of)) if up_to_as_of else df


def customer_usage_mtd(
    daily: DataFrame,
    as_of: C.AsOf = None,
    up_to_as_of: bool = False,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Customers in the month of ``as_of``, with a projection to its end.

    All days of that month count, also those after ``as_of``, unless
    ``up_to_as_of`` is set. ``dates`` is any frame with the same reading dates
    that is cheaper to scan for the last day than ``daily``.
    """
    month = _month_to_date(daily, as_of, up_to_as_of)
    last = latest_day(daily if dates is None else dates, as_of, up_to_as_of).scalar()
    totals = month.groupBy("customer_id").agg(
        F.sum("daily_total_energy_kwh").alias("mtd_total_energy_kwh"),
        F.avg("avg_voltage").alias("mtd_avg_voltage"),
        F.min("min_voltage").alias("mtd_min_voltage"),
        F.max("max_voltage").alias("mtd_max_voltage"),
        F.avg("avg_battery_pct").alias("mtd_avg_battery_pct"),
        F.max("active_devices").alias("max_active_devices"),
        F.sum("total_readings").alias("mtd_total_readings"),
        F.sum("total_warnings").alias("mtd_total_warnings"),
        F.sum("total_ok").alias("mtd_total_ok"),
        F.count("reading_date").alias("days_with_data"),
        F.avg("daily_total_energy_kwh").alias("avg_daily"),
        F.min("reading_date").alias("first_reading_date"),
        F.max("reading_date").alias("last_reading_date"),
        F.max(F.when(F.col("reading_date") == last, F.col("daily_total_energy_kwh"))).alias(
            "latest_day_energy_kwh"
        ),
    )
    return finished_mtd(totals, as_of).select(*schemas.CUSTOMER_MTD.names)


def finished_mtd(totals: DataFrame, as_of: C.AsOf = None) -> DataFrame:
    """What is worked out from a customer's sums and means of the month."""
    today = C.as_date(as_of)
    return totals.withColumns(
        {
            "current_month": C.month_start(today),
            "year": F.year(today),
            "month": F.month(today),
            "mtd_avg_voltage": R.round_average("mtd_avg_voltage", 2),
            "mtd_avg_battery_pct": R.round_average("mtd_avg_battery_pct", 1),
            "avg_daily_energy_kwh": R.round_average("avg_daily", 2),
            "projected_monthly_energy_kwh": R.projected_month_total("avg_daily", C.days_in_month(today)),
            "mtd_health_score_pct": R.health_score("mtd_total_ok", "mtd_total_readings"),
            "mtd_alert_status": R.customer_alert_status("mtd_total_warnings", "mtd_total_readings"),
        }
    )


def with_latest_day(mtd: DataFrame, daily: DataFrame, as_of: C.AsOf = None, up_to_as_of: bool = False) -> DataFrame:
    """Month-to-date rows with the energy of the last day that any customer has data for."""
    month = _month_to_date(daily, as_of, up_to_as_of)
    last = latest_day(daily, as_of, up_to_as_of).scalar()
    energy = month.filter(F.col("reading_date") == last).select(
        F.col("customer_id").alias("_customer"), F.col("daily_total_energy_kwh").alias("latest_day_energy_kwh")
    )
    joined = mtd.join(energy, F.col("customer_id").eqNullSafe(F.col("_customer")), "left")
    return joined.select(*schemas.CUSTOMER_MTD.names)
