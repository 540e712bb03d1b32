"""The standard questions, asked of the marts.

``as_of`` is the reporting day (or instant); None means now. Filters are ranges
on the bare date columns, so a mart stored by date is read only where needed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions import calendar as C
from meterflow.functions import rules as R
from meterflow.operators.enrich import with_master_customer

# The time column and the id each mart is listed by.
LISTING_ORDER = {
    "device_hourly_metrics": ("reading_hour", "device_id"),
    "device_daily_metrics": ("reading_date", "device_id"),
    "device_monthly_metrics": ("reading_month", "device_id"),
    "customer_daily_usage_summary": ("reading_date", "customer_id"),
    "customer_monthly_usage_summary": ("reading_month", "customer_id"),
    "customer_usage_mtd_summary": (None, "customer_id"),
}


def listed(mart: DataFrame, name: str) -> DataFrame:
    """A mart in its usual order: newest first, then by id."""
    time_col, id_col = LISTING_ORDER[name]
    by_id = F.col(id_col).asc()
    return mart.orderBy(by_id) if time_col is None else mart.orderBy(F.col(time_col).desc(), by_id)


def current_rows(mart: DataFrame, name: str, as_of: C.AsOf = None) -> DataFrame:
    """Today's rows of a mart, this month's of a monthly one, raised alerts of month to date."""
    if name == "customer_usage_mtd_summary":
        return mart.filter(F.col("mtd_alert_status") != "NORMAL")
    if "monthly" in name:
        return mart.filter(F.col("reading_month") == C.month_start(C.as_date(as_of)))
    return mart.filter(C.on_day("reading_date", as_of))


# --------------------------------------------------------------------------
# energy


def energy_by_customer(customer_daily: DataFrame, as_of: C.AsOf = None) -> DataFrame:
    """Energy per customer on one day."""
    return (
        customer_daily.filter(C.on_day("reading_date", as_of))
        .groupBy("customer_id")
        .agg(F.sum("daily_total_energy_kwh").alias("total_energy_kwh"))
    )


def daily_trend(
    customer_daily: DataFrame, as_of: C.AsOf = None, days: int = 7, limit: int | None = 100
) -> DataFrame:
    """Customer days of the last days, newest first."""
    rows = customer_daily.filter(C.last_days("reading_date", as_of, days)).select(
        "customer_id",
        "reading_date",
        "daily_total_energy_kwh",
        "active_devices",
        "avg_device_health_pct",
        "customer_alert_status",
    )
    rows = rows.orderBy(F.col("reading_date").desc(), "customer_id")
    return rows if limit is None else rows.limit(limit)


def daily_energy_chart(customer_daily: DataFrame, as_of: C.AsOf = None, days: int = 7) -> DataFrame:
    """Energy per day and customer over the last days."""
    return (
        customer_daily.filter(C.last_days("reading_date", as_of, days))
        .groupBy("reading_date", "customer_id")
        .agg(F.sum("daily_total_energy_kwh").alias("total_energy_kwh"))
    )


def top_consumers(customer_monthly: DataFrame, as_of: C.AsOf = None, n: int = 10) -> DataFrame:
    """The customers using most energy in the month."""
    return (
        customer_monthly.filter(F.col("reading_month") == C.month_start(C.as_date(as_of)))
        .select("customer_id", "monthly_total_energy_kwh", "total_devices", "avg_device_health_pct")
        .orderBy(F.col("monthly_total_energy_kwh").desc(), "customer_id")
        .limit(n)
    )


def hourly_pattern(device_hourly: DataFrame, as_of: C.AsOf = None) -> DataFrame:
    """Mean energy per device and hour of day on one day."""
    return _hour_means(device_hourly.filter(C.on_day("reading_date", as_of)))


def hourly_pattern_recent(
    device_hourly: DataFrame, as_of: dt.datetime | None = None, hours: int = 24
) -> DataFrame:
    """Mean energy per device and hour of day over the last hours."""
    return _hour_means(device_hourly.filter(C.last_hours("reading_hour", as_of, hours)))


def _hour_means(rows: DataFrame) -> DataFrame:
    return rows.groupBy("device_id", "hour_of_day").agg(F.avg("total_energy_kwh").alias("avg_energy_kwh"))


def hourly_peak(device_hourly: DataFrame, as_of: C.AsOf = None, days: int = 7) -> DataFrame:
    """Mean and peak energy and mean voltage per device and hour of day."""
    return (
        device_hourly.filter(C.last_days("reading_date", as_of, days))
        .groupBy("device_id", "hour_of_day")
        .agg(
            F.avg("total_energy_kwh").alias("avg_energy"),
            F.max("total_energy_kwh").alias("peak_energy"),
            F.avg("avg_voltage").alias("avg_voltage"),
        )
        .orderBy("hour_of_day", "device_id")
    )


def device_months(device_monthly: DataFrame, as_of: C.AsOf = None, months: int = 3) -> DataFrame:
    """Energy per device and month over the last months."""
    return (
        device_monthly.filter(C.last_months("reading_month", as_of, months))
        .groupBy("device_id", "year", "month")
        .agg(F.sum("total_energy_kwh").alias("total_energy_kwh"))
    )


def monthly_comparison(
    device_monthly: DataFrame,
    devices: DataFrame,
    customers: DataFrame,
    as_of: C.AsOf = None,
    months: int = 3,
) -> DataFrame:
    """Device months of the last months with the owner from the master data."""
    recent = device_monthly.filter(C.last_months("reading_month", as_of, months))
    return (
        with_master_customer(recent, devices, customers)
        .select("device_id", "reading_month", "total_energy_kwh", "active_days", "health_score_pct", "customer_id")
        .orderBy(F.col("reading_month").desc(), F.col("total_energy_kwh").desc(), "device_id")
    )


def month_trend(customer_monthly: DataFrame) -> DataFrame:
    """Energy, readings and warnings of all customers, month by month."""
    return customer_monthly.groupBy("reading_month").agg(
        F.sum("monthly_total_energy_kwh").alias("total_energy_kwh"),
        F.sum("total_readings").alias("total_readings"),
        F.sum("total_warnings").alias("total_warnings"),
    )


def active_days(device_monthly: DataFrame, as_of: C.AsOf = None) -> DataFrame:
    """Days with data per device in the month."""
    return device_monthly.filter(F.col("reading_month") == C.month_start(C.as_date(as_of))).select(
        "device_id", "customer_id", "active_days"
    )


# --------------------------------------------------------------------------
# month to date


def mtd_vs_projected(customer_mtd: DataFrame) -> DataFrame:
    """Energy so far and projected to the month's end, all customers."""
    return customer_mtd.agg(
        F.sum("mtd_total_energy_kwh").alias("mtd_total_energy_kwh"),
        F.sum("projected_monthly_energy_kwh").alias("projected_monthly_energy_kwh"),
    )


MTD_COLUMNS = [
    "customer_id", "mtd_total_energy_kwh", "avg_daily_energy_kwh", "projected_monthly_energy_kwh",
    "days_with_data", "mtd_health_score_pct", "mtd_alert_status",
]


def mtd_listing(customer_mtd: DataFrame) -> DataFrame:
    """Month to date per customer, most energy first."""
    return customer_mtd.select(*MTD_COLUMNS).orderBy(F.col("mtd_total_energy_kwh").desc(), "customer_id")


def mtd_alerts(customer_mtd: DataFrame) -> DataFrame:
    """Customers with a raised alert and how much of the projection they have used."""
    share = R.percent_of("mtd_total_energy_kwh", "projected_monthly_energy_kwh")
    raised = customer_mtd.filter(F.col("mtd_alert_status") != "NORMAL")
    return raised.select(*MTD_COLUMNS, share.alias("pct_of_projected")).orderBy(
        F.col("mtd_total_energy_kwh").desc(), "customer_id"
    )


def over_budget(customer_mtd: DataFrame, budgets: DataFrame) -> DataFrame:
    """Customers whose projection exceeds their budget (``customer_id``, ``budget_kwh``)."""
    return (
        customer_mtd.select("customer_id", "mtd_total_energy_kwh", "projected_monthly_energy_kwh")
        .join(budgets.select("customer_id", "budget_kwh"), "customer_id")
        .filter(F.col("projected_monthly_energy_kwh") > F.col("budget_kwh"))
    )


# --------------------------------------------------------------------------
# health and alerts


def health_trend(device_daily: DataFrame, as_of: C.AsOf = None, days: int = 7) -> DataFrame:
    """Mean health score per day and device over the last days."""
    return (
        device_daily.filter(C.last_days("reading_date", as_of, days))
        .groupBy("reading_date", "device_id")
        .agg(F.avg("health_score_pct").alias("avg_health_score_pct"))
    )


def alert_distribution(
    customer_daily: DataFrame, as_of: C.AsOf = None, all_days: bool = False
) -> DataFrame:
    """Customers per alert state on one day, or customer days per state over all days."""
    rows = customer_daily if all_days else customer_daily.filter(C.on_day("reading_date", as_of))
    return rows.groupBy("customer_alert_status").agg(F.count(F.lit(1)).alias("row_count"))


def device_status_counts(device_daily: DataFrame, as_of: C.AsOf = None) -> DataFrame:
    """Devices per health state on one day."""
    return (
        device_daily.filter(C.on_day("reading_date", as_of))
        .groupBy("device_health_status")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def warning_devices(device_daily: DataFrame, as_of: C.AsOf = None) -> DataFrame:
    """Devices that are not healthy on one day, worst first."""
    return (
        device_daily.filter(C.on_day("reading_date", as_of))
        .filter(F.col("device_health_status") != "HEALTHY")
        .select(
            "device_id", "customer_id", "reading_count", "warning_count", "health_score_pct",
            "device_health_status",
        )
        .orderBy("health_score_pct", "device_id")
    )
