"""Business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Share of warnings above which a state is the worst one, as "one in N".
UNHEALTHY_ONE_IN = 10       # more than 10 % of a device's readings
ACTION_REQUIRED_ONE_IN = 20  # more than 5 % of a customer's readings


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_average(value: str | Column, digits: int) -> Column:
    """Round a mean or sum of doubles.

    Adding doubles in another order changes the last bits, which would flip
    values lying on a rounding boundary between two runs over the same rows.
    Dropping those bits first keeps the result the same on every run.
    """
    return F.round(F.round(_col(value), 9), digits)


def health_score(ok: str | Column, readings: str | Column) -> Column:
    """Share of OK readings in percent, two digits; NULL without readings."""
    share = _col(ok).cast("double") / F.nullif(_col(readings), F.lit(0))
    return F.round(share * 100, 2)


def device_health_status(warnings: str | Column, readings: str | Column) -> Column:
    """UNHEALTHY above 10 % warnings, DEGRADED with any, else HEALTHY."""
    warnings, readings = _col(warnings), _col(readings)
    return (
        F.when(warnings * UNHEALTHY_ONE_IN > readings, "UNHEALTHY")
        .when(warnings > 0, "DEGRADED")
        .otherwise("HEALTHY")
    )


def customer_alert_status(warnings: str | Column, readings: str | Column) -> Column:
    """ACTION_REQUIRED above 5 % warnings, MONITOR with any, else NORMAL."""
    warnings, readings = _col(warnings), _col(readings)
    return (
        F.when(warnings * ACTION_REQUIRED_ONE_IN > readings, "ACTION_REQUIRED")
        .when(warnings > 0, "MONITOR")
        .otherwise("NORMAL")
    )


def projected_month_total(avg_per_day: str | Column, days_in_month: Column) -> Column:
    """Whole-month estimate from the unrounded mean of the days that have data."""
    return round_average(_col(avg_per_day) * days_in_month, 2)


def percent_of(part: str | Column, whole: str | Column) -> Column:
    """``part`` in percent of ``whole``, two digits; NULL where ``whole`` is zero."""
    return round_average(_col(part) / F.nullif(_col(whole), F.lit(0.0)) * 100, 2)


def count_where(condition: Column) -> Column:
    """Rows meeting a condition; a NULL condition counts as not met."""
    return F.sum(F.when(condition, 1).otherwise(0))
