"""Business rules at their thresholds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterflow.functions import calendar as C
from meterflow.functions import rules as R
from meterflow.functions.keys import surrogate_key, timestamp_text


def value(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def lit(v, dtype="bigint"):
    return F.lit(v).cast(dtype)


@pytest.mark.parametrize(
    "warnings, readings, expected",
    [(0, 10, "HEALTHY"), (1, 10, "DEGRADED"), (2, 10, "UNHEALTHY"), (101, 1000, "UNHEALTHY"),
     (100, 1000, "DEGRADED"), (0, 0, "HEALTHY"), (None, None, "HEALTHY")],
)
def test_device_health_status(spark, warnings, readings, expected):
    assert value(spark, R.device_health_status(lit(warnings), lit(readings))) == expected


@pytest.mark.parametrize(
    "warnings, readings, expected",
    [(0, 20, "NORMAL"), (1, 20, "MONITOR"), (2, 20, "ACTION_REQUIRED"), (51, 1000, "ACTION_REQUIRED"),
     (50, 1000, "MONITOR"), (0, 0, "NORMAL")],
)
def test_customer_alert_status(spark, warnings, readings, expected):
    assert value(spark, R.customer_alert_status(lit(warnings), lit(readings))) == expected


@pytest.mark.parametrize("ok, n, expected", [(9, 10, 90.0), (1, 3, 33.33), (2, 3, 66.67), (0, 5, 0.0), (0, 0, None)])
def test_health_score(spark, ok, n, expected):
    assert value(spark, R.health_score(lit(ok), lit(n))) == expected


def test_rounding_ignores_the_last_bits(spark):
    for noisy in (1.005, 1.0049999999999997, 1.0050000000000003):
        assert value(spark, R.round_average(lit(noisy, "double"), 2)) == 1.01


def test_projection_uses_the_unrounded_mean(spark):
    mean = lit(1.0 / 3, "double")
    assert value(spark, R.projected_month_total(mean, lit(31, "int"))) == 10.33


def test_percent_of_zero_is_null(spark):
    assert value(spark, R.percent_of(lit(1, "double"), lit(0, "double"))) is None
    assert value(spark, R.percent_of(lit(1, "double"), lit(3, "double"))) == 33.33


def test_surrogate_key(spark):
    import hashlib

    expected = hashlib.md5(b"MTR-1-2025-12-09T06:25:40Z").hexdigest()
    assert value(spark, surrogate_key(F.lit("MTR-1"), F.lit("2025-12-09T06:25:40Z"))) == expected
    nulled = hashlib.md5(b"MTR-1-_dbt_utils_surrogate_key_null_").hexdigest()
    assert value(spark, surrogate_key(F.lit("MTR-1"), F.lit(None).cast("string"))) == nulled
    assert value(spark, timestamp_text(F.lit(dt.datetime(2025, 1, 2, 3, 4, 5)))) == "2025-01-02 03:04:05.000000"


def test_calendar_ranges(spark):
    days = [dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")

    def kept(cond):
        return [r.d for r in df.filter(cond).orderBy("d").collect()]

    as_of = dt.date(2024, 2, 10)
    assert kept(C.in_month_of("d", as_of)) == days[1:3]
    assert kept(C.on_day("d", days[2])) == [days[2]]
    assert kept(C.last_days("d", dt.date(2024, 3, 1), 1)) == days[2:]
    assert kept(C.last_months("d", as_of, 1)) == days
    assert kept(C.last_months("d", as_of, 0)) == days[1:]
    assert value(spark, C.days_in_month(C.as_date(as_of))) == 29
    assert value(spark, C.as_date(None)) == dt.datetime.now(dt.timezone.utc).date()
