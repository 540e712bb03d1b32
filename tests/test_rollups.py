"""Rollups against plain Python, and the properties that tie the grains together."""

import datetime as dt
import math
import random

import pytest

from meterflow import schemas
from meterflow.operators import rollups as M
from meterflow.operators.lookup import tasks_by_size
from tests.helpers import LOADED, brute_hourly, dicts_of, readings, ts

LATER = LOADED + dt.timedelta(days=1)


def random_rows(n, seed, devices=4, days=40):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        d = rng.randrange(devices)
        at = dt.datetime(2025, 1, 1) + dt.timedelta(minutes=10 * rng.randrange(days * 24 * 6))
        rows.append((f"MTR-{d}", f"CUST-{d // 2}", at.isoformat(), rng.randrange(500) / 100,
                     rng.randrange(2200, 2400) / 10, rng.randrange(60, 101), rng.choice(["OK"] * 8 + ["WARNING", None])))
    seen = {}
    for r in rows:  # one reading per device and time, then copies of some
        seen.setdefault((r[0], r[2]), r)
    unique = list(seen.values())
    copies = [(*r, LATER) for r in unique if rng.random() < 0.2]
    return unique + copies + copies[:3]


@pytest.fixture(scope="module")
def chain(spark):
    rows = random_rows(900, 7)
    hourly = M.device_hourly(readings(spark, rows)).cache()
    daily = M.device_daily(hourly).cache()
    monthly = M.device_monthly(daily).cache()
    return rows, hourly, daily, monthly


def test_schemas(spark, chain):
    _, hourly, daily, monthly = chain
    built = {
        "hourly": (hourly, schemas.DEVICE_HOURLY), "daily": (daily, schemas.DEVICE_DAILY),
        "monthly": (monthly, schemas.DEVICE_MONTHLY), "cd": (M.customer_daily(daily), schemas.CUSTOMER_DAILY),
        "cm": (M.customer_monthly(monthly), schemas.CUSTOMER_MONTHLY),
        "mtd": (M.customer_usage_mtd(M.customer_daily(daily), dt.date(2025, 1, 5)), schemas.CUSTOMER_MTD),
    }
    for name, (df, schema) in built.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema], name


def test_hourly_against_plain_python(chain):
    rows, hourly, _, _ = chain
    ours = dicts_of(hourly, "device_id", "customer_id", "reading_hour")
    expected = brute_hourly(rows)
    assert set(ours) == set(expected)
    for key, want in expected.items():
        for col, value in want.items():
            assert math.isclose(ours[key][col], value, rel_tol=1e-12), (key, col)


def test_totals_agree_at_every_grain(chain):
    _, hourly, daily, monthly = chain
    customers = [M.customer_daily(daily).selectExpr("daily_total_energy_kwh e", "total_readings n"),
                 M.customer_monthly(monthly).selectExpr("monthly_total_energy_kwh e", "total_readings n")]
    devices = [df.selectExpr("total_energy_kwh e", "reading_count n") for df in (hourly, daily, monthly)]
    sums = [df.selectExpr("round(sum(e), 6) e", "sum(n) n").first() for df in devices + customers]
    assert len({(s.e, s.n) for s in sums}) == 1


def test_averages_are_means_of_means(spark):
    rows = [("D", "C", "2025-01-01T00:00:00", 1.0, 220.0, 60, "OK"),
            ("D", "C", "2025-01-01T01:00:00", 1.0, 230.0, 70, "OK"),
            ("D", "C", "2025-01-01T01:10:00", 1.0, 240.0, 80, "OK")]
    daily = M.device_daily(M.device_hourly(readings(spark, rows)))
    row = daily.first()
    assert (row.avg_voltage, row.avg_battery_pct, row.active_hours) == (227.5, 67.5, 2)


def test_ten_percent_is_still_degraded(spark):
    rows = [("D", "C", f"2025-01-01T00:{m:02d}:00", 1.0, 230.0, 80, "WARNING" if m == 0 else "OK") for m in range(10)]
    row = M.device_hourly(readings(spark, rows)).first()
    assert (row.device_health_status, row.health_score_pct) == ("DEGRADED", 90.0)


def test_later_load_wins(spark):
    rows = [("D", "C", "2025-01-01T00:00:00", 1.0, 230.0, 80, "OK"),
            ("D", "C", "2025-01-01T00:00:00", 5.0, 230.0, 80, "WARNING", LATER)]
    row = M.device_hourly(readings(spark, rows)).first()
    assert (row.total_energy_kwh, row.reading_count, row.warning_count) == (5.0, 1, 1)


def test_device_under_two_customers_gives_two_rows(spark):
    rows = [("D", "C1", "2025-01-01T00:00:00", 1.0, 230.0, 80, "OK"),
            ("D", "C2", "2025-01-01T00:10:00", 1.0, 230.0, 80, "OK")]
    assert M.device_daily(M.device_hourly(readings(spark, rows))).count() == 2


def test_unknown_status_counts_in_neither(spark):
    rows = [("D", "C", "2025-01-01T00:00:00", 1.0, 230.0, 80, None)]
    row = M.device_hourly(readings(spark, rows)).first()
    assert (row.reading_count, row.warning_count, row.ok_count, row.health_score_pct) == (1, 0, 0, 0.0)


def test_hot_device_and_copies(spark):
    """One device holds most rows, one reading most of those."""
    rows = [("HOT", "C", f"2025-01-01T{h:02d}:{m:02d}:00", 1.0, 230.0, 80, "OK") for h in range(24) for m in range(0, 60, 5)]
    rows += [(*rows[0], LATER)] * 500 + [("D", "C", "2025-01-01T00:00:00", 1.0, 230.0, 80, "OK")]
    daily = dicts_of(M.device_daily(M.device_hourly(readings(spark, rows))), "device_id")
    assert (daily["HOT"]["reading_count"], daily["D"]["reading_count"]) == (288, 1)


def test_unique_skips_the_dedup(spark, chain):
    rows = [r for r in chain[0] if len(r) == 7]
    a = M.device_hourly(readings(spark, rows))
    b = M.device_hourly(readings(spark, rows), unique=True)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


# ---------------------------------------------------------------------------


def mtd_input(spark):
    rows = [("D1", "C1", "2025-01-31T00:00:00", 9.0, 230.0, 80, "OK"),
            ("D1", "C1", "2025-02-01T00:00:00", 1.0, 230.0, 80, "OK"),
            ("D1", "C1", "2025-02-03T00:00:00", 2.0, 230.0, 80, "OK"),
            ("D2", "C1", "2025-02-03T00:00:00", 2.5, 230.0, 80, "WARNING"),
            ("D3", "C2", "2025-02-01T00:00:00", 7.0, 230.0, 80, "OK"),
            ("D3", "C2", "2025-03-01T00:00:00", 7.0, 230.0, 80, "OK")]
    return M.customer_daily(M.device_daily(M.device_hourly(readings(spark, rows))))


def test_month_to_date(spark):
    mtd = dicts_of(M.customer_usage_mtd(mtd_input(spark), dt.date(2025, 2, 2)), "customer_id")
    c1, c2 = mtd["C1"], mtd["C2"]
    assert (c1["mtd_total_energy_kwh"], c1["days_with_data"], c1["max_active_devices"]) == (5.5, 2, 2)
    assert (c1["avg_daily_energy_kwh"], c1["projected_monthly_energy_kwh"]) == (2.75, 77.0)
    assert (c1["latest_day_energy_kwh"], c2["latest_day_energy_kwh"]) == (4.5, None)
    assert (c1["mtd_alert_status"], c2["mtd_alert_status"]) == ("ACTION_REQUIRED", "NORMAL")
    assert (c1["current_month"], c1["year"], c1["month"]) == (dt.date(2025, 2, 1), 2025, 2)
    assert (c1["first_reading_date"], c1["last_reading_date"]) == (dt.date(2025, 2, 1), dt.date(2025, 2, 3))
    assert c1["mtd_health_score_pct"] == 66.67


def test_month_to_date_up_to_as_of(spark):
    mtd = dicts_of(M.customer_usage_mtd(mtd_input(spark), dt.date(2025, 2, 2), up_to_as_of=True), "customer_id")
    assert (mtd["C1"]["mtd_total_energy_kwh"], mtd["C1"]["latest_day_energy_kwh"]) == (1.0, 1.0)
    assert mtd["C2"]["latest_day_energy_kwh"] == 7.0


def test_month_without_data_is_empty(spark):
    assert M.customer_usage_mtd(mtd_input(spark), dt.date(2024, 2, 2)).count() == 0


def test_tasks_of_device_hours_follow_the_size_of_the_input(spark, tmp_path, monkeypatch):
    rows = random_rows(900, 11, devices=12)
    readings(spark, rows).write.parquet(str(tmp_path / "readings"))
    stored = spark.read.parquet(str(tmp_path / "readings"))
    hours = M.device_hourly(stored)
    size = sum(f.stat().st_size for f in (tmp_path / "readings").glob("*.parquet"))
    small = M.by_device(hours)
    # One task each for what a tenth of the files holds; adaptive execution does not join them again.
    monkeypatch.setattr("meterflow.operators.lookup.TASK_BYTES", -(-size // 10))
    large, larger = M.by_device(hours), M.by_device(M.device_hourly(stored.unionByName(stored)))
    assert [df.rdd.getNumPartitions() for df in (large, larger)] == [10, 20]
    assert small.rdd.getNumPartitions() <= 4
    months = [M.customer_monthly(M.device_monthly(M.device_daily(df))) for df in (small, large)]
    kept = [df.select("customer_id", "reading_month", "total_readings", "total_devices", "max_voltage") for df in months]
    assert kept[0].count() > 0
    assert kept[0].exceptAll(kept[1]).isEmpty() and kept[1].exceptAll(kept[0]).isEmpty()


def test_tasks_by_size_stay_as_usual_where_nothing_is_known(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("meterflow.operators.lookup.TASK_BYTES", 1)
    monkeypatch.setattr("meterflow.operators.lookup.MAX_REDUCERS", 50)
    rows = readings(spark, random_rows(50, 3))
    assert tasks_by_size(rows) is None  # rows from the driver
    rows.write.parquet(str(tmp_path / "readings"))
    assert tasks_by_size(spark.read.parquet(str(tmp_path / "readings"))) == 50
    assert tasks_by_size(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "readings"))) is None
