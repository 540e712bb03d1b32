"""Joins, checks and reports on small handmade tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterflow.operators import enrich, lookup, quality, rollups
from meterflow.operators.lookup import broadcast_limit, estimated_bytes, lookup_join, small_enough_to_broadcast
from meterflow.plans import reports
from meterflow.sources.master import seed_customers, seed_devices
from tests.helpers import LOADED, dicts_of, readings, rows_of


@pytest.fixture(scope="module")
def seeds(spark):
    return seed_devices(spark, LOADED), seed_customers(spark, LOADED)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


ROWS = [("MTR-10000", "CUST-8001", "2025-01-01T00:00:00", 1.0, 230.0, 80, "OK"),
        ("MTR-10002", "CUST-8001", "2025-01-01T00:00:00", 2.0, 231.0, 80, "OK"),
        ("MTR-99999", "CUST-8001", "2025-01-01T00:00:00", 3.0, 232.0, 80, "OK"),
        ("MTR-10004", "CUST-9999", "2025-01-01T00:00:00", 4.0, 233.0, 80, "OK")]


def test_enrich_uses_the_customer_of_the_message(spark, seeds):
    got = dicts_of(enrich.enrich_readings(readings(spark, ROWS), *seeds), "device_id")
    assert {d: r["customer_name"] for d, r in got.items()} == {
        "MTR-10000": "TechStart Industries", "MTR-10002": "TechStart Industries"}
    assert got["MTR-10000"]["device_model"] == "SmartMeter-Pro-X1"


def test_monthly_comparison_uses_the_customer_of_the_master(spark, seeds):
    monthly = rollups.device_monthly(rollups.device_daily(rollups.device_hourly(readings(spark, ROWS))))
    got = reports.monthly_comparison(monthly, *seeds, as_of=dt.date(2025, 3, 5))
    assert [(r.device_id, r.customer_id) for r in got.collect()] == [
        ("MTR-10004", "CUST-8002"), ("MTR-10002", "CUST-8001"), ("MTR-10000", "CUST-8000")]
    assert reports.monthly_comparison(monthly, *seeds, as_of=dt.date(2025, 5, 5)).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_salted_join_gives_the_same_rows(spark, no_broadcast, how):
    rows = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"), "id")
    table = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert not small_enough_to_broadcast(table)
    salted = lookup_join(rows, table, "k", how)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(salted) == rows_of(rows.join(table, "k", how))


def hot_rows(spark):
    return spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500 + 2).alias("k"), "id")


def test_only_frequent_keys_are_cut_by_their_share(spark):
    rows = hot_rows(spark)
    found = lookup.frequent_keys(rows, ["k"], tasks=12)
    # A third of all rows is four fair shares of twelve, in halves.
    assert [(r["_parts"]) for r in found.collect()] == [8]
    table = spark.range(600).withColumnRenamed("id", "k")
    dealt, repeated = lookup.salted(rows, table, ["k"], found)
    assert repeated.count() == 600 + 7 and repeated.filter("k != 1").count() == 599
    sizes = {r["_salt"]: r["count"] for r in dealt.filter("k = 1").groupBy("_salt").count().collect()}
    assert sorted(sizes) == list(range(8)) and max(sizes.values()) < 2 * 1000 / 8
    assert dealt.filter("k != 1 AND _salt != 0").count() == 0


def test_even_keys_are_not_cut(spark):
    assert lookup.frequent_keys(spark.range(1000), ["id"], tasks=8).count() == 0
    assert lookup.frequent_keys(spark.range(0), ["id"]).count() == 0


def test_null_keys_and_empty_tables(spark, no_broadcast):
    rows = hot_rows(spark).withColumn("k", F.when(F.col("k") != 1, F.col("k")))
    table = spark.range(600).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_anti"):
        assert rows_of(lookup_join(rows, table, "k", how)) == rows_of(rows.join(table, "k", how))
    assert lookup_join(rows, table.limit(0), "k").count() == 0
    assert lookup_join(rows.limit(0), table, "k").count() == 0


def test_keys_of_several_columns_and_of_a_cheaper_frame(spark):
    rows = hot_rows(spark).withColumn("m", F.lit("x"))
    table = spark.range(600).select(F.col("id").alias("k"), F.lit("x").alias("m"), (F.col("id") * 2).alias("v"))
    got = lookup_join(rows, table, ["k", "m"], counted=rows.select("k", "m"), ship=False)
    assert rows_of(got) == rows_of(rows.join(table, ["k", "m"]))


def test_sizes(spark, seeds, sf_dir):
    stored = spark.read.parquet(f"{sf_dir}/customer.parquet")
    assert 0 < estimated_bytes(stored) < 1 << 20
    assert small_enough_to_broadcast(stored)
    assert estimated_bytes(seeds[0]) is None  # rows from the driver: nothing is known, so nothing is shipped
    assert not small_enough_to_broadcast(seeds[0])


def test_broadcast_limit_units(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, size in (("10MB", 10 << 20), ("5242880", 5 << 20), ("1g", 1 << 30), ("-1", -1), ("12b", 12), ("3kb", 3072)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert broadcast_limit(spark.range(1)) == size
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_active_devices(spark, seeds):
    devices = seeds[0].withColumn("device_status", F.when(F.col("device_id") != "MTR-10003", "ACTIVE"))
    got = [r.device_id for r in enrich.active_devices(devices).collect()]
    assert got == sorted(got) and len(got) == 9 and "MTR-10003" not in got


def test_quality(spark, seeds):
    devices, customers = seeds
    assert quality.duplicate_keys(devices, "device_id").count() == 0
    twice = devices.unionByName(devices.filter("device_id = 'MTR-10001'"))
    assert rows_of(quality.duplicate_keys(twice, "device_id")) == [("MTR-10001", 2)]
    assert quality.orphans(devices, customers, "customer_id").count() == 0
    fewer = customers.filter("customer_id <> 'CUST-8004'")
    assert quality.orphans(devices, fewer, "customer_id").count() == 2
    nulled = devices.withColumn("location", F.lit(None).cast("string"))
    assert rows_of(quality.not_null_violations(nulled, ["device_id", "location"])) == [("location", 10)]
    filled = quality.apply_defaults(nulled, {"location": F.lit("unknown")})
    assert quality.not_null_violations(filled, ["location"]).count() == 0
    assert quality.too_long(devices, {"device_id": 9}).count() == 0
    assert quality.too_long(devices, {"device_id": 8}).count() == 10
    assert rows_of(quality.row_counts({"d": devices, "c": customers})) == [("c", 5), ("d", 10)]


def test_master_violations(spark, seeds):
    devices, customers = seeds
    assert quality.master_violations({"customer_master": customers, "device_master": devices}).count() == 0
    broken = devices.withColumns(
        {"device_model": F.rpad("device_model", 51, "."), "customer_id": F.lit("CUST-1")}
    ).unionByName(devices.limit(1).withColumn("customer_id", F.lit(None).cast("string")))
    got = quality.master_violations({"customer_master": customers, "device_master": broken})
    assert rows_of(got) == [
        ("device_master", "duplicate_key", "device_id", 1), ("device_master", "null", "customer_id", 1),
        ("device_master", "orphan", "customer_id", 10), ("device_master", "too_long", "device_model", 10)]


def test_master_defaults(spark, seeds):
    bare = seeds[0].withColumns({"device_status": F.lit(None).cast("string"), "created_at": F.lit(None).cast("timestamp")})
    row = quality.with_master_defaults(bare, "device_master", dt.datetime(2025, 5, 1)).first()
    assert (row.device_status, row.created_at, row.updated_at) == ("ACTIVE", dt.datetime(2025, 5, 1), LOADED)


def test_orphans_ignore_null_keys(spark, seeds):
    devices = seeds[0].withColumn("customer_id", F.lit(None).cast("string"))
    assert quality.orphans(devices, seeds[1], "customer_id").count() == 0


# ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def marts(spark):
    rows = []
    for day in range(1, 29):
        for device in range(3):
            for hour in (0, 6, 12):
                status = "WARNING" if device == 2 and hour == 12 and day > 20 else "OK"
                rows.append((f"D{device}", f"C{device}", f"2025-02-{day:02d}T{hour:02d}:00:00",
                             float(device + hour), 230.0 + device, 80, status))
    hourly = rollups.device_hourly(readings(spark, rows)).cache()
    daily = rollups.device_daily(hourly).cache()
    monthly = rollups.device_monthly(daily).cache()
    customer_daily = rollups.customer_daily(daily).cache()
    return {
        "h": hourly, "d": daily, "m": monthly, "cd": customer_daily, "cm": rollups.customer_monthly(monthly).cache(),
        "mtd": rollups.customer_usage_mtd(customer_daily, dt.date(2025, 2, 25)).cache(),
    }


AS_OF = dt.date(2025, 2, 25)


def test_energy_reports(marts):
    assert rows_of(reports.energy_by_customer(marts["cd"], AS_OF)) == [("C0", 18.0), ("C1", 21.0), ("C2", 24.0)]
    trend = reports.daily_trend(marts["cd"], AS_OF, days=7, limit=4).collect()
    assert [(r.reading_date.day, r.customer_id) for r in trend] == [(28, "C0"), (28, "C1"), (28, "C2"), (27, "C0")]
    assert reports.daily_energy_chart(marts["cd"], AS_OF).count() == 33
    top = reports.top_consumers(marts["cm"], AS_OF, n=2).collect()
    assert [r.customer_id for r in top] == ["C2", "C1"]
    assert rows_of(reports.month_trend(marts["cm"])) == [(dt.date(2025, 2, 1), 28 * 63.0, 252, 8)]
    assert reports.device_months(marts["m"], dt.date(2025, 5, 3)).count() == 3
    assert reports.device_months(marts["m"], dt.date(2025, 6, 3)).count() == 0
    assert rows_of(reports.active_days(marts["m"], AS_OF))[0] == ("D0", "C0", 28)


def test_hour_reports(marts):
    pattern = dicts_of(reports.hourly_pattern(marts["h"], AS_OF), "device_id", "hour_of_day")
    assert len(pattern) == 9 and pattern["D1", 6]["avg_energy_kwh"] == 7.0
    recent = reports.hourly_pattern_recent(marts["h"], dt.datetime(2025, 2, 28, 12), hours=24)
    assert recent.count() == 9
    assert reports.hourly_pattern_recent(marts["h"], dt.datetime(2025, 2, 28, 13), hours=1).count() == 3
    peak = reports.hourly_peak(marts["h"], AS_OF).collect()
    assert [(r.hour_of_day, r.device_id) for r in peak][:2] == [(0, "D0"), (0, "D1")]
    assert peak[1].peak_energy == 1.0


def test_alert_reports(marts, spark):
    assert rows_of(reports.alert_distribution(marts["cd"], AS_OF)) == [("ACTION_REQUIRED", 1), ("NORMAL", 2)]
    assert rows_of(reports.alert_distribution(marts["cd"], all_days=True)) == [("ACTION_REQUIRED", 8), ("NORMAL", 76)]
    assert rows_of(reports.device_status_counts(marts["d"], AS_OF)) == [("HEALTHY", 2), ("UNHEALTHY", 1)]
    assert [r.device_id for r in reports.warning_devices(marts["d"], AS_OF).collect()] == ["D2"]
    trend = dicts_of(reports.health_trend(marts["d"], AS_OF), "reading_date", "device_id")
    assert trend[AS_OF, "D2"]["avg_health_score_pct"] == 66.67
    alerts = reports.mtd_alerts(marts["mtd"]).collect()
    assert [(r.customer_id, r.pct_of_projected) for r in alerts] == [("C2", 100.0)]
    assert [r.customer_id for r in reports.mtd_listing(marts["mtd"]).collect()] == ["C2", "C1", "C0"]
    total = reports.mtd_vs_projected(marts["mtd"]).first()
    assert (total.mtd_total_energy_kwh, total.projected_monthly_energy_kwh) == (1764.0, 1764.0)
    budgets = spark.createDataFrame([("C0", 500.0), ("C1", 600.0)], "customer_id string, budget_kwh double")
    assert [r.customer_id for r in reports.over_budget(marts["mtd"], budgets).collect()] == ["C0"]


def test_listings(marts):
    daily = reports.listed(marts["d"], "device_daily_metrics").collect()
    assert (daily[0].reading_date.day, daily[0].device_id, daily[-1].reading_date.day) == (28, "D0", 1)
    assert reports.current_rows(marts["d"], "device_daily_metrics", AS_OF).count() == 3
    assert reports.current_rows(marts["cm"], "customer_monthly_usage_summary", AS_OF).count() == 3
    assert reports.current_rows(marts["mtd"], "customer_usage_mtd_summary").count() == 1
