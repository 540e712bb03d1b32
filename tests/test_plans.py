"""The physical plans the queries must keep."""

import datetime as dt
import re

import pytest

import __spark_entry__ as entry
from meterflow.operators import enrich, rollups, staging
from meterflow.plans import reports
from meterflow.sources import adapters as A
from meterflow.sources.tables import Lake


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# The text operations choose their own style.
OWN = sorted(n for n in entry.queries() if not n.startswith("op") and n != "pipeline")


@pytest.mark.parametrize("name", OWN)
def test_no_python_no_cross_products(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for bad in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_copies_are_cut_before_the_shuffle(spark, sf_dir):
    text = plan(rollups.latest_readings(A.readings_from_lineitem(spark, sf_dir)))
    below = text[text.index("Exchange"):]
    assert re.search(r"WindowGroupLimit.*Partial", below)


def test_rollups_combine_before_the_shuffle(spark, sf_dir):
    text = plan(rollups.device_hourly(A.readings_from_events(spark, sf_dir)))
    assert "partial_sum" in text[text.index("Exchange"):]


def test_days_and_months_share_one_exchange(spark, sf_dir):
    hours = rollups.device_hourly(A.readings_from_lineitem(spark, sf_dir))
    apart = rollups.device_monthly(rollups.device_daily(hours))
    shared = rollups.device_monthly(rollups.device_daily(rollups.by_device(hours)))
    assert plan(apart).count("Exchange hashpartitioning") == 4
    assert plan(shared).count("Exchange hashpartitioning") == 3
    # Readings of a busy device are still combined before they move, by the hour.
    text = plan(shared)
    assert re.search(r"Exchange hashpartitioning\(device_id#\d+, customer_id#\d+, _groupingexpression", text)
    both = [df.select("device_id", "customer_id", "reading_month", "active_days", "reading_count") for df in (apart, shared)]
    assert both[0].exceptAll(both[1]).isEmpty() and both[1].exceptAll(both[0]).isEmpty()


def test_each_message_is_parsed_once(spark, sf_dir, tmp_path):
    A.telemetry_messages(spark, sf_dir).write.parquet(str(tmp_path / "t"))
    rows = staging.parse_telemetry(spark.read.parquet(str(tmp_path / "t")), A.LOADED_AT)
    text = plan(rows)
    # Once for all messages, and again only inside the branch for unsure ones.
    assert text.count("from_json(") == 2
    assert text.index("CASE WHEN") < text.rindex("from_json(")


def test_narrow_steps_do_not_shuffle(spark, sf_dir, tmp_path):
    A.log_messages(spark, sf_dir).write.parquet(str(tmp_path / "l"))
    rows = staging.parse_logs(spark.read.parquet(str(tmp_path / "l")), A.LOADED_AT)
    assert "Exchange" not in plan(rows)


def test_time_range_reaches_the_scan(spark, sf_dir):
    text = plan(A.readings_from_events(spark, sf_dir, dt.date(2024, 1, 20), dt.date(2024, 1, 21)))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,.*LessThan\(ts,", text)


def test_only_needed_columns_are_read(spark, sf_dir):
    items = A.readings_from_lineitem(spark, sf_dir).select("device_id", "energy_kwh")
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan(items)


def test_small_master_tables_are_broadcast(spark, sf_dir):
    joined = enrich.enrich_readings(
        A.readings_from_events(spark, sf_dir), A.device_master(spark, sf_dir), A.customer_master(spark, sf_dir))
    text = plan(joined)
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


def test_large_master_tables_are_not(spark, sf_dir):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        joined = enrich.enrich_readings(
            A.readings_from_events(spark, sf_dir), A.device_master(spark, sf_dir), A.customer_master(spark, sf_dir))
        assert "_salt" in plan(joined)
        assert joined.count() == entry.queries()["join_master"](spark, sf_dir).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_top_consumers_keeps_ten_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(entry.queries()["report_top_consumers"](spark, sf_dir))


def test_reports_read_only_their_partitions(spark, sf_dir, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    days = rollups.customer_daily(rollups.device_daily(rollups.device_hourly(A.readings_from_events(spark, sf_dir))))
    lake.write_full(days, "customer_daily_usage_summary")
    stored, as_of = lake.read("customer_daily_usage_summary"), dt.date(2024, 1, 20)
    for df in (reports.energy_by_customer(stored, as_of), reports.daily_trend(stored, as_of),
               rollups.customer_usage_mtd(stored, as_of)):
        assert re.search(r"PartitionFilters: \[[^\]]*reading_date#\d+ (>=|=)", plan(df))


def test_month_to_date_over_a_stored_mart_shuffles_once(spark, sf_dir, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    days = rollups.customer_daily(rollups.device_daily(rollups.device_hourly(A.readings_from_events(spark, sf_dir))))
    lake.write_full(days, "customer_daily_usage_summary")
    text = plan(rollups.customer_usage_mtd(lake.read("customer_daily_usage_summary"), dt.date(2024, 1, 20)))
    assert text.count("Exchange hashpartitioning") == 1
