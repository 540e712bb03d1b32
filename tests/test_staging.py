"""Parsing and loading."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterflow import schemas
from meterflow.operators import staging
from meterflow.operators.dedup import dedup_latest
from tests.helpers import LOADED, dicts_of, message, rows_of, topic_rows, ts


def parsed(spark, *messages, **kw):
    return staging.parse_telemetry(topic_rows(spark, messages), LOADED, **kw)


def test_telemetry_fields(spark):
    row = parsed(spark, message(energy=0.42, volts=229.6, battery=78)).first().asDict()
    row.pop("telemetry_id")
    assert row == {
        "device_id": "MTR-1", "customer_id": "CUST-1", "reading_timestamp": ts("2025-12-09T06:25:40"),
        "energy_kwh": 0.42, "voltage": 229.6, "battery_pct": 78, "status": "OK", "ingested_at": LOADED,
        "sent_at": ts("2025-12-09T00:00:00"),
    }


def test_telemetry_schema(spark):
    df = parsed(spark, message())
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.STG_TELEMETRY]


def test_offsets_become_utc(spark):
    assert parsed(spark, message(at="2025-12-09T10:00:00+05:00")).first().reading_timestamp == ts("2025-12-09T05:00:00")


def test_lenient_numbers(spark):
    row = parsed(spark, message(energy="0.4", battery=78.5)).first()
    assert (row.energy_kwh, row.battery_pct) == (0.4, 79)


BAD = {
    "{bad": "malformed_json",
    "[1]": "malformed_json",
    "5": "malformed_json",
    message(device=None): "missing_device",
    message(at=None): "missing_timestamp",
    message(at="noon"): "unreadable_timestamp",
    message(energy="much"): "unreadable_number",
    message(battery="x"): "unreadable_number",
    message(energy="NaN"): "unreadable_number",
    message(energy="Infinity"): "unreadable_number",
    message(energy="1e999"): "unreadable_number",
    message(energy="1d"): "unreadable_number",
    message(volts=True): "unreadable_number",
    message(at="12:30"): "unreadable_timestamp",
    message(at="T12:30:00Z"): "unreadable_timestamp",
    message(at="2025"): "unreadable_timestamp",
    message(at="2025-12-09"): "unreadable_timestamp",
    message(at="2025-12-12T00:00:00Z"): "time_ahead",
    message() + message(): "malformed_json",
    message() + ", " + message(): "malformed_json",
    message() + "]": "malformed_json",
    message() + "]{}": "malformed_json",
    message() + "}": "malformed_json",
    message() + "x": "malformed_json",
    "null": "malformed_json",
    '{"device_id":"D","timestamp":"2025-01-01T00:00:00Z","metrics":5}': "malformed_json",
}


def test_rejects(spark):
    df = staging.parse_rejects(topic_rows(spark, [*BAD, "", None, message()]), LOADED)
    assert {r._message: r.reject_reason for r in df.collect()} == BAD


def test_every_message_is_used_or_rejected(spark):
    rows = topic_rows(spark, [*BAD, message(), message(customer=None), '{"device_id":"D","timestamp":"2025-01-01"}'])
    assert staging.parse_telemetry(rows, LOADED).count() + staging.parse_rejects(rows, LOADED).count() == rows.count()


def test_missing_metrics_stay_null(spark):
    row = parsed(spark, '{"device_id":"D","timestamp":"2025-01-01T00:00:00Z"}').first()
    assert (row.energy_kwh, row.voltage, row.battery_pct, row.status) == (None, None, None, None)


@pytest.mark.parametrize("bad", list(BAD))
def test_strict_fails(spark, bad):
    with pytest.raises(Exception):
        parsed(spark, message(), bad, strict=True).collect()


def test_strict_accepts_good(spark):
    assert parsed(spark, message(), strict=True).count() == 1


LINES = {
    "L1": "2025-12-09 06:25:40 [INFO] MTR-10000 CUST-8000 HEALTH_CHECK_OK status=GOOD battery=85 voltage=229.6 temp=41.5 memory=40 uptime=120 errors=0",
    "L2": "[WARN] 2025-12-09 07:00:00 MTR-10001 CUST-8000 MEMORY_WARNING Status: DEGRADED mem=91 up=300 err_cnt=4",
    "L3": "2025-12-09 08:00:00 [ERROR] Meter MTR-10002 of CUST-8001 reported SENSOR_FAULT, status is FAULTY",
    "L4": "2025-12-09 09:00:00 [CRITICAL] MTR-10003 BATTERY_LOW battery=5",
    "L5": "[INFO] MTR-10004 CUST-8002 HEALTH_CHECK_OK",
    "L6": "2025-12-09 10:00:00 [INFO] no device here",
    "L7": "",
    "L8": "2025-12-09 11:00:00 [INFO] MTR-10005 voltage=229.6. battery=99999999999",
    "L9": "2025-12-09 12:00:00 [INFO] MTR-10006 temp=-5.0 backup=12",
    "L10": "2025-13-09 12:00:00 [DEBUG] MTR-10007",
}


@pytest.fixture(scope="module")
def logs(spark):
    rows = topic_rows(spark, [*LINES.values(), None], at="2025-12-09T23:00:00")
    return dicts_of(staging.parse_logs(rows, LOADED), "device_id")


def test_log_dropped_lines(logs):
    assert set(logs) == {f"MTR-1000{i}" for i in range(8)}


def test_log_primary_patterns(logs):
    row = logs["MTR-10000"]
    assert (row["log_timestamp"], row["log_level"], row["customer_id"]) == (ts("2025-12-09T06:25:40"), "INFO", "CUST-8000")
    assert (row["health_event"], row["health_status"]) == ("HEALTH_CHECK_OK", "GOOD")
    assert (row["battery_pct"], row["voltage_v"], row["temperature_c"]) == (85, 229.6, 41.5)
    assert (row["memory_usage_pct"], row["uptime_hours"], row["error_count"]) == (40, 120, 0)


def test_log_other_spellings(logs):
    row = logs["MTR-10001"]
    assert (row["health_status"], row["memory_usage_pct"], row["uptime_hours"], row["error_count"]) == ("DEGRADED", 91, 300, 4)
    assert (row["battery_pct"], row["voltage_v"], row["temperature_c"]) == (None, None, None)
    assert (logs["MTR-10002"]["health_status"], logs["MTR-10002"]["error_count"]) == ("FAULTY", 0)
    assert (logs["MTR-10003"]["health_status"], logs["MTR-10003"]["customer_id"]) == ("UNKNOWN", None)


def test_log_time_fallback(spark, logs):
    assert logs["MTR-10004"]["log_timestamp"] == ts("2025-12-09T23:00:00")
    assert logs["MTR-10007"]["log_timestamp"] == ts("2025-12-09T23:00:00")
    assert logs["MTR-10007"]["log_level"] is None
    batch = staging.parse_logs(topic_rows(spark, [LINES["L5"]]), LOADED, fallback="batch").first()
    assert batch.log_timestamp == LOADED


def test_log_unfit_numbers(spark, logs):
    assert (logs["MTR-10005"]["voltage_v"], logs["MTR-10005"]["battery_pct"]) == (None, None)
    assert (logs["MTR-10006"]["temperature_c"], logs["MTR-10006"]["uptime_hours"]) == (None, 12)
    with pytest.raises(Exception):
        staging.parse_logs(topic_rows(spark, [LINES["L8"]]), LOADED, strict=True).collect()


def test_log_mark_leaves_made_up_times_out(spark):
    rows = staging.parse_logs(topic_rows(spark, LINES.values(), at="2030-01-01T00:00:00"), LOADED)
    assert staging.log_mark(rows).first()[0] == ts("2025-12-09T12:00:00")


def test_log_schema(spark):
    df = staging.parse_logs(topic_rows(spark, [LINES["L1"]]), LOADED)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.STG_HEALTH_LOGS]


# ---------------------------------------------------------------------------


def frame(spark, rows):
    return spark.createDataFrame([(k, ts(t), v, ts(i)) for k, t, v, i in rows], "id string, at timestamp, v int, loaded timestamp")


OLD = [("a", "2025-01-01", 1, "2025-02-01"), ("b", "2025-01-02", 2, "2025-02-01")]
NEW = [("a", "2025-01-01", 9, "2025-02-02"), ("c", "2025-01-01", 3, "2025-02-02"),
       ("d", "2025-01-02", 4, "2025-02-02"), ("e", "2025-01-03", 5, "2025-02-02")]


def ids(df):
    return sorted(r.id for r in df.collect())


def test_incremental_modes(spark):
    old, new = frame(spark, OLD), frame(spark, NEW)
    assert ids(staging.incremental_new(new, old, "at", "id")) == ["e"]
    assert ids(staging.incremental_new(new, old, "at", "id", late="keep")) == ["c", "d", "e"]
    assert ids(staging.incremental_new(new, None, "at", "id")) == ["a", "c", "d", "e"]
    assert ids(staging.late_rows(new, old, "at")) == ["a", "c", "d"]
    with pytest.raises(ValueError):
        staging.incremental_new(new, old, "at", "id", late="maybe")


def test_null_times_are_late(spark):
    new = frame(spark, NEW).withColumn("at", F.lit(None).cast("timestamp"))
    assert ids(staging.incremental_new(new, frame(spark, OLD), "at", "id")) == []
    assert staging.late_rows(new, frame(spark, OLD), "at").count() == len(NEW)


def test_first_mark(spark):
    empty = frame(spark, OLD).limit(0)
    assert staging.high_water_mark(empty, "at").first()[0] == staging.FIRST_MARK


def test_upsert(spark):
    merged = staging.upsert_latest(frame(spark, OLD), frame(spark, NEW), "id", ["loaded"])
    assert {r.id: r.v for r in merged.collect()} == {"a": 9, "b": 2, "c": 3, "d": 4, "e": 5}


def test_insert_missing_twice_adds_nothing(spark):
    old, new = frame(spark, OLD), frame(spark, NEW + NEW)
    first = staging.insert_missing(new, old, "id")
    assert ids(first) == ["c", "d", "e"]
    assert staging.insert_missing(new, old.unionByName(first), "id").count() == 0


keys = st.sampled_from("abc")
records = st.lists(st.tuples(keys, st.integers(1, 3), st.integers(0, 9), st.integers(1, 3)), min_size=1, max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(records)
def test_dedup_is_latest_and_stable(spark, recs):
    rows = [(k, f"2025-01-0{d}", v, f"2025-02-0{i}") for k, d, v, i in recs]
    once = dedup_latest(frame(spark, rows), ["id", "at"], ["loaded"])
    expected = {}
    for k, d, v, i in recs:
        expected[k, d] = max(expected.get((k, d), (0, -1)), (i, v))
    assert {(r.id, r.at.day): (r.loaded.day, r.v) for r in once.collect()} == expected
    assert rows_of(dedup_latest(once, ["id", "at"], ["loaded"])) == rows_of(once)
