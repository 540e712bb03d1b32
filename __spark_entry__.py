"""

Sums and means of doubles depend on the order of addition, so the queries that
are compared by value cut them to six digits (`_stable`), as the SQL does.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.functions import calendar as C
from meterflow.functions import rules as R
from meterflow.functions.keys import surrogate_key
from meterflow.operators import deltas, enrich, keyfilter, lookup, progress, quality, rollups, staging
from meterflow.operators.dedup import dedup_latest
from meterflow.plans import reports
from meterflow.session import kept
from meterflow.sources import adapters as A
from meterflow.sources import master
from meterflow.sources.topics import telemetry_body, to_records
from oracles import sql as O

E_DAY = dt.date(2024, 1, 20)
E_INSTANT = dt.datetime(2024, 1, 20, 12)
E_MONTH, E_NEXT_MONTH = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
E_NEXT_DAY = dt.date(2024, 1, 21)
E_WEEK = dt.date(2024, 1, 13)
L_DAY = dt.date(1998, 6, 15)
CUT = dt.datetime(2024, 1, 16)
DEVICE = ("total_energy_kwh", "avg_voltage", "avg_battery_pct")
CUSTOMER_DAY = ("daily_total_energy_kwh", "avg_voltage", "avg_battery_pct")
CUSTOMER_MONTH = ("monthly_total_energy_kwh", "avg_voltage", "avg_battery_pct")
MTD = ("mtd_total_energy_kwh", "latest_day_energy_kwh")

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _stable(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: R.round_average(c, 6) for c in cols}) if cols else df


def _register(name: str, sql: str, *stable: str):
    def wrap(fn: Query) -> Query:
        _QUERIES[name] = lambda spark, sf_dir: _stable(fn(spark, sf_dir), *stable)
        _ORACLES[name] = O.query(O.stable(sql, *stable))
        return fn

    return wrap


# --------------------------------------------------------------------------
# inputs


def _e_hourly(spark, sf, since=None, until=None):
    return rollups.device_hourly(A.readings_from_events(spark, sf, since, until))


def _e_daily(spark, sf, since=None, until=None):
    return rollups.device_daily(_e_hourly(spark, sf, since, until))


def _e_customer_daily(spark, sf, since=None, until=None):
    return rollups.customer_daily(_e_daily(spark, sf, since, until))


def _e_mtd(spark, sf):
    readings = A.readings_from_events(spark, sf, E_MONTH, E_NEXT_MONTH, redeliver=False)
    dates = readings.select(F.to_date("reading_timestamp").alias("reading_date"))
    return rollups.customer_usage_mtd(
        _e_customer_daily(spark, sf, E_MONTH, E_NEXT_MONTH), E_DAY, dates=dates
    )


def _l_mtd(spark, sf):
    """Month to date over the fifty customers of the line items: all three states occur."""
    return rollups.customer_usage_mtd(rollups.customer_daily(_l_daily(spark, sf)), L_DAY)


def _l_daily(spark, sf):
    return rollups.device_daily(rollups.device_hourly(A.readings_from_lineitem(spark, sf)))


def _l_monthly(spark, sf):
    hours = rollups.device_hourly(A.readings_from_lineitem(spark, sf))
    return rollups.device_monthly(rollups.device_daily(rollups.by_device(hours)))


def _l_customer_monthly(spark, sf):
    return rollups.customer_monthly(_l_monthly(spark, sf))


def _split(spark, sf):
    """Staged readings: those loaded before the cut, and all of them."""
    rows = A.staged_from_events(spark, sf)
    return rows.filter(F.col("reading_timestamp") < F.lit(CUT)), rows


# --------------------------------------------------------------------------
# staging

_STAGED = "telemetry_id, device_id, customer_id, reading_timestamp, energy_kwh, voltage, battery_pct, status, ingested_at"


@_register("parse_telemetry", f"SELECT {_STAGED}, reading_timestamp AS sent_at FROM accepted")
def _(spark, sf):
    return staging.parse_telemetry(A.telemetry_messages(spark, sf), A.LOADED_AT)


@_register(
    "parse_rejects",
    """SELECT device_id AS _key, reading_timestamp AS _timestamp,
              CASE WHEN battery_pct IN (60, 69, 76, 77, 78) THEN 'malformed_json' WHEN battery_pct = 62 THEN 'missing_device'
                   WHEN battery_pct = 65 THEN 'missing_timestamp' WHEN battery_pct IN (63, 70, 71) THEN 'unreadable_timestamp'
                   WHEN battery_pct = 79 THEN 'time_ahead' ELSE 'unreadable_number' END AS reject_reason
       FROM staged WHERE battery_pct < 80 AND battery_pct NOT IN (61, 66, 67, 68)""",
)
def _(spark, sf):
    return staging.parse_rejects(A.telemetry_messages(spark, sf), A.LOADED_AT).drop("_message")


@_register(
    "log_rejects",
    """SELECT 'MTR-' || (10000 + user_id) AS _key, ts AS _timestamp, 'missing_device' AS reject_reason
       FROM events WHERE event_type NOT IN ('click', 'view', 'error', 'purchase')""",
)
def _(spark, sf):
    return staging.rejects(staging.read_logs(A.log_messages(spark, sf), A.LOADED_AT)).drop("_message")


@_register("parse_logs", "SELECT * FROM logs")
def _(spark, sf):
    return staging.parse_logs(A.log_messages(spark, sf), A.LOADED_AT)


@_register(
    "surrogate_key",
    """SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '-' ||
              coalesce(nullif(o_orderstatus, 'P'), '_dbt_utils_surrogate_key_null_') || '-' || o_orderpriority) AS row_key
       FROM orders""",
)
def _(spark, sf):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return A.table(spark, sf, "orders").select(
        "o_orderkey", surrogate_key("o_orderkey", status, "o_orderpriority").alias("row_key")
    )


@_register(
    "to_records",
    f"""SELECT device_id AS key, device_id, customer_id, {O.ISO.format(ts='reading_timestamp')} AS sent_at,
               energy_kwh, voltage, battery_pct, status FROM staged""",
)
def _(spark, sf):
    body = telemetry_body(A.readings_from_events(spark, sf, redeliver=False))
    sent = F.from_json("value", body.schema)
    return to_records(body, "device_id").select("key", sent.alias("m")).select(
        "key", "m.device_id", "m.customer_id", F.col("m.timestamp").alias("sent_at"), "m.metrics.*", "m.status"
    )


@_register(
    "high_water_mark",
    """SELECT 'telemetry' AS source, max(reading_timestamp) AS high_water_mark FROM staged
       UNION ALL SELECT 'logs', max(log_timestamp) FROM logs WHERE log_level <> 'CRITICAL'
       UNION ALL SELECT 'empty', TIMESTAMP '2000-01-01 00:00:00'""",
)
def _(spark, sf):
    rows = A.staged_from_events(spark, sf)
    logs = staging.parse_logs(A.log_messages(spark, sf), A.LOADED_AT)
    empty = rows.filter(F.col("device_id") == "")
    marks = {
        "telemetry": staging.high_water_mark(rows, "reading_timestamp"),
        "logs": staging.log_mark(logs),
        "empty": staging.high_water_mark(empty, "reading_timestamp"),
    }
    named = [df.select(F.lit(name).alias("source"), "high_water_mark") for name, df in marks.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


_TARGET = f"(SELECT * FROM staged WHERE reading_timestamp < {O.CUT})"


@_register(
    "incremental_new",
    f"""SELECT {_STAGED} FROM staged
        WHERE reading_timestamp > (SELECT max(reading_timestamp) FROM {_TARGET} AS t)""",
)
def _(spark, sf):
    target, rows = _split(spark, sf)
    return staging.incremental_new(rows, target, "reading_timestamp", "telemetry_id")


@_register(
    "incremental_keep_late",
    f"""SELECT {_STAGED} FROM staged
        WHERE reading_timestamp >= {O.CUT} OR status = 'WARNING'""",
)
def _(spark, sf):
    target, rows = _split(spark, sf)
    target = target.filter(F.col("status") != "WARNING")
    return staging.incremental_new(rows, target, "reading_timestamp", "telemetry_id", late="keep")


@_register(
    "late_rows",
    f"SELECT {_STAGED} FROM staged WHERE reading_timestamp < {O.CUT} AND status = 'WARNING'",
)
def _(spark, sf):
    target, rows = _split(spark, sf)
    warned = F.col("status") == "WARNING"
    return staging.late_rows(rows.filter(warned), target.filter(~warned), "reading_timestamp")


@_register(
    "lost_rows",
    f"SELECT {_STAGED} FROM staged WHERE reading_timestamp < {O.CUT} AND status = 'WARNING'",
)
def _(spark, sf):
    target, rows = _split(spark, sf)
    target = target.filter(F.col("status") != "WARNING")
    return staging.lost_rows(rows, target, "reading_timestamp", "telemetry_id")


@_register(
    "upsert_latest",
    f"""SELECT telemetry_id, device_id, customer_id, reading_timestamp,
               CASE WHEN event_type = 'signup' THEN energy_kwh * 2 ELSE energy_kwh END AS energy_kwh, voltage,
               battery_pct, status,
               CASE WHEN event_type = 'signup' THEN TIMESTAMP '2024-02-02 00:00:00' ELSE ingested_at END AS ingested_at
        FROM staged WHERE reading_timestamp < {O.CUT} OR event_type = 'signup'""",
)
def _(spark, sf):
    target, _rows = _split(spark, sf)
    again = A.staged_from_events(spark, sf, redeliver=True).filter(F.col("ingested_at") == F.lit(A.RELOADED_AT))
    corrected = again.withColumn("energy_kwh", F.col("energy_kwh") * 2)
    return staging.upsert_latest(target, corrected, "telemetry_id", ["ingested_at"])


@_register(
    "upsert_in_batch",
    f"""SELECT {_STAGED}, reading_timestamp AS sent_at FROM staged
        WHERE reading_timestamp < {O.CUT} AND event_type <> 'signup'
        UNION ALL
        SELECT telemetry_id, any_value(device_id), any_value(customer_id), any_value(reading_timestamp),
               arg_max(energy_kwh * factor, minutes), any_value(voltage), any_value(battery_pct), any_value(status),
               TIMESTAMP '2024-02-02 00:00:00', max(reading_timestamp + to_minutes(minutes))
        FROM staged CROSS JOIN (VALUES (2.0::DOUBLE, 0), (0.5::DOUBLE, 5), (1.0::DOUBLE, 3)) AS v(factor, minutes)
        WHERE event_type = 'signup' GROUP BY telemetry_id""",
)
def _(spark, sf):
    """Several versions of a reading in one load: the one sent last counts, which is the smallest."""
    target, _rows = _split(spark, sf)
    again = A.staged_from_events(spark, sf, redeliver=True).filter(F.col("ingested_at") == F.lit(A.RELOADED_AT))
    versions = [F.struct(F.lit(f).alias("factor"), F.lit(m).alias("minutes")) for f, m in ((2.0, 0), (0.5, 5), (1.0, 3))]
    sent = again.withColumn("v", F.explode(F.array(*versions))).select(
        *[c for c in again.columns if c != "energy_kwh"],
        (F.col("energy_kwh") * F.col("v.factor")).alias("energy_kwh"),
        F.timestamp_add("MINUTE", F.col("v.minutes"), F.col("reading_timestamp")).alias("sent_at"),
    )
    held = target.withColumn("sent_at", F.col("reading_timestamp"))
    return staging.upsert_latest(held, sent, "telemetry_id", ["ingested_at", "sent_at"])


@_register(
    "dedup_latest",
    """SELECT user_id, date_trunc('hour', ts) AS hour, ts, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(spark, sf):
    events = A.table(spark, sf, "events").select(
        "user_id",
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        "event_type",
        "value",
    )
    return dedup_latest(events, ["user_id", "hour"], ["ts", "event_id"])


@_register("dedup_readings", "SELECT * FROM l_clean")
def _(spark, sf):
    return rollups.latest_readings(A.readings_from_lineitem(spark, sf))


# --------------------------------------------------------------------------
# master data

_SEEDS = ", ".join(f"('{d[0]}', '{d[1]}', '{d[2]}')" for d in master.SEED_DEVICES)


@_register(
    "seed_devices",
    f"""SELECT s.device_id, s.owner, s.device_model, count(*) AS reading_count, sum(r.energy_kwh) AS total_energy_kwh
        FROM (VALUES {_SEEDS}) AS s(device_id, owner, device_model) JOIN staged AS r USING (device_id) GROUP BY ALL""",
    "total_energy_kwh",
)
def _(spark, sf):
    seeds = master.seed_devices(spark, A.LOADED_AT)
    owned = seeds.select("device_id", F.col("customer_id").alias("owner"), "device_model")
    # ten fixed rows: safe to ship to every task
    readings = A.readings_from_events(spark, sf, redeliver=False).select("device_id", "energy_kwh")
    return (
        readings.join(F.broadcast(owned), "device_id")
        .groupBy("device_id", "owner", "device_model")
        .agg(F.count(F.lit(1)).alias("reading_count"), F.sum("energy_kwh").alias("total_energy_kwh"))
    )


@_register("active_devices", "SELECT device_id, customer_id FROM device_master WHERE device_status = 'ACTIVE'")
def _(spark, sf):
    return enrich.active_devices(A.device_master(spark, sf))


@_register(
    "insert_if_absent",
    "SELECT * FROM device_master WHERE device_model <> 'BUILDING'",
)
def _(spark, sf):
    devices = A.device_master(spark, sf)
    held = devices.filter(F.col("device_model") == "BUILDING")
    return staging.insert_missing(devices.unionByName(devices), held, "device_id")


@_register(
    "insert_past_filter",
    """SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders
       WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def _(spark, sf):
    orders = A.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double"), "o_orderstatus")
    held = orders.filter(F.col("o_orderstatus") == "F").drop("o_orderstatus")
    blocks = keyfilter.blocks_for(held.count())
    found = keyfilter.key_filter(held, ["o_orderkey"], blocks)
    new = orders.drop("o_orderstatus")
    unheld, checked = keyfilter.insert_missing_filtered(new.unionByName(new), held, "o_orderkey", found, blocks)
    return unheld.unionByName(checked)


@_register(
    "join_master",
    """SELECT device_id, device_model, location, customer_name, energy_kwh, voltage, status
       FROM (SELECT customer_id, customer_name FROM customer_master) AS payer
       JOIN e_readings USING (customer_id)
       JOIN (SELECT device_id, device_model, location FROM device_master) AS meter USING (device_id)""",
)
def _(spark, sf):
    return enrich.enrich_readings(
        A.readings_from_events(spark, sf), A.device_master(spark, sf), A.customer_master(spark, sf)
    )


@_register(
    "join_master_spread",
    """SELECT e.device_id, d.device_model, d.location, c.customer_name, e.energy_kwh, e.voltage, e.status
       FROM e_readings AS e JOIN device_master AS d ON d.device_id = e.device_id
       JOIN customer_master AS c ON c.customer_id = e.customer_id""",
)
def _(spark, sf):
    return enrich.enrich_readings(
        A.readings_from_events(spark, sf), A.device_master(spark, sf), A.customer_master(spark, sf), ship=False
    )


@_register(
    "frequent_customers",
    """SELECT customer_id, CAST(ceil(count(*) * 50 / (SELECT count(*) FROM l_readings) * 2) AS BIGINT) AS parts
       FROM l_readings GROUP BY customer_id HAVING count(*) * 50 > (SELECT count(*) FROM l_readings)""",
)
def _(spark, sf):
    rows = A.readings_from_lineitem(spark, sf).select("customer_id")
    found = lookup.frequent_keys(rows, ["customer_id"], tasks=50)
    customers = rows.distinct().withColumn("_key", F.xxhash64("customer_id"))
    return customers.join(F.broadcast(found), "_key").select("customer_id", F.col("_parts").alias("parts"))


@_register(
    "pk_duplicates",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(spark, sf):
    return quality.duplicate_keys(A.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@_register(
    "fk_orphans",
    "SELECT * FROM device_master WHERE customer_id NOT IN (SELECT customer_id FROM customer_master)",
)
def _(spark, sf):
    return quality.orphans(A.device_master(spark, sf), A.customer_master(spark, sf), "customer_id")


@_register(
    "not_null_violations",
    """SELECT 'device_status' AS column_name, count(*) AS null_count FROM device_master
       WHERE device_status IS NULL HAVING count(*) > 0""",
)
def _(spark, sf):
    return quality.not_null_violations(
        A.device_master(spark, sf), ["device_id", "customer_id", "device_status"]
    )


@_register(
    "apply_defaults",
    "SELECT * REPLACE (coalesce(device_status, 'ACTIVE') AS device_status) FROM device_master",
)
def _(spark, sf):
    return quality.apply_defaults(A.device_master(spark, sf), {"device_status": F.lit("ACTIVE")})


@_register("too_long", "SELECT * FROM device_master WHERE length(device_id) > 9 OR length(device_model) > 9")
def _(spark, sf):
    return quality.too_long(A.device_master(spark, sf), {"device_id": 9, "device_model": 9})


@_register(
    "master_violations",
    """SELECT * FROM (
         SELECT 'customer_master' AS table_name, 'null' AS "check", 'customer_name' AS column_name, count(*) AS row_count
         FROM customer_master WHERE customer_name = 'ASIA'
         UNION ALL SELECT 'device_master', 'orphan', 'customer_id', count(*) FROM device_master
         WHERE customer_id NOT IN (SELECT customer_id FROM customer_master)
         UNION ALL SELECT 'device_master', 'duplicate_key', 'device_id', count(*) FROM device_master
         WHERE device_status = 'INACTIVE'
         UNION ALL SELECT 'device_master', 'too_long', 'location', 2 * count(*) FROM device_master
         WHERE device_status = 'INACTIVE') AS v WHERE row_count > 0""",
)
def _(spark, sf):
    customers = A.customer_master(spark, sf)
    named = F.nullif(F.col("customer_name"), F.lit("ASIA"))
    devices = A.device_master(spark, sf)
    stopped = F.col("device_status") == "INACTIVE"
    padded = F.when(stopped, F.rpad("location", 101, ".")).otherwise(F.col("location"))
    devices = devices.withColumn("location", padded)
    known = F.concat(F.lit("CUST-"), (F.substr("device_id", F.lit(5)).cast("int") % 5 + 8000).cast("string"))
    twice = devices.unionByName(devices.filter(stopped).withColumn("customer_id", known))
    return quality.master_violations(
        {"customer_master": customers.withColumn("customer_name", named), "device_master": twice}
    )


_COUNTED = ["customer", "supplier", "orders", "lineitem", "events"]


@_register(
    "row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED),
)
def _(spark, sf):
    return quality.row_counts({t: A.table(spark, sf, t) for t in _COUNTED})


# --------------------------------------------------------------------------
# rules

_STATUS_COUNTS = """SELECT l_suppkey, count(*) AS n, count(*) FILTER (l_linenumber = 7 AND l_returnflag = 'A') AS w
                    FROM lineitem GROUP BY l_suppkey, date_trunc('year', l_shipdate)"""


def _status_counts(spark, sf):
    items = A.table(spark, sf, "lineitem")
    warned = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "A")
    return (
        items.groupBy("l_suppkey", F.year("l_shipdate").alias("y"))
        .agg(F.count(F.lit(1)).alias("n"), R.count_where(warned).alias("w"))
        .select("l_suppkey", "n", "w")
    )


@_register(
    "health_score",
    f"SELECT l_suppkey, n, {O.HEALTH.format(ok='(n - w)', n='n')} AS health_score_pct FROM ({_STATUS_COUNTS}) AS s",
)
def _(spark, sf):
    rows = _status_counts(spark, sf)
    return rows.select("l_suppkey", "n", R.health_score(F.col("n") - F.col("w"), "n").alias("health_score_pct"))


@_register(
    "device_health_status",
    f"SELECT *, {O.DEVICE_STATE.format(w='w', n='n')} AS device_health_status FROM ({_STATUS_COUNTS}) AS s",
)
def _(spark, sf):
    return _status_counts(spark, sf).withColumn("device_health_status", R.device_health_status("w", "n"))


@_register(
    "customer_alert_status",
    f"SELECT *, {O.CUSTOMER_STATE.format(w='w', n='n')} AS customer_alert_status FROM ({_STATUS_COUNTS}) AS s",
)
def _(spark, sf):
    return _status_counts(spark, sf).withColumn("customer_alert_status", R.customer_alert_status("w", "n"))


@_register(
    "mtd_projection",
    f"""SELECT customer_id, reading_month,
               {O.rounded("avg(daily_total_energy_kwh) * day(last_day(reading_month))", 2)} AS projected_kwh
        FROM (SELECT *, CAST(date_trunc('month', reading_date) AS DATE) AS reading_month FROM l_cust_daily) AS d
        GROUP BY customer_id, reading_month""",
)
def _(spark, sf):
    days = rollups.customer_daily(_l_daily(spark, sf))
    months = days.groupBy("customer_id", C.month_start(F.col("reading_date")).alias("reading_month"))
    return months.agg(F.avg("daily_total_energy_kwh").alias("a")).select(
        "customer_id",
        "reading_month",
        R.projected_month_total("a", C.days_in_month(F.col("reading_month"))).alias("projected_kwh"),
    )


@_register(
    "latest_day_energy",
    "SELECT customer_id, last_reading_date, latest_day_energy_kwh FROM l_mtd",
    "latest_day_energy_kwh",
)
def _(spark, sf):
    readings = A.readings_from_lineitem(spark, sf)
    dates = readings.select(F.to_date("reading_timestamp").alias("reading_date"))
    mtd = rollups.customer_usage_mtd(rollups.customer_daily(_l_daily(spark, sf)), L_DAY, dates=dates)
    return mtd.select("customer_id", "last_reading_date", "latest_day_energy_kwh")


# --------------------------------------------------------------------------
# marts


@_register("device_hourly", "SELECT * FROM e_hourly", *DEVICE)
def _(spark, sf):
    return _e_hourly(spark, sf)


@_register("device_daily", "SELECT * FROM e_daily", *DEVICE)
def _(spark, sf):
    return _e_daily(spark, sf)


@_register("device_daily_years", "SELECT * FROM l_daily", *DEVICE)
def _(spark, sf):
    return _l_daily(spark, sf)


@_register("device_monthly", "SELECT * FROM l_monthly", *DEVICE)
def _(spark, sf):
    return _l_monthly(spark, sf)


@_register("customer_daily", "SELECT * FROM e_cust_daily", *CUSTOMER_DAY)
def _(spark, sf):
    return _e_customer_daily(spark, sf)


@_register("customer_daily_years", "SELECT * FROM l_cust_daily", *CUSTOMER_DAY)
def _(spark, sf):
    return rollups.customer_daily(_l_daily(spark, sf))


@_register("customer_monthly", "SELECT * FROM l_cust_monthly", *CUSTOMER_MONTH)
def _(spark, sf):
    return _l_customer_monthly(spark, sf)


@_register("customer_usage_mtd", "SELECT * FROM e_mtd", *MTD)
def _(spark, sf):
    return _e_mtd(spark, sf)


@_register("hourly_from_messages", "SELECT * FROM m_hourly", *DEVICE)
def _(spark, sf):
    return rollups.device_hourly(staging.parse_telemetry(A.telemetry_messages(spark, sf), A.LOADED_AT))


# --------------------------------------------------------------------------
# reports


@_register(
    "report_energy_by_customer_today",
    f"""SELECT customer_id, sum(daily_total_energy_kwh) AS total_energy_kwh FROM e_cust_daily
        WHERE reading_date = {O.E_DAY} GROUP BY customer_id""",
    "total_energy_kwh",
)
def _(spark, sf):
    return reports.energy_by_customer(_e_customer_daily(spark, sf, E_DAY, E_NEXT_DAY), E_DAY)


@_register(
    "report_health_trend",
    f"""SELECT reading_date, device_id, avg(health_score_pct) AS avg_health_score_pct FROM e_daily
        WHERE reading_date >= {O.E_DAY} - INTERVAL 7 DAY GROUP BY ALL""",
    "avg_health_score_pct",
)
def _(spark, sf):
    return reports.health_trend(_e_daily(spark, sf, E_WEEK), E_DAY)


_HOUR_MEANS = "SELECT device_id, hour_of_day, avg(total_energy_kwh) AS avg_energy_kwh FROM e_hourly WHERE {} GROUP BY ALL"


@_register("report_hourly_pattern", _HOUR_MEANS.format(f"reading_date = {O.E_DAY}"), "avg_energy_kwh")
def _(spark, sf):
    return reports.hourly_pattern(_e_hourly(spark, sf, E_DAY, E_NEXT_DAY), E_DAY)


@_register(
    "report_hourly_pattern_recent",
    _HOUR_MEANS.format(f"reading_hour >= {O.E_INSTANT} - INTERVAL 24 HOUR"),
    "avg_energy_kwh",
)
def _(spark, sf):
    since = (E_INSTANT - dt.timedelta(hours=24)).date()
    return reports.hourly_pattern_recent(_e_hourly(spark, sf, since), E_INSTANT)


@_register(
    "report_mtd_vs_projected",
    """SELECT sum(mtd_total_energy_kwh) AS mtd_total_energy_kwh,
              sum(projected_monthly_energy_kwh) AS projected_monthly_energy_kwh FROM e_mtd""",
    "mtd_total_energy_kwh",
    "projected_monthly_energy_kwh",
)
def _(spark, sf):
    return reports.mtd_vs_projected(_e_mtd(spark, sf))


@_register(
    "report_alert_distribution",
    f"""SELECT customer_alert_status, count(*) AS row_count FROM e_cust_daily
        WHERE reading_date = {O.E_DAY} GROUP BY 1""",
)
def _(spark, sf):
    return reports.alert_distribution(_e_customer_daily(spark, sf, E_DAY, E_NEXT_DAY), E_DAY)


@_register(
    "report_alert_distribution_all",
    "SELECT customer_alert_status, count(*) AS row_count FROM e_cust_daily GROUP BY 1",
)
def _(spark, sf):
    return reports.alert_distribution(_e_customer_daily(spark, sf), all_days=True)


@_register(
    "report_top_consumers",
    f"""SELECT customer_id, monthly_total_energy_kwh, total_devices, avg_device_health_pct FROM l_cust_monthly
        WHERE reading_month = date_trunc('month', {O.L_DAY})
        ORDER BY monthly_total_energy_kwh DESC, customer_id LIMIT 10""",
    "monthly_total_energy_kwh",
)
def _(spark, sf):
    return reports.top_consumers(_l_customer_monthly(spark, sf), L_DAY)


@_register(
    "report_device_monthly",
    f"""SELECT device_id, year, month, sum(total_energy_kwh) AS total_energy_kwh FROM l_monthly
        WHERE reading_month >= date_trunc('month', {O.L_DAY}) - INTERVAL 3 MONTH GROUP BY ALL""",
    "total_energy_kwh",
)
def _(spark, sf):
    return reports.device_months(_l_monthly(spark, sf), L_DAY)


def _trend(days: str, as_of: str, rows: int | None = 100) -> str:
    """The newest ``rows`` customer days of the week before ``as_of``."""
    return f"""
        SELECT customer_id, reading_date, daily_total_energy_kwh, active_devices, avg_device_health_pct,
               customer_alert_status
        FROM {days} WHERE reading_date >= {as_of} - INTERVAL 7 DAY
        {"" if rows is None else f"ORDER BY reading_date DESC, customer_id LIMIT {rows}"}"""


@_register("report_daily_trend", _trend("e_cust_daily", O.E_DAY), "daily_total_energy_kwh")
def _(spark, sf):
    return reports.daily_trend(_e_customer_daily(spark, sf, E_WEEK), E_DAY)


@_register(
    "report_daily_trend_years",
    _trend("l_cust_daily", O.L_DAY),
    "daily_total_energy_kwh",
)
def _(spark, sf):
    return reports.daily_trend(rollups.customer_daily(_l_daily(spark, sf)), L_DAY)


@_register("report_daily_trend_full", _trend("l_cust_daily", O.L_DAY, None), "daily_total_energy_kwh")
def _(spark, sf):
    return reports.daily_trend(rollups.customer_daily(_l_daily(spark, sf)), L_DAY, limit=None)


@_register(
    "report_daily_energy_chart",
    f"""SELECT reading_date, customer_id, sum(daily_total_energy_kwh) AS total_energy_kwh FROM e_cust_daily
        WHERE reading_date >= {O.E_DAY} - INTERVAL 7 DAY GROUP BY ALL""",
    "total_energy_kwh",
)
def _(spark, sf):
    return reports.daily_energy_chart(_e_customer_daily(spark, sf, E_WEEK), E_DAY)


_MTD_LIST = "customer_id, mtd_total_energy_kwh, avg_daily_energy_kwh, projected_monthly_energy_kwh, days_with_data, mtd_health_score_pct, mtd_alert_status"


@_register("report_mtd_listing", f"SELECT {_MTD_LIST} FROM e_mtd", "mtd_total_energy_kwh")
def _(spark, sf):
    return reports.mtd_listing(_e_mtd(spark, sf))


@_register(
    "report_mtd_alerts",
    f"""SELECT {_MTD_LIST},
               {O.rounded("mtd_total_energy_kwh / nullif(projected_monthly_energy_kwh, 0) * 100", 2)} AS pct_of_projected
        FROM l_mtd WHERE mtd_alert_status <> 'NORMAL'""",
    "mtd_total_energy_kwh",
)
def _(spark, sf):
    return reports.mtd_alerts(_l_mtd(spark, sf))


@_register(
    "report_hourly_peak",
    f"""SELECT device_id, hour_of_day, avg(total_energy_kwh) AS avg_energy, max(total_energy_kwh) AS peak_energy,
               avg(avg_voltage) AS avg_voltage
        FROM e_hourly WHERE reading_date >= {O.E_DAY} - INTERVAL 7 DAY GROUP BY device_id, hour_of_day""",
    "avg_energy",
    "peak_energy",
    "avg_voltage",
)
def _(spark, sf):
    return reports.hourly_peak(_e_hourly(spark, sf, E_WEEK), E_DAY)


@_register(
    "report_monthly_comparison",
    f"""SELECT device_id, reading_month, total_energy_kwh, active_days, health_score_pct, owned.customer_id
        FROM (FROM device_master SEMI JOIN customer_master USING (customer_id)
              SELECT device_id, customer_id) AS owned
        JOIN (SELECT * EXCLUDE (customer_id) FROM l_monthly
              WHERE date_diff('month', reading_month, {O.L_DAY}) <= 3) AS months USING (device_id)""",
    "total_energy_kwh",
)
def _(spark, sf):
    return reports.monthly_comparison(
        _l_monthly(spark, sf), A.device_master(spark, sf), A.customer_master(spark, sf), L_DAY
    )


@_register(
    "report_warning_devices",
    f"""SELECT device_id, customer_id, reading_count, warning_count, health_score_pct, device_health_status
        FROM e_daily WHERE reading_date = {O.E_DAY} AND device_health_status <> 'HEALTHY'""",
)
def _(spark, sf):
    return reports.warning_devices(_e_daily(spark, sf, E_DAY, E_NEXT_DAY), E_DAY)


@_register(
    "report_device_status_counts",
    f"""SELECT device_health_status, count(*) AS row_count FROM e_daily
        WHERE reading_date = {O.E_DAY} GROUP BY 1""",
)
def _(spark, sf):
    return reports.device_status_counts(_e_daily(spark, sf, E_DAY, E_NEXT_DAY), E_DAY)


@_register(
    "report_month_trend",
    """SELECT reading_month, sum(monthly_total_energy_kwh) AS total_energy_kwh,
              CAST(sum(total_readings) AS BIGINT) AS total_readings,
              CAST(sum(total_warnings) AS BIGINT) AS total_warnings FROM l_cust_monthly GROUP BY 1""",
    "total_energy_kwh",
)
def _(spark, sf):
    return reports.month_trend(_l_customer_monthly(spark, sf))


@_register(
    "report_active_days",
    f"SELECT device_id, customer_id, active_days FROM l_monthly WHERE reading_month = date_trunc('month', {O.L_DAY})",
)
def _(spark, sf):
    return reports.active_days(_l_monthly(spark, sf), L_DAY)


_BUDGETS = """SELECT 'CUST-' || (8000 + s_suppkey // 2) AS customer_id, sum(s_acctbal) / 10 AS budget_kwh
              FROM supplier GROUP BY 1"""


@_register(
    "report_over_budget",
    f"""SELECT customer_id, mtd_total_energy_kwh, projected_monthly_energy_kwh, budget_kwh
        FROM l_mtd JOIN ({_BUDGETS}) AS b USING (customer_id) WHERE projected_monthly_energy_kwh > budget_kwh""",
    "mtd_total_energy_kwh",
    "budget_kwh",
)
def _(spark, sf):
    suppliers = A.table(spark, sf, "supplier")
    customer = F.concat(F.lit("CUST-"), F.floor(F.col("s_suppkey") / 2 + 8000).cast("string"))
    budgets = suppliers.groupBy(customer.alias("customer_id")).agg((F.sum("s_acctbal") / 10).alias("budget_kwh"))
    return reports.over_budget(_l_mtd(spark, sf), budgets)


def _browse(name: str, key: str, sql: str, mart: Query, day: dt.date, *stable: str) -> None:
    @_register(f"browse_{key}", sql, *stable)
    def _(spark, sf):
        return reports.listed(reports.current_rows(mart(spark, sf), name, day), name)


_browse(
    "device_hourly_metrics", "device_hourly", f"SELECT * FROM e_hourly WHERE reading_date = {O.E_DAY}",
    lambda s, d: _e_hourly(s, d, E_DAY, E_NEXT_DAY), E_DAY, *DEVICE,
)
_browse(
    "device_daily_metrics", "device_daily", f"SELECT * FROM e_daily WHERE reading_date = {O.E_DAY}",
    lambda s, d: _e_daily(s, d, E_DAY, E_NEXT_DAY), E_DAY, *DEVICE,
)
_browse(
    "device_monthly_metrics", "device_monthly",
    f"SELECT * FROM l_monthly WHERE reading_month = date_trunc('month', {O.L_DAY})", _l_monthly, L_DAY, *DEVICE,
)
_browse(
    "customer_daily_usage_summary", "customer_daily", f"SELECT * FROM e_cust_daily WHERE reading_date = {O.E_DAY}",
    lambda s, d: _e_customer_daily(s, d, E_DAY, E_NEXT_DAY), E_DAY, *CUSTOMER_DAY,
)
_browse(
    "customer_monthly_usage_summary", "customer_monthly",
    f"SELECT * FROM l_cust_monthly WHERE reading_month = date_trunc('month', {O.L_DAY})",
    _l_customer_monthly, L_DAY, *CUSTOMER_MONTH,
)
_browse(
    "customer_usage_mtd_summary", "customer_mtd", "SELECT * FROM l_mtd WHERE mtd_alert_status <> 'NORMAL'",
    _l_mtd, L_DAY, *MTD,
)


# --------------------------------------------------------------------------
# grains after a change; progress and counts of loads


def _after_delta(spark, sf):
    """The grains built from readings of the first half of each hour, then maintained with all readings."""
    readings = A.readings_from_events(spark, sf)
    early = F.minute("reading_timestamp") < 30
    hours = kept(rollups.device_hourly(readings.filter(early))), kept(rollups.device_hourly(readings))
    order = deltas.grains()
    old, rows = {}, {"device_hourly_metrics": hours[0]}
    for name, grain in order.items():
        state = kept(deltas.state_of(rows[grain.source], grain))
        rows[name] = deltas.finished(state, grain)
        old[name] = state, rows[name]
    after = deltas.maintained(kept(deltas.changes(*hours)), hours[1], old, order, lambda rows, _: kept(rows))
    return {
        n: deltas.replaced(rows[n], groups, new, list(order[n].keys)) for n, (groups, _, new) in after.items()
    }, rows


@_register("daily_after_delta", "SELECT * FROM e_daily", *DEVICE)
def _(spark, sf):
    return _after_delta(spark, sf)[0]["device_daily_metrics"]


@_register("customer_monthly_after_delta", "SELECT * FROM e_cust_monthly", *CUSTOMER_MONTH)
def _(spark, sf):
    return _after_delta(spark, sf)[0]["customer_monthly_usage_summary"]


@_register("mtd_after_delta", "SELECT * FROM e_mtd", *MTD)
def _(spark, sf):
    after, before = _after_delta(spark, sf)
    grain, name = deltas.mtd_grain(E_DAY), "customer_daily_usage_summary"
    old, new = (d[name].filter(C.in_month_of("reading_date", E_DAY)) for d in (before, after))
    state, changed = deltas.state_of(old, grain), deltas.changes(old, new)
    now = deltas.replaced(
        state, deltas.touched(changed, grain), deltas.updated(state, changed, new, grain), ["customer_id"]
    )
    return rollups.with_latest_day(deltas.finished(now, grain), after[name], E_DAY)


def _as_partitions(rows):
    """Readings as messages of a topic with four partitions, numbered by time."""
    place = Window.partitionBy("_split").orderBy("reading_timestamp", "device_id", "energy_kwh")
    split = rows.withColumn("_split", F.expr("CAST(substr(device_id, 5) AS INT) % 4"))
    return split.withColumn("_offset", F.row_number().over(place).cast("bigint") - 1)


@_register(
    "offset_ledger",
    f"""SELECT load_id, split, min(place) AS start_offset, max(place) + 1 AS end_offset, count(*) AS messages
        FROM (SELECT CASE WHEN reading_timestamp < {O.CUT} THEN 'first' ELSE 'second' END AS load_id,
                     CAST(CAST(substr(device_id, 5) AS INTEGER) % 4 AS VARCHAR) AS split,
                     row_number() OVER (PARTITION BY CAST(substr(device_id, 5) AS INTEGER) % 4
                                        ORDER BY reading_timestamp, device_id, energy_kwh) - 1 AS place
              FROM staged) AS m
        GROUP BY load_id, split""",
)
def _(spark, sf):
    sent = _as_partitions(A.staged_from_events(spark, sf))
    at = F.lit(A.LOADED_AT).cast("timestamp")
    first = progress.progress_rows(sent.filter(F.col("reading_timestamp") < F.lit(CUT)), "first", "t", at)
    second = progress.progress_rows(progress.unread(sent, first, "t"), "second", "t", at)
    return first.unionByName(second).select("load_id", "split", "start_offset", "end_offset", "messages")


@_register(
    "load_counts",
    """SELECT 'first' AS load_id, CASE WHEN blank THEN 'blank' WHEN fine THEN 'staged' ELSE 'rejected' END AS fate,
               count(*) AS messages FROM sent_messages WHERE early GROUP BY 2
        UNION ALL
        SELECT 'second', CASE WHEN blank THEN 'blank' WHEN NOT fine THEN 'rejected'
                              WHEN early THEN 'copy' ELSE 'staged' END, count(*) FROM sent_messages GROUP BY 2
        UNION ALL
        SELECT 'second_drop', CASE WHEN blank THEN 'blank' WHEN NOT fine THEN 'rejected'
                                   WHEN early THEN 'lost' ELSE 'staged' END, count(*) FROM sent_messages GROUP BY 2""",
)
def _(spark, sf):
    """A first load, and a second one that finds the first one's messages again."""
    read = staging.read_telemetry(A.telemetry_messages(spark, sf), A.LOADED_AT, blanks=True)
    early = read.filter(F.col("_timestamp") < F.lit(CUT))
    held = staging.telemetry_rows(early)
    by, latest = ("reading_timestamp", "device_id"), ("ingested_at", "sent_at")
    after = F.col("reading_timestamp") > staging.high_water_mark(held, "reading_timestamp").scalar()
    loads = {
        "first": progress.fates(early, None, by, latest),
        "second": progress.fates(read, held, by, latest),
        "second_drop": progress.fates(read, held, by, latest, after),
    }
    rows = [d.select(F.lit(n).alias("load_id"), "fate", "messages") for n, d in loads.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# --------------------------------------------------------------------------
# operations on training text, where that subpackage is there

try:
    import corpus_pipeline
    from meterflow.llm import queries as _llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "meterflow.llm"):
        raise
else:
    _QUERIES.update(_llm.QUERIES)
    _ORACLES.update(_llm.ORACLES)
    _QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        _ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


# --------------------------------------------------------------------------
# contract


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: month-to-date usage, alerts and projection per customer."""
    return _QUERIES["customer_usage_mtd"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
