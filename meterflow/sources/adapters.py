"""General-purpose tables seen as meter readings, messages and master data.

Every adapter is a narrow projection of whole tables: no row is left out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.keys import surrogate_key
from meterflow.session import use_utc
from meterflow.sources.topics import dealt_out, telemetry_body

# Load times of the first delivery and of the repeated one.
LOADED_AT = dt.datetime(2024, 2, 1)
RELOADED_AT = dt.datetime(2024, 2, 2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _device(number: Column) -> Column:
    return F.concat(F.lit("MTR-"), (number + 10000).cast("string"))


def _customer(number: Column) -> Column:
    return F.concat(F.lit("CUST-"), (number + 8000).cast("string"))


def _events(spark, sf_dir, since: dt.date | None, until: dt.date | None) -> DataFrame:
    """Events in [since, until), the range applied to the stored column so the scan can skip."""
    events = table(spark, sf_dir, "events")
    if since is not None:
        events = events.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        events = events.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return events.withColumn("k", F.from_json("props", "k INT")["k"])


def readings_from_events(
    spark: SparkSession,
    sf_dir: str,
    since: dt.date | None = None,
    until: dt.date | None = None,
    redeliver: bool = True,
) -> DataFrame:
    """One reading per event; with ``redeliver``, each signup event arrives again, later."""
    events = _events(spark, sf_dir, since, until)
    readings = events.select(
        _device(F.col("user_id")).alias("device_id"),
        _customer(F.col("user_id") % 5).alias("customer_id"),
        F.col("ts").cast("timestamp").alias("reading_timestamp"),
        F.col("value").alias("energy_kwh"),
        (F.lit(220.0) + F.col("k") * 0.2).alias("voltage"),
        (F.lit(60) + F.col("k") % 41).cast("bigint").alias("battery_pct"),
        F.when((F.col("event_type") == "error") & (F.col("k") % 10 < 3), "WARNING")
        .otherwise("OK")
        .alias("status"),
        "event_type",
        F.lit(LOADED_AT).cast("timestamp").alias("ingested_at"),
    )
    if redeliver:
        once, twice = F.array("ingested_at"), F.array("ingested_at", F.lit(RELOADED_AT).cast("timestamp"))
        loads = F.when(F.col("event_type") == "signup", twice).otherwise(once)
        readings = readings.withColumn("ingested_at", F.explode(loads))
    return readings.drop("event_type")


def staged_from_events(spark: SparkSession, sf_dir: str, redeliver: bool = False) -> DataFrame:
    """Readings from events with their staging key."""
    readings = readings_from_events(spark, sf_dir, redeliver=redeliver)
    text = F.date_format("reading_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return readings.select(surrogate_key("device_id", text).alias("telemetry_id"), *readings.columns)


def readings_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per line item: several years, two devices per customer, many equal (device, time) pairs."""
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        _device(F.col("l_suppkey")).alias("device_id"),
        _customer(F.floor(F.col("l_suppkey") / 2)).alias("customer_id"),
        F.col("l_shipdate").cast("timestamp").alias("reading_timestamp"),
        F.col("l_quantity").alias("energy_kwh"),
        (F.lit(220.0) + (F.col("l_partkey") % 100) * 0.2).alias("voltage"),
        (F.lit(60) + F.col("l_partkey") % 41).alias("battery_pct"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "A"), "WARNING")
        .otherwise("OK")
        .alias("status"),
        F.lit(LOADED_AT).cast("timestamp").alias("ingested_at"),
    )


def _as_topic(df: DataFrame, key: str, message: Column, at: str) -> DataFrame:
    """Topic rows. The one-element explode fixes the text, so that filters on its
    parsed fields do not build it again, and each message is written once."""
    rows = df.select(
        F.col(key).alias("_key"),
        F.explode(F.array(message)).alias("_message"),
        F.col(at).cast("timestamp").alias("_timestamp"),
    )
    return dealt_out(rows)


def telemetry_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry topic rows, usable ones and every kind of unusable one.

    The battery level decides whether and how a message is spoiled.
    """
    body = telemetry_body(readings_from_events(spark, sf_dir, redeliver=False))
    messages = body.withColumn("_message", F.to_json(F.struct(*body.columns)))
    battery, text = F.col("metrics.battery_pct"), F.col("_message")
    number = r"([0-9.E-]+)"
    spoiled = (
        F.when(battery == 60, F.lit("{bad"))
        .when(battery == 61, F.lit(""))
        .when(battery == 62, F.regexp_replace(text, '"device_id":"[^"]*",', ""))
        .when(battery == 63, F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"noon"'))
        .when(battery == 64, F.regexp_replace(text, f'"energy_kwh":{number}', '"energy_kwh":"much"'))
        .when(battery == 65, F.regexp_replace(text, '"timestamp":"[^"]*",', ""))
        .when(battery == 66, F.regexp_replace(text, '"battery_pct":66', '"battery_pct":65.6'))
        .when(battery == 67, F.regexp_replace(text, f'"energy_kwh":{number}', '"energy_kwh":"$1"'))
        .when(battery == 68, F.lit(None).cast("string"))
        .when(battery == 69, F.concat(text, F.lit(" "), text))
        .when(battery == 70, F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"12:30"'))
        .when(battery == 71, F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"2024"'))
        .when(battery == 72, F.regexp_replace(text, f'"energy_kwh":{number}', '"energy_kwh":"NaN"'))
        .when(battery == 73, F.regexp_replace(text, f'"voltage":{number}', '"voltage":"Infinity"'))
        .when(battery == 74, F.regexp_replace(text, f'"energy_kwh":{number}', '"energy_kwh":"1d"'))
        .when(battery == 75, F.regexp_replace(text, f'"energy_kwh":{number}', '"energy_kwh":true'))
        .when(battery == 76, F.concat(F.lit("["), text, F.lit("]")))
        .when(battery == 77, F.lit("null"))
        .when(battery == 78, F.concat(text, F.lit("]}")))
        .when(battery == 79, F.regexp_replace(text, '"timestamp":"[0-9]{4}', '"timestamp":"2099'))
        .otherwise(text)
    )
    return _as_topic(messages, "device_id", spoiled, "timestamp")


def log_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health log topic rows: each event type writes its line in another style."""
    events = _events(spark, sf_dir, None, None).select(
        _device(F.col("user_id")).alias("dev"),
        _customer(F.col("user_id") % 5).alias("cust"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.col("ts").cast("timestamp").alias("reading_timestamp"),
        F.col("k").cast("string").alias("k"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("v"),
        "event_type",
    )

    def line(*parts: str) -> Column:
        return F.concat(*[F.col(p[1:]) if p.startswith("$") else F.lit(p) for p in parts])

    styles = {
        "click": line(
            "$at", " [INFO] ", "$dev", " ", "$cust", " HEALTH_CHECK_OK status=GOOD battery=", "$k",
            " voltage=", "$v", " temp=41.5 memory=", "$k", " uptime=", "$k", " errors=0",
        ),
        "view": line(
            "[WARN] ", "$at", " ", "$dev", " ", "$cust", " MEMORY_WARNING Status: DEGRADED mem=", "$k",
            " up=300 err_cnt=", "$k",
        ),
        "error": line(
            "$at", " [ERROR] Meter ", "$dev", " of ", "$cust", " reported SENSOR_FAULT, status is FAULTY",
            " voltage=", "$v", ". battery=99999999", "$k", " temp=-5.0 backup=", "$k",
        ),
        "purchase": line("[CRITICAL] ", "$dev", " BATTERY_LOW battery=", "$k"),
    }
    message = F.when(F.lit(False), "")
    for kind, text in styles.items():
        message = message.when(F.col("event_type") == kind, text)
    message = message.otherwise(line("$at", " [INFO] no meter named, battery=", "$k"))
    return _as_topic(events, "dev", message, "reading_timestamp")


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five customers of the readings, made from the regions."""
    regions = table(spark, sf_dir, "region")
    return regions.select(
        _customer(F.col("r_regionkey")).alias("customer_id"),
        F.col("r_name").alias("customer_name"),
        F.when(F.col("r_regionkey") < 4, "ACTIVE").alias("account_status"),
    )


def device_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One device per customer row; its owner is another one than in the readings."""
    rows = table(spark, sf_dir, "customer")
    return rows.select(
        _device(F.col("c_custkey")).alias("device_id"),
        _customer(F.col("c_nationkey") % 7).alias("customer_id"),
        F.col("c_mktsegment").alias("device_model"),
        F.col("c_name").alias("location"),
        F.when(F.col("c_acctbal") < 0, "INACTIVE").when(F.col("c_acctbal") < 9000, "ACTIVE").alias("device_status"),
    )
