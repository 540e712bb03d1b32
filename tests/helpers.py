"""Small builders and brute-force twins used by several tests."""

from __future__ import annotations

import datetime as dt
import json
from collections import defaultdict

from meterflow import schemas

UTC = dt.timezone.utc
LOADED = dt.datetime(2025, 12, 10)


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def dicts_of(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r.asDict() for r in df.collect()}


def topic_rows(spark, messages, at="2025-12-09T00:00:00"):
    return spark.createDataFrame([("k", m, ts(at)) for m in messages], schemas.TOPIC)


def message(device="MTR-1", customer="CUST-1", at="2025-12-09T06:25:40Z", energy=0.5, volts=230.0, battery=80, status="OK"):
    return json.dumps(
        {
            "device_id": device,
            "customer_id": customer,
            "timestamp": at,
            "metrics": {"energy_kwh": energy, "voltage": volts, "battery_pct": battery},
            "status": status,
        }
    )


READING_FIELDS = [f for f in schemas.STG_TELEMETRY.names if f not in ("telemetry_id", "sent_at")]


def readings(spark, rows):
    """rows: (device, customer, time, energy, volts, battery, status[, ingested])"""
    full = [(*r[:2], ts(r[2]), *r[3:7], r[7] if len(r) > 7 else LOADED) for r in rows]
    schema = schemas.T.StructType([schemas.STG_TELEMETRY[f] for f in READING_FIELDS])
    return spark.createDataFrame(full, schema)


def brute_hourly(rows):
    """Device hours by plain Python from the same tuples as :func:`readings`."""
    latest = {}
    for r in rows:
        key = (r[0], ts(r[2]))
        if key not in latest or (r[7] if len(r) > 7 else LOADED) > (latest[key][7] if len(latest[key]) > 7 else LOADED):
            latest[key] = r
    groups = defaultdict(list)
    for r in latest.values():
        groups[r[0], r[1], ts(r[2]).replace(minute=0, second=0, microsecond=0)].append(r)
    out = {}
    for key, rs in groups.items():
        warn = sum(r[6] == "WARNING" for r in rs)
        out[key] = {
            "total_energy_kwh": sum(r[3] for r in rs),
            "avg_voltage": sum(r[4] for r in rs) / len(rs),
            "reading_count": len(rs),
            "warning_count": warn,
            "ok_count": sum(r[6] == "OK" for r in rs),
        }
    return out
