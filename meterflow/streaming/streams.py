"""The same pipeline as streams: offsets in a checkpoint instead of a time mark."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from meterflow import schemas
from meterflow.functions import calendar as C
from meterflow.operators import rollups, staging
from meterflow.plans import jobs
from meterflow.session import shared_dir
from meterflow.sources.tables import Lake
from meterflow.sources.topics import Topic, read_topic

# Fixed value: time between two loads.
INTERVAL = "600 seconds"
DELAY = "2 hours"


def _checkpoint(lake: Lake, name: str) -> str:
    """Folder for a stream's offsets; lakes that share a cluster folder do not share streams."""
    return f"{shared_dir(lake.spark, lake.root)}/_checkpoints/{_lake_id(lake)}/{name}"


def _lake_id(lake: Lake) -> str:
    return hashlib.sha256(lake.root.encode()).hexdigest()[:16]


def _trigger(interval: str | None) -> dict:
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def dedup_stream(readings: DataFrame, delay: str = DELAY) -> DataFrame:
    """One reading per device and time, the first to arrive.

    Copies are recognised up to ``delay`` after the newest reading; state older
    than that is dropped.
    """
    return readings.withWatermark("reading_timestamp", delay).dropDuplicatesWithinWatermark(
        rollups.READING_KEY
    )


def hourly_stream(readings: DataFrame, delay: str = DELAY) -> DataFrame:
    """Device hours of a stream of readings, each sent once its hour is ``delay`` old."""
    return _hours(dedup_stream(readings, delay)).select(*schemas.DEVICE_HOURLY.names)


def _hours(readings: DataFrame) -> DataFrame:
    hours = readings.groupBy(
        "device_id", "customer_id", F.window("reading_timestamp", "1 hour").alias("hour")
    ).agg(*rollups.reading_measures())
    return rollups.with_hour_columns(hours.withColumn("reading_hour", F.col("hour.start")))


def daily_stream(readings: DataFrame, delay: str = DELAY) -> DataFrame:
    """Device days of a stream of readings, by way of its hours."""
    days = (
        _hours(dedup_stream(readings, delay))
        .groupBy("device_id", "customer_id", F.window("hour", "1 day").alias("day"))
        .agg(*rollups.coarser_measures(), F.count("reading_hour").alias("active_hours"))
    )
    return rollups.with_device_health(days.withColumn("reading_date", F.to_date("day.start"))).select(
        *schemas.DEVICE_DAILY.names
    )


# A device's readings are dealt out to so many groups by their times, so that a busy one is no single task's work.
GROUPS = 16
VERSIONS = T.StructType([*schemas.STG_TELEMETRY.fields, T.StructField("kind", T.StringType())])
_HELD = "at array<bigint>, ingested array<bigint>, sent array<bigint>"


def _micros(times: pd.Series) -> np.ndarray:
    """Times as microseconds; a missing one is before all others."""
    return times.astype("datetime64[us]").to_numpy().astype(np.int64)


def _versions(_key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One group's readings with their kinds; its state is the newest version of each that may still be corrected."""
    mark = state.getCurrentWatermarkMs() * 1000
    held = {at: (ingested, sent) for at, ingested, sent in zip(*state.get)} if state.exists else {}
    found = pd.concat(list(frames), ignore_index=True)
    at = _micros(found["reading_timestamp"])
    ingested, sent = _micros(found["ingested_at"]), _micros(found["sent_at"])
    kind = np.where(at <= mark, "late", "copy").astype(object)
    # From the newest version on: the first of each time is the one that counts.
    for i in np.lexsort((-sent, -ingested, at)):
        if kind[i] == "late":
            continue
        time, version = int(at[i]), (int(ingested[i]), int(sent[i]))
        known = held.get(time)
        if known is None or version > known:
            kind[i] = "new" if known is None else "correction"
            held[time] = version
    times = [t for t in held if t > mark]
    if times:
        state.update((times, [held[t][0] for t in times], [held[t][1] for t in times]))
    elif state.exists:
        state.remove()
    yield found.assign(kind=kind)[VERSIONS.names]


def versions_stream(readings: DataFrame, delay: str = DELAY) -> DataFrame:
    """Every reading of a stream with what it is (``kind``): new, a correction, a copy, or late.

    Keyed state holds the newest version of each device and time, by load and then by sending time, until the
    query's watermark passes the reading; a newer version is a correction, an older or equal one
    a copy. Readings at or behind the watermark are late: they come out too, instead of being dropped, so the
    four kinds add up to what was read. A group that gets no more readings keeps the versions of its last
    ``delay``: a time-out by event time would make Spark drop late rows before they get here.
    """
    group = F.pmod(F.xxhash64("reading_timestamp"), F.lit(GROUPS)).cast("int")
    keyed = readings.withWatermark("reading_timestamp", delay).withColumn("_group", group)
    return keyed.groupBy("device_id", "_group").applyInPandasWithState(
        _versions, VERSIONS, _HELD, "append", GroupStateTimeout.NoTimeout
    )


def correcting_stream(
    lake: Lake,
    topic: Topic,
    delay: str = DELAY,
    interval: str | None = INTERVAL,
    as_of: C.AsOf = None,
    batch_ts: dt.datetime | None = None,
) -> StreamingQuery:
    """Load a telemetry topic so that corrections inside the delay win and late readings are set aside.

    New readings and corrections are merged into staging by key and the marts follow; late ones go to the
    table ``late_readings``, each batch's once, also when the batch is run again.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        run = f"versions-{_lake_id(lake)}-{batch_id}-{uuid.uuid4().hex}"
        found = lake.write_work(batch, run, "stg_telemetry_raw", "versions")
        late = found.filter("kind = 'late'").withColumn("batch", F.lit(batch_id).cast("bigint")).drop("kind")
        done = lake.exists("late_readings") and not lake.read("late_readings", F.col("batch") == batch_id).isEmpty()
        if not done:
            lake.append(late, "late_readings")
        taken = found.filter("kind in ('new', 'correction')").drop("kind")
        jobs.load_rows(lake, "stg_telemetry_raw", taken, "upsert")
        jobs.refresh_marts(lake, as_of)
        lake.clear_work(run)

    rows = staging.parse_telemetry(read_topic(lake.spark, topic, streaming=True), batch_ts)
    return (
        versions_stream(rows, delay)
        .writeStream.foreachBatch(load)
        .outputMode("append")
        .option("checkpointLocation", _checkpoint(lake, "versions"))
        .trigger(**_trigger(interval))
        .queryName("load_versions")
        .start()
    )


def load_stream(
    lake: Lake,
    name: str,
    topic: Topic,
    late: str = "upsert",
    interval: str | None = INTERVAL,
    as_of: C.AsOf = None,
    batch_ts: dt.datetime | None = None,
) -> StreamingQuery:
    """Load a topic into its staging table batch by batch and refresh the marts it touches.

    Loading is an upsert by key: new keys are appended, only corrections rewrite their dates; a batch
    that is run again after a failure leaves the same tables. Unusable messages go to
    the reject table, each once. ``interval=None``
    loads what is there and ends.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        jobs.load_messages(lake, name, batch, late, batch_ts=batch_ts)
        if name == "stg_telemetry_raw":
            jobs.refresh_marts(lake, as_of)

    return (
        read_topic(lake.spark, topic, streaming=True)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", _checkpoint(lake, name))
        .trigger(**_trigger(interval))
        .queryName(f"load_{name}")
        .start()
    )


def append_stream(
    lake: Lake, rows: DataFrame, path: str, name: str, interval: str | None = INTERVAL
) -> StreamingQuery:
    """Append finished rows of a stream to Parquet files."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", _checkpoint(lake, name))
        .trigger(**_trigger(interval))
        .queryName(name)
        .start()
    )
