"""From messages to typed staging rows, and the ways to load them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow import schemas
from meterflow.functions import parsing as P
from meterflow.functions.keys import surrogate_key, timestamp_text
from meterflow.operators.dedup import dedup_latest, first_of_each

# Fixed value: the mark of a table that holds no rows yet.
FIRST_MARK = dt.datetime(2000, 1, 1)


def _load_time(batch_ts: dt.datetime | None) -> Column:
    return F.current_timestamp() if batch_ts is None else F.lit(batch_ts).cast("timestamp")


# A reading may be ahead of the load by so much; beyond that the device's clock is wrong,
# and one such reading would move the high-water mark past all others.
AHEAD = dt.timedelta(days=1)


def _too_far_ahead(at: Column, loaded: Column, ahead: dt.timedelta) -> Column:
    return F.coalesce(at > loaded + F.lit(ahead), F.lit(False))


# --------------------------------------------------------------------------
# telemetry


def _json_message() -> tuple[Column, Column]:
    """The message's one object, and whether the text is anything but one object of that shape.

    Spark stops reading at the end of the first value. Inside brackets it goes on, so
    that text or another object after the first is seen. Only a closing bracket in
    the message itself could hide the rest, or a value where an object is expected:
    those messages are read a second time, inside an object.
    """
    text = F.col("_message")
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schemas.TELEMETRY_JSON))
    holder = T.StructType(
        [T.StructField("m", schemas.TELEMETRY_JSON), T.StructField("_corrupt_record", T.StringType())]
    )
    held = F.from_json(
        F.concat(F.lit('{"m":'), text, F.lit("}")), holder, {"columnNameOfCorruptRecord": "_corrupt_record"}
    )
    first = F.try_element_at("listed", F.lit(1))
    unsure = F.contains(text, F.lit("]")) | first["metrics"].isNull()
    wrong = (
        F.when(F.coalesce(F.size("listed"), F.lit(0)) != 1, True)
        .when(first.isNull(), True)
        .when(unsure, F.exists(F.array(held), lambda h: h["_corrupt_record"].isNotNull() | h["m"].isNull()))
        .otherwise(False)
    )
    return listed, F.struct(first.alias("m"), wrong.alias("wrong"))


# Where a message stands in its topic, carried along where a reader gives it.
PLACE = ("_split", "_offset")


def _messages(messages: DataFrame, blanks: bool) -> tuple[DataFrame, list[str]]:
    """Messages to read and their columns; those without text only with ``blanks``."""
    kept = ["_key", "_message", "_timestamp", *(c for c in PLACE if c in messages.columns)]
    return (messages if blanks else messages.filter(P.has_text("_message"))), kept


def read_telemetry(
    messages: DataFrame, batch_ts: dt.datetime | None = None, ahead: dt.timedelta = AHEAD, blanks: bool = False
) -> DataFrame:
    """Every non-empty message with its typed fields and, if it is unusable, why (``reject_reason``).

    With ``blanks`` the empty ones stay too, as ``blank``.

    The parsed message and its typed fields go through one-element explodes: a filter
    on them cannot move below, so each message is parsed and each field is matched
    and cast once and not a second time inside the filter.
    """
    listed, checked = _json_message()
    text, kept = _messages(messages, blanks)
    text = text.select(*kept, F.explode(F.array(listed)).alias("listed"))
    text = text.select(*kept, F.explode(F.array(checked)).alias("c"))
    metrics = F.col("c.m.metrics")
    fields = F.struct(
        P.iso_time(F.col("c.m.timestamp")).alias("at"),
        P.any_number(metrics["energy_kwh"]).alias("energy_kwh"),
        P.any_number(metrics["voltage"]).alias("voltage"),
        P.whole_number(metrics["battery_pct"]).alias("battery_pct"),
    )
    text = text.select(*kept, "c", F.explode(F.array(fields)).alias("t"))
    loaded = _load_time(batch_ts)
    typed = text.select(
        *kept,
        F.col("c.m.device_id").alias("device_id"),
        F.col("c.m.customer_id").alias("customer_id"),
        F.col("c.m.timestamp").alias("time_text"),
        F.col("t.at").alias("reading_timestamp"),
        P.finite(F.col("t.energy_kwh")).alias("energy_kwh"),
        P.finite(F.col("t.voltage")).alias("voltage"),
        F.col("t.battery_pct").alias("battery_pct"),
        F.col("c.m.status").alias("status"),
        loaded.alias("ingested_at"),
        F.col("_timestamp").alias("sent_at"),
        F.col("c.wrong").alias("_malformed"),
        F.col("c.m.metrics").alias("_text"),
    )
    unreadable_number = F.lit(False)
    for name in ("energy_kwh", "voltage", "battery_pct"):
        unreadable_number |= F.col(f"_text.{name}").isNotNull() & F.col(name).isNull()
    return typed.select(
        *[c for c in typed.columns if c not in ("_malformed", "_text")],
        _blank(blanks).when(F.col("_malformed"), "malformed_json")
        .when(F.col("device_id").isNull(), "missing_device")
        .when(F.col("time_text").isNull(), "missing_timestamp")
        .when(F.col("reading_timestamp").isNull(), "unreadable_timestamp")
        .when(_too_far_ahead(F.col("reading_timestamp"), F.col("ingested_at"), ahead), "time_ahead")
        .when(unreadable_number, "unreadable_number")
        .alias("reject_reason"),
    )


def _blank(blanks: bool) -> Column:
    """Start of the reasons: without text, where such messages are kept."""
    return F.when(~P.has_text("_message") if blanks else F.lit(False), "blank")


def usable(read: DataFrame, strict: bool = False) -> DataFrame:
    """Messages read without a reason to reject them; with ``strict`` the first other one fails the job."""
    fine = F.col("reject_reason").isNull()
    if strict:
        read = read.filter(~F.col("reject_reason").eqNullSafe("blank"))
        stop = F.raise_error(F.concat_ws(": ", "reject_reason", "_message")).cast("boolean")
        fine = F.when(fine, F.lit(True)).otherwise(stop)
    return read.filter(fine)


def telemetry_rows(read: DataFrame, strict: bool = False) -> DataFrame:
    """Staging rows of what :func:`read_telemetry` found usable."""
    rows = usable(read, strict).withColumn("telemetry_id", surrogate_key("device_id", "time_text"))
    return rows.select(*schemas.STG_TELEMETRY.names)


def parse_telemetry(
    messages: DataFrame,
    batch_ts: dt.datetime | None = None,
    strict: bool = False,
    ahead: dt.timedelta = AHEAD,
) -> DataFrame:
    """Typed readings from JSON messages.

    Unusable messages are left to :func:`parse_rejects`; with ``strict`` the
    first one fails the job instead.
    """
    return telemetry_rows(read_telemetry(messages, batch_ts, ahead), strict)


def rejects(read: DataFrame) -> DataFrame:
    """Messages read that give no row, with the reason."""
    return read.filter(F.col("reject_reason") != "blank").select("_key", "_message", "_timestamp", "reject_reason")


def parse_rejects(
    messages: DataFrame, batch_ts: dt.datetime | None = None, ahead: dt.timedelta = AHEAD
) -> DataFrame:
    """Messages that give no reading, with the reason."""
    return rejects(read_telemetry(messages, batch_ts, ahead))


def rejected_rows(found: DataFrame, topic: str, batch_ts: dt.datetime | None = None) -> DataFrame:
    """Rejected messages as rows of the reject table; copies of one message are one row."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("_key", "_message", "_timestamp")]
    rows = found.withColumns(
        {
            "reject_id": F.md5(F.concat_ws("\1", F.lit(topic), *text)),
            "topic": F.lit(topic),
            "rejected_at": _load_time(batch_ts),
        }
    )
    return rows.select(*schemas.REJECTS.names).dropDuplicates(["reject_id"])


# --------------------------------------------------------------------------
# health logs


def read_logs(
    messages: DataFrame,
    batch_ts: dt.datetime | None = None,
    fallback: str = "broker",
    strict: bool = False,
    ahead: dt.timedelta = AHEAD,
    blanks: bool = False,
) -> DataFrame:
    """Every non-empty line with its typed fields and, if it is unusable, why (``reject_reason``).

    A line without a readable time takes the broker's time of the message
    (``fallback="broker"``: the same on every run) or the load time
    (``"batch"``). With ``strict`` a number that does not fit its type fails the
    job; otherwise it becomes NULL.
    """
    if fallback not in ("broker", "batch"):
        raise ValueError(f"fallback must be 'broker' or 'batch', not {fallback!r}")
    line = F.col("_message")
    loaded = _load_time(batch_ts)
    other_time = F.coalesce(F.col("_timestamp"), loaded) if fallback == "broker" else loaded

    def number(dtype: str, *patterns: str) -> Column:
        if not strict:
            return P.first_log_field(line, dtype, *patterns)
        return F.coalesce(*[P.log_field(line, p).cast(dtype) for p in patterns])

    names_device = P.log_field(line, "device").isNotNull()
    lines, kept = _messages(messages, blanks)
    parsed = lines.select(
        *kept,
        F.coalesce(P.log_time(line), other_time).alias("log_timestamp"),
        P.log_field(line, "level").alias("log_level"),
        P.log_field(line, "device").alias("device_id"),
        P.log_field(line, "customer").alias("customer_id"),
        P.log_field(line, "event").alias("health_event"),
        F.coalesce(
            *[P.log_field(line, p) for p in ("status", "status_label", "status_prose")],
            F.lit("UNKNOWN"),
        ).alias("health_status"),
        number("int", "battery").alias("battery_pct"),
        number("double", "voltage").alias("voltage_v"),
        number("double", "temperature").alias("temperature_c"),
        number("int", "memory", "memory_short").alias("memory_usage_pct"),
        number("int", "uptime", "uptime_short").alias("uptime_hours"),
        F.coalesce(number("int", "errors", "errors_short"), F.lit(0)).alias("error_count"),
        line.alias("raw_log_message"),
    )
    return parsed.withColumns(
        {
            "processed_at": loaded,
            "log_id": surrogate_key("device_id", timestamp_text(F.col("log_timestamp")), "raw_log_message"),
            "reject_reason": _blank(blanks).when(~names_device, "missing_device").when(
                _too_far_ahead(P.log_time(line), loaded, ahead), "time_ahead"
            ),
        }
    )


def log_rows(read: DataFrame) -> DataFrame:
    """Staging rows of what :func:`read_logs` found usable."""
    return usable(read).select(*schemas.STG_HEALTH_LOGS.names)


def parse_logs(
    messages: DataFrame,
    batch_ts: dt.datetime | None = None,
    fallback: str = "broker",
    strict: bool = False,
    ahead: dt.timedelta = AHEAD,
) -> DataFrame:
    """Typed health log rows from plain text lines that name a device."""
    return log_rows(read_logs(messages, batch_ts, fallback, strict, ahead))


# --------------------------------------------------------------------------
# loading


def high_water_mark(
    target: DataFrame, ts_col: str, default: dt.datetime = FIRST_MARK, where: Column | None = None
) -> DataFrame:
    """One row, one column ``high_water_mark``: the latest time loaded so far.

    ``where`` leaves rows out of the mark, such as log lines that only carry a
    made-up time.
    """
    rows = target if where is None else target.filter(where)
    mark = F.coalesce(F.max(ts_col), F.lit(default).cast("timestamp"))
    return rows.agg(mark.alias("high_water_mark"))


def log_mark(target: DataFrame) -> DataFrame:
    """Mark of the log table over lines that have their own time."""
    return high_water_mark(
        target, "log_timestamp", where=P.log_time(F.col("raw_log_message")).isNotNull()
    )


def incremental_new(
    new: DataFrame,
    target: DataFrame | None,
    ts_col: str,
    key: str | Sequence[str],
    late: str = "drop",
    mark: DataFrame | None = None,
    latest_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Rows of ``new`` to load into ``target`` (None on the first build: all of them).

    ``late="drop"`` takes rows strictly after the mark of the whole table, so a
    device that reports late loses rows. ``late="keep"`` takes every row whose
    key the table does not hold yet, of several the last by ``latest_by``
    (by default ``ts_col``).
    """
    if target is None:
        return new
    if late == "drop":
        mark = high_water_mark(target, ts_col) if mark is None else mark
        return new.filter(F.col(ts_col) > mark.scalar())
    if late == "keep":
        keys = [key] if isinstance(key, str) else list(key)
        held = target.select(*keys)
        return dedup_latest(new, keys, latest_by or [ts_col]).join(held, keys, "left_anti")
    raise ValueError(f"late must be 'drop' or 'keep', not {late!r}")


def late_rows(
    new: DataFrame, target: DataFrame, ts_col: str, mark: DataFrame | None = None
) -> DataFrame:
    """Rows the strict mark leaves out: not after it, or without a time."""
    mark = high_water_mark(target, ts_col) if mark is None else mark
    return new.filter(~F.coalesce(F.col(ts_col) > mark.scalar(), F.lit(False)))


def lost_rows(
    new: DataFrame, target: DataFrame, ts_col: str, key: str | Sequence[str], mark: DataFrame | None = None
) -> DataFrame:
    """Rows that ``late="drop"`` loses for good: late and not held, one per key."""
    keys = [key] if isinstance(key, str) else list(key)
    late = dedup_latest(late_rows(new, target, ts_col, mark), keys, [ts_col])
    return late.join(target.select(*keys), keys, "left_anti")


def upsert_latest(
    target: DataFrame, new: DataFrame, key: str | Sequence[str], latest_by: Sequence[str | Column]
) -> DataFrame:
    """``target`` with ``new`` merged in: one row per key, the latest."""
    keys = [key] if isinstance(key, str) else list(key)
    return dedup_latest(target.unionByName(new), keys, latest_by)


def insert_missing(new: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key ``target`` lacks, one per key."""
    return first_of_each(new, [key]).join(target.select(key), key, "left_anti")
