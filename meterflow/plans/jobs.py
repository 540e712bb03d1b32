"""Loading and refreshing the lake: staging first, then each mart from the one before."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from meterflow import schemas
from meterflow.functions import calendar as C
from meterflow.operators import deltas, progress, rollups, staging
from meterflow.operators.dedup import dedup_latest
from meterflow.operators.lookup import estimated_bytes
from meterflow.session import fitted_to_input
from meterflow.sources.tables import MARTS, STAGING, TABLES, Lake
from meterflow.sources.topics import Topic, dealt_out, read_new

# Readings are kept once per device and time, as the hourly rollup needs them;
# equal staging keys imply equal device and time.
STAGING_KEYS = {
    "stg_telemetry_raw": rollups.READING_KEY,
    "stg_meter_health_logs": ["log_id"],
}
# Of several rows with one key the last by these counts.
LATEST_BY = {"stg_telemetry_raw": ["ingested_at", "sent_at"], "stg_meter_health_logs": ["processed_at"]}
EVENT_TIME = {"stg_telemetry_raw": "reading_timestamp", "stg_meter_health_logs": "log_timestamp"}

# What each mart is built from, finest first.
MART_INPUT = {
    "device_hourly_metrics": "stg_telemetry_raw",
    "device_daily_metrics": "device_hourly_metrics",
    "device_monthly_metrics": "device_daily_metrics",
    "customer_daily_usage_summary": "device_daily_metrics",
    "customer_monthly_usage_summary": "device_monthly_metrics",
    "customer_usage_mtd_summary": "customer_daily_usage_summary",
}
MODELS = [*STAGING_KEYS, *MART_INPUT]


def selected(select: str | Iterable[str] = "all") -> list[str]:
    """Models named by ``all``, ``staging``, ``marts`` or their own names, in build order."""
    names = [select] if isinstance(select, str) else list(select)
    wanted: set[str] = set()
    for name in names:
        if name == "all":
            wanted.update(MODELS)
        elif name in ("staging", "marts"):
            layer = STAGING if name == "staging" else MARTS
            wanted.update(m for m in MODELS if TABLES[m].layer == layer)
        elif name in MODELS:
            wanted.add(name)
        else:
            raise ValueError(f"unknown model or layer {name!r}")
    return [m for m in MODELS if m in wanted]


def parse(name: str, messages: DataFrame, batch_ts: dt.datetime | None, strict: bool = False) -> DataFrame:
    step = staging.parse_telemetry if name == "stg_telemetry_raw" else staging.parse_logs
    return step(messages, batch_ts, strict=strict)


def read(
    name: str, messages: DataFrame, batch_ts: dt.datetime | None, strict: bool = False, ahead: dt.timedelta = staging.AHEAD
) -> DataFrame:
    """Every message, blank ones too, with its typed fields and, if it is unusable, why."""
    if name == "stg_telemetry_raw":
        return staging.read_telemetry(messages, batch_ts, ahead, blanks=True)
    return staging.read_logs(messages, batch_ts, strict=strict, ahead=ahead, blanks=True)


def keep_rejects(lake: Lake, name: str, found: DataFrame, batch_ts: dt.datetime | None = None) -> None:
    """Add the unusable ones of the messages read to the reject table; each message once."""
    rows = staging.rejected_rows(staging.rejects(found), name, batch_ts)
    if lake.exists("rejected_messages"):
        rows = rows.join(lake.read("rejected_messages").select("reject_id"), "reject_id", "left_anti")
    lake.append(rows, "rejected_messages")


def load_messages(
    lake: Lake,
    name: str,
    messages: DataFrame,
    late: str = "keep",
    full_refresh: bool = False,
    late_path: str | None = None,
    batch_ts: dt.datetime | None = None,
    strict: bool = False,
    ahead: dt.timedelta = staging.AHEAD,
    files: Sequence[str] | None = None,
) -> list[dt.date] | None:
    """Load the messages of a topic; the dates that changed (None: all).

    The messages are read once and counted on the way. Each gives a staging row, or a row of the reject
    table, or is blank or a copy of one that is held; with ``late="drop"`` late ones are lost. The
    counts go to the table ``load_counts``; where messages carry their place in the topic, how far
    it was read goes to ``load_ledger``, after the rows themselves. ``files`` names the files
    read, for those without a message.
    """
    load = uuid.uuid4().hex
    seen = Observation()
    reason = F.col("reject_reason")
    counted = read(name, messages, batch_ts, strict, ahead).observe(
        seen,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(reason == "blank").alias("blank"),
        F.count_if(reason != "blank").alias("rejected"),
    )
    found = lake.write_work(counted, load, name, "read")
    counts = dict(seen.get)
    if strict:
        found = staging.usable(found, strict=True)
        if counts["rejected"]:
            found.write.format("noop").mode("overwrite").save()  # fails on the first of them
    elif counts["rejected"]:
        keep_rejects(lake, name, found, batch_ts)
    rows = staging.telemetry_rows(found) if name == "stg_telemetry_raw" else staging.log_rows(found)
    dates, taken, staged = _load_rows(lake, name, rows, late, full_refresh, late_path, load)
    usable = counts["messages"] - counts["blank"] - counts["rejected"]
    taken = usable if taken is None else taken
    counts |= {"lost": usable - taken, "copies": taken - staged, "staged": staged}
    one = lake.spark.range(1).select(*progress.count_row(load, name, counts, batch_ts))
    lake.append(one, "load_counts")
    if "_split" in found.columns:
        _keep_progress(lake, name, found, load, batch_ts, full_refresh, files)
    lake.clear_work(load)
    return dates


def _keep_progress(
    lake: Lake,
    name: str,
    found: DataFrame,
    load: str,
    batch_ts: dt.datetime | None,
    full_refresh: bool,
    files: Sequence[str] | None,
) -> None:
    at = F.current_timestamp() if batch_ts is None else F.lit(batch_ts).cast("timestamp")
    rows = progress.progress_rows(found, load, name, at)
    if files:
        named = lake.spark.createDataFrame([(f,) for f in files], "split STRING")
        none = {c: F.coalesce(c, F.lit(0)) for c in ("start_offset", "end_offset", "messages")}
        rows = named.join(rows.select("split", *none), "split", "left").withColumns(
            {**none, "load_id": F.lit(load), "topic": F.lit(name), "loaded_at": at}
        )
    if full_refresh and lake.exists("load_ledger"):
        # Begun anew: what earlier loads have read of this topic no longer counts.
        others = lake.read("load_ledger").filter(F.col("topic") != name)
        rows = lake.write_work(rows.select(*schemas.LEDGER.names).unionByName(others), load, name, "ledger")
        lake.write_full(rows, "load_ledger")
    else:
        lake.append(rows, "load_ledger")


def changed_dates(rows: DataFrame, date_col: str) -> list[dt.date] | None:
    """Dates that ``rows`` has; None if some row has none, which stands for all dates."""
    dates = [r[0] for r in rows.select(date_col).distinct().collect()]
    return None if None in dates else sorted(dates)


def newest_mark(lake: Lake, name: str) -> DataFrame:
    """High-water mark of a staging table, from its newest partition that has one."""
    if name != "stg_meter_health_logs":
        return staging.high_water_mark(lake.read_newest(name), EVENT_TIME[name])
    # Lines without a time of their own don't count: go back day by day to one that has some.
    for day in reversed(lake.dates(name)):
        mark = staging.log_mark(lake.read_dates(name, [day]))
        if mark.first()["high_water_mark"] != staging.FIRST_MARK:
            return mark
    return staging.log_mark(lake.read(name))


def load_rows(
    lake: Lake,
    name: str,
    rows: DataFrame,
    late: str = "keep",
    full_refresh: bool = False,
    late_path: str | None = None,
    load: str | None = None,
) -> list[dt.date] | None:
    """Load parsed rows into a staging table; the dates that changed (None: all).

    ``late="keep"`` takes rows of any time whose key is not held yet; ``"drop"``
    takes only rows after the newest one held, and loses the others; both are
    appended. ``"upsert"`` appends new keys as well, and lets later rows replace held ones, which
    rewrites the dates of those alone. With ``late_path``, the rows that ``"drop"`` loses replace the
    files there. ``load`` names a load whose rows are in its work folder already.
    """
    return _load_rows(lake, name, rows, late, full_refresh, late_path, load)[0]


def _load_rows(
    lake: Lake,
    name: str,
    rows: DataFrame,
    late: str,
    full_refresh: bool,
    late_path: str | None,
    load: str | None,
) -> tuple[list[dt.date] | None, int | None, int]:
    """The dates that changed, how many rows weren't lost (None: all), how many are in the table now."""
    if late not in ("drop", "keep", "upsert"):
        raise ValueError(f"late must be 'drop', 'keep' or 'upsert', not {late!r}")
    keys, latest_by = STAGING_KEYS[name], LATEST_BY[name]
    if full_refresh or not lake.exists(name):
        _note_changes(lake, name, None)
        staged = Observation()
        lake.write_full(dedup_latest(rows, keys, latest_by), name, staged)
        return None, None, staged.get["n"]
    if late == "drop":
        held, mark = lake.read(name), newest_mark(lake, name)
        if late_path is not None:
            lost = staging.lost_rows(rows, held, EVENT_TIME[name], keys, mark)
            lost.write.mode("overwrite").parquet(late_path)
        rows = staging.incremental_new(rows, held, EVENT_TIME[name], keys, mark=mark)
    own = load is None
    load = load or uuid.uuid4().hex
    try:
        arrived, taken = lake.stored(rows, name), None
        if own or late == "drop":
            arrived, taken = _counted_work(lake, arrived, load, name, "arrived")
        return _merge(lake, name, arrived, taken, late, load)
    finally:
        if own:
            lake.clear_work(load)


def _counted_work(lake: Lake, rows: DataFrame, load: str, name: str, step: str) -> tuple[DataFrame, int]:
    """Rows written to the work folder of a load, and how many they are."""
    seen = Observation()
    written = lake.write_work(rows.observe(seen, F.count(F.lit(1)).alias("n")), load, name, step)
    return written, seen.get["n"]


def _merge(
    lake: Lake, name: str, arrived: DataFrame, taken: int | None, late: str, load: str
) -> tuple[list[dt.date] | None, int | None, int]:
    keys, latest_by, date_col = STAGING_KEYS[name], LATEST_BY[name], TABLES[name].date_col
    dates = changed_dates(arrived, date_col)
    if dates == []:
        return [], taken, 0
    if late == "drop" and name == "stg_telemetry_raw":
        fresh = dedup_latest(_columns(arrived, name), keys, latest_by)  # after the mark: surely not held
    else:
        held = lake.read_dates(name, dates)
        fresh = staging.incremental_new(
            _columns(arrived, name), held, EVENT_TIME[name], keys, late="keep", latest_by=latest_by
        )
    fresh, staged = _counted_work(lake, lake.stored(fresh, name), load, name, "fresh")
    dates = changed_dates(fresh, date_col)
    fixed = None
    if late == "upsert":
        fixed, n_fixed = _counted_work(
            lake, lake.stored(_corrections(lake, name, arrived), name), load, name, "fixed"
        )
        staged += n_fixed
        fixed_dates = changed_dates(fixed, date_col)
    _note_changes(lake, name, fresh if fixed is None else fresh.unionByName(fixed))
    if dates != []:
        lake.append(_columns(fresh, name), name)
    if fixed is not None and fixed_dates != []:
        held = lake.read_dates(name, fixed_dates).join(fixed.select(*keys), keys, "left_anti")
        lake.replace_dates(_columns(held, name).unionByName(_columns(fixed, name)), name, fixed_dates)
        dates = None if None in (dates, fixed_dates) else sorted({*dates, *fixed_dates})
    return dates, taken, staged


def _corrections(lake: Lake, name: str, arrived: DataFrame) -> DataFrame:
    """Rows that are later than the held row with their key, and differ from it."""
    keys, latest_by, date_col = STAGING_KEYS[name], LATEST_BY[name], TABLES[name].date_col
    rows = _columns(arrived, name)
    held = lake.read_dates(name, changed_dates(arrived, date_col))
    known = held.join(rows.select(*keys).distinct(), keys, "left_semi").select(*rows.columns)
    hit = rows.join(held.select(*keys), keys, "left_semi").select(*rows.columns)
    latest = dedup_latest(known.unionByName(hit), keys, latest_by)
    return latest.join(known, [latest[c].eqNullSafe(known[c]) for c in rows.columns], "left_anti")


def _columns(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(*TABLES[name].schema.names)


def _note_changes(lake: Lake, name: str, rows: DataFrame | None) -> None:
    """Note the device hours of changed readings (None: everything), before the table has them."""
    if name not in MART_INPUT.values():
        return
    if rows is not None:
        rows = rows.select(
            "device_id", F.date_trunc("hour", "reading_timestamp").alias("reading_hour"), "reading_date"
        ).distinct()
    lake.note_pending(rows)


def _months(dates: Sequence[dt.date] | None) -> list[dt.date] | None:
    return None if dates is None else sorted({d.replace(day=1) for d in dates})


# A mart by date is rebuilt in slices of so many input bytes, so that each slice's
# shuffle gets as many tasks as it needs.
SLICE_BYTES = 8 << 40


def build_mart(lake: Lake, name: str, dates: Sequence[dt.date] | None, as_of: C.AsOf = None) -> None:
    """Build a mart from its input table: the given dates (or their months), or all of it.

    Grains above the hour are built by way of their state, which later changes are added to.
    """
    source = MART_INPUT[name]
    if name == "customer_usage_mtd_summary":
        lake.replace_dates(rollups.customer_usage_mtd(lake.read(source), as_of), name, None)
        return
    if name == "device_hourly_metrics":
        _build(lake, name, source, dates, lambda rows: rollups.device_hourly(rows, unique=True))
        return
    grain, state = deltas.grains()[name], f"{name}_state"
    _build(lake, state, source, dates, lambda rows: deltas.state_of(rows, grain))
    _build(lake, name, state, dates, lambda rows: deltas.finished(rows, grain))


def _build(lake: Lake, name: str, source: str, dates: Sequence[dt.date] | None, step: Callable[[DataFrame], DataFrame]) -> None:
    """Replace a table's dates or months by what ``step`` makes of those of its source."""
    by_month = TABLES[name].date_col == "reading_month"
    if dates is None:
        # Whole months of days would have to stay together.
        slices = [] if by_month else lake.date_slices(source, SLICE_BYTES)
        if len(slices) > 1:
            lake.write_in_slices((step(lake.read_dates(source, days)) for days in slices), name)
        else:
            lake.write_full(step(lake.read(source)), name)
        return
    parts = _months(dates) if by_month else dates
    rows = _read_months(lake, source, parts) if by_month else lake.read_dates(source, parts)
    lake.replace_dates(step(rows), name, parts)


def _read_months(lake: Lake, name: str, months: Sequence[dt.date]) -> DataFrame:
    """The rows of whole months, of a table by month or by day."""
    if TABLES[name].date_col == "reading_month":
        return lake.read_dates(name, months)
    in_months = C.month_start(F.col("reading_date")).isin(list(months))
    # the plain range lets the scan list only the partitions it needs
    return lake.read(name, in_months & F.col("reading_date").between(months[0], _month_end(months[-1])))


def _month_end(first: dt.date) -> dt.date:
    return (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)


def _input_bytes(lake: Lake, name: str, dates: Sequence[dt.date] | None) -> int | None:
    """Size of what a mart is built from; a month counts with the days it was noted for."""
    source = MART_INPUT[name]
    by_month = TABLES[source].date_col == "reading_month"
    return lake.size(source, _months(dates) if by_month else dates)


def refresh_marts(lake: Lake, as_of: C.AsOf = None, models: Iterable[str] = tuple(MART_INPUT)) -> None:
    """Bring marts up to date with staging.

    The device hours that changed are worked out from their readings; every coarser grain takes what
    changed below it (:func:`maintain_marts`). Dates that were noted as a whole, as
    after a refresh cut short or before a first build, are rebuilt from all their readings instead.
    Notes stay until all marts have what they say.
    """
    notes, models = lake.pending_notes(), list(models)
    dates = lake.pending_dates(notes)
    tables = [*MART_INPUT, *(f"{n}_state" for n in deltas.grains())]
    if set(models) == set(MART_INPUT) and dates and all(lake.exists(t) for t in tables):
        if lake.pending(notes).filter("device_id is null").isEmpty():
            with fitted_to_input(lake.spark, lake.size("stg_telemetry_raw", dates)):
                maintain_marts(lake, notes, dates, as_of)
            return
    for name in models:
        whole = dates is None or not lake.exists(name) or name in deltas.grains() and not lake.exists(f"{name}_state")
        if whole or dates or TABLES[name].date_col is None:
            wanted = None if whole else dates
            with fitted_to_input(lake.spark, _input_bytes(lake, name, wanted)):
                build_mart(lake, name, wanted, as_of)
    if set(models) == set(MART_INPUT):
        lake.clear_pending(notes)


def maintain_marts(lake: Lake, notes: Sequence[str], dates: Sequence[dt.date], as_of: C.AsOf = None) -> None:
    """Bring the device hours named in ``notes``, and what follows from them, up to date.

    Everything is worked out before a table changes. As adding changes twice would be wrong, the dates are
    noted as a whole before the first table changes: if this is cut short they are rebuilt.
    """
    load, months = uuid.uuid4().hex, _months(dates)

    def keep(rows: DataFrame, step: str) -> DataFrame:
        return lake.write_work(rows, load, "marts", step)

    touched = keep(lake.pending(notes).select("device_id", "reading_hour").distinct(), "touched")
    keys = {c: F.col(c) for c in ("device_id", "reading_hour")}
    hour = {**keys, "reading_hour": F.date_trunc("hour", "reading_timestamp")}
    readings = deltas.of_groups(lake.read_dates("stg_telemetry_raw", dates), touched, hour)
    held = lake.read_dates("device_hourly_metrics", dates)
    new = keep(rollups.device_hourly(readings, unique=True), "hours")
    changed = keep(deltas.changes(deltas.of_groups(held, touched, keys), new), "hour-changes")
    hours = deltas.replaced(held, touched, new, list(keys))
    order = deltas.grains()
    parts = {n: months if TABLES[n].date_col == "reading_month" else dates for n in order}
    old = {n: (lake.read_dates(f"{n}_state", parts[n]), _read_months(lake, n, months)) for n in order}
    after = deltas.maintained(changed, hours, old, order, keep)
    notes = [*notes, lake.note_pending(dates)]
    lake.replace_dates(hours, "device_hourly_metrics", dates)
    for name, (groups, state, rows) in after.items():
        by = list(order[name].keys)
        for table, now in ((f"{name}_state", state), (name, rows)):
            lake.replace_dates(deltas.replaced(lake.read_dates(table, parts[name]), groups, now, by), table, parts[name])
    build_mart(lake, "customer_usage_mtd_summary", None, as_of)
    lake.clear_pending(notes)
    lake.clear_work(load)


def run(
    lake: Lake,
    topics: Mapping[str, Topic],
    select: str | Iterable[str] = "all",
    full_refresh: bool = False,
    late: str = "keep",
    as_of: C.AsOf = None,
    batch_ts: dt.datetime | None = None,
    strict: bool = False,
    only_changed: bool = True,
    late_paths: Mapping[str, str] | None = None,
    ahead: dt.timedelta = staging.AHEAD,
) -> dict[str, list[dt.date] | None]:
    """Build the selected models in order; per staging table, the dates that changed.

    Of a topic only what no load has read before is scanned, by the ledger's offsets or file names.
    Marts are refreshed for changed dates only, unless ``only_changed`` is off.
    The first error stops the run; the next run takes up what it left.
    """
    models = selected(select)
    changed: dict[str, list[dt.date] | None] = {}
    for name in (m for m in models if m in STAGING_KEYS and m in topics):
        done = None
        if not full_refresh and lake.exists(name) and lake.exists("load_ledger"):
            done = progress.ends(lake.read("load_ledger"), name)
        messages, files = read_new(lake.spark, topics[name], done)
        if files == [] and done is not None:
            changed[name] = []
            continue
        with fitted_to_input(lake.spark, estimated_bytes(messages)):
            changed[name] = load_messages(
                lake,
                name,
                dealt_out(messages),
                late,
                full_refresh,
                (late_paths or {}).get(name),
                batch_ts,
                strict,
                ahead,
                files,
            )
    marts = [m for m in models if m in MART_INPUT]
    if marts and (full_refresh or not only_changed):
        lake.note_pending(None)
    refresh_marts(lake, as_of, marts)
    return changed
