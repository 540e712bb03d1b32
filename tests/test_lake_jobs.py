"""Loading, refreshing and selecting models in a lake on disk."""

import datetime as dt
import json
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from meterflow.operators import progress, rollups, staging
from meterflow.plans import jobs
from meterflow.session import fitted_to_input
from meterflow.sources.master import Master, add_missing, read_master, seed_customers, seed_devices
from meterflow.sources.tables import TABLES, Lake
from meterflow.sources.topics import Topic, read_new, read_topic, telemetry_body, to_records
from tests.helpers import LOADED, message, readings, rows_of, topic_rows, ts

AS_OF = dt.date(2025, 1, 20)
pytestmark = pytest.mark.usefixtures("interpreted")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def messages(days, devices=("MTR-1", "MTR-2", "MTR-3"), energy=1.0, hours=(1, 5)):
    return [
        message(device=d, customer=f"CUST-{int(d[-1]) % 2}", at=f"2025-01-{day:02d}T{h:02d}:10:00Z", energy=energy,
                volts=220.0 + day, status="WARNING" if (day + h) % 7 == 0 else "OK")
        for d in devices for day in days for h in hours
    ]


LINES = ["2025-01-02 06:00:00 [INFO] MTR-1 CUST-1 HEALTH_CHECK_OK status=GOOD battery=85",
         "[WARN] 2025-01-03 07:00:00 MTR-2 CUST-0 MEMORY_WARNING Status: DEGRADED mem=91"]


class Topics:
    """Two file topics that messages can be added to."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.topics = {
            "stg_telemetry_raw": Topic("parquet", path=f"{root}/telemetry"),
            "stg_meter_health_logs": Topic("parquet", path=f"{root}/logs"),
        }

    def send(self, texts, topic="telemetry"):
        topic_rows(self.spark, texts).coalesce(1).write.mode("append").parquet(f"{self.root}/{topic}")


@pytest.fixture
def topics(spark, tmp_path):
    t = Topics(spark, str(tmp_path / "topics"))
    t.send(LINES, "logs")
    return t


def run(lake, topics, **kw):
    return jobs.run(lake, topics.topics, **{"as_of": AS_OF, "batch_ts": LOADED, **kw})


def expected_marts(lake):
    hourly = rollups.device_hourly(lake.read("stg_telemetry_raw"))
    daily = rollups.device_daily(hourly)
    monthly = rollups.device_monthly(daily)
    customer_daily = rollups.customer_daily(daily)
    return {
        "device_hourly_metrics": hourly,
        "device_daily_metrics": daily,
        "device_monthly_metrics": monthly,
        "customer_daily_usage_summary": customer_daily,
        "customer_monthly_usage_summary": rollups.customer_monthly(monthly),
        "customer_usage_mtd_summary": rollups.customer_usage_mtd(customer_daily, AS_OF),
    }


def assert_marts_current(lake):
    for name, df in expected_marts(lake).items():
        assert rows_of(lake.read(name)) == rows_of(df), name


def test_full_run(lake, topics):
    topics.send(messages(range(1, 5)))
    changed = run(lake, topics)
    assert changed == {"stg_telemetry_raw": None, "stg_meter_health_logs": None}
    assert lake.read("stg_telemetry_raw").count() == 24
    assert lake.read("stg_meter_health_logs").count() == 2
    assert lake.read("device_hourly_metrics").schema.names == TABLES["device_hourly_metrics"].schema.names
    assert_marts_current(lake)
    assert lake.pending_dates() == []


def test_second_run_without_news_changes_nothing(lake, topics):
    topics.send(messages(range(1, 4)))
    run(lake, topics)
    before = rows_of(lake.read("stg_telemetry_raw"))
    assert run(lake, topics, batch_ts=LOADED + dt.timedelta(days=1)) == {
        "stg_telemetry_raw": [], "stg_meter_health_logs": []}
    assert rows_of(lake.read("stg_telemetry_raw")) == before
    assert_marts_current(lake)


def test_slices_equal_one_load(lake, topics, spark, tmp_path):
    for days in (range(1, 4), range(4, 8), range(8, 10)):
        topics.send(messages(days))
        run(lake, topics)
    whole = Lake(spark, str(tmp_path / "whole"))
    run(whole, topics)
    for name in jobs.MODELS:
        assert rows_of(lake.read(name)) == rows_of(whole.read(name)), name


def test_only_changed_dates_are_rewritten(lake, topics, tmp_path):
    topics.send(messages(range(1, 4)))
    run(lake, topics)
    def files():
        found = (f.split("/") for f in lake.read("device_daily_metrics").inputFiles())
        return {f[-2]: f[-1] for f in found}

    old = files()
    topics.send(messages([4]))
    assert run(lake, topics)["stg_telemetry_raw"] == [dt.date(2025, 1, 4)]
    new = files()
    assert {d for d in new if new[d] != old.get(d)} == {"reading_date=2025-01-04"}
    assert_marts_current(lake)


def test_late_device_is_dropped_or_kept(lake, topics, spark, tmp_path):
    """A history published device by device: the first one moves the mark to the end."""
    kept = Lake(spark, str(tmp_path / "kept"))
    topics.send(messages(range(1, 6), devices=["MTR-1"]))
    run(lake, topics)
    run(kept, topics)
    topics.send(messages(range(1, 6), devices=["MTR-2"]))
    lost = str(tmp_path / "lost")
    assert run(lake, topics, late="drop", late_paths={"stg_telemetry_raw": lost})["stg_telemetry_raw"] == []
    assert [tuple(r) for r in spark.read.parquet(lost).groupBy("device_id").count().collect()] == [("MTR-2", 10)]
    assert len(run(kept, topics, late="keep")["stg_telemetry_raw"]) == 5
    assert lake.read("stg_telemetry_raw").select("device_id").distinct().count() == 1
    assert kept.read("stg_telemetry_raw").select("device_id").distinct().count() == 2
    assert_marts_current(kept)


def test_corrections(lake, topics):
    topics.send(messages([1, 2]))
    run(lake, topics)
    topics.send(messages([2], energy=9.0))
    later = LOADED + dt.timedelta(days=1)
    run(lake, topics, late="keep", batch_ts=later)
    assert lake.read("stg_telemetry_raw").filter("energy_kwh = 9").count() == 0
    rows = jobs.parse("stg_telemetry_raw", topic_rows(lake.spark, messages([2], energy=9.0)), later)
    assert jobs.load_rows(lake, "stg_telemetry_raw", rows, late="upsert") == [dt.date(2025, 1, 2)]
    jobs.refresh_marts(lake, AS_OF)
    assert lake.read("stg_telemetry_raw").filter("energy_kwh = 9").count() == 6
    assert lake.read("stg_telemetry_raw").count() == 12
    assert_marts_current(lake)


def test_run_cut_short_is_made_good(lake, topics, monkeypatch):
    topics.send(messages([1, 2]))
    run(lake, topics)
    topics.send(messages([3]))
    with monkeypatch.context() as m:
        m.setattr(jobs, "build_mart", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run(lake, topics)
    assert lake.pending_dates() == [dt.date(2025, 1, 3)]
    run(lake, topics)
    assert lake.pending_dates() == []
    assert_marts_current(lake)


def test_failed_full_write_keeps_the_old_table(lake, spark):
    good = readings(spark, [("D", "C", "2025-01-01T00:00:00", 1.0, 230.0, 80, "OK")]).withColumns(
        {"telemetry_id": F.lit("x"), "sent_at": F.lit(None).cast("timestamp")}
    )
    lake.write_full(good, "stg_telemetry_raw")
    bad = good.withColumn("status", F.when(F.col("device_id") == "D", F.raise_error(F.lit("boom")).cast("string")))
    with pytest.raises(Exception):
        lake.write_full(bad, "stg_telemetry_raw")
    assert lake.read("stg_telemetry_raw").count() == 1


def test_full_refresh(lake, topics):
    topics.send(messages([1, 2]))
    run(lake, topics)
    run(lake, topics, full_refresh=True, batch_ts=LOADED + dt.timedelta(days=1))
    assert lake.read("stg_telemetry_raw").select("ingested_at").distinct().count() == 1
    assert lake.read("stg_telemetry_raw").count() == 12
    assert_marts_current(lake)


def test_select():
    assert jobs.selected() == jobs.MODELS
    assert jobs.selected("staging") == ["stg_telemetry_raw", "stg_meter_health_logs"]
    assert jobs.selected("marts") == list(jobs.MART_INPUT)
    assert jobs.selected(["device_daily_metrics", "device_hourly_metrics"]) == [
        "device_hourly_metrics", "device_daily_metrics"]
    with pytest.raises(ValueError):
        jobs.selected("nothing")


def test_run_of_one_layer(lake, topics):
    topics.send(messages([1]))
    run(lake, topics, select="staging")
    assert lake.exists("stg_telemetry_raw") and not lake.exists("device_hourly_metrics")
    assert lake.pending_dates() is None
    run(lake, topics, select="marts")
    assert_marts_current(lake)


def test_newest_mark_reads_one_partition(lake, topics):
    topics.send(messages([1, 2, 3]))
    run(lake, topics)
    assert lake.dates("stg_telemetry_raw")[-1] == dt.date(2025, 1, 3)
    assert jobs.newest_mark(lake, "stg_telemetry_raw").first()[0] == ts("2025-01-03T05:10:00")
    # Only the folder of that day is listed.
    files = lake.read_newest("stg_telemetry_raw").inputFiles()
    assert files and all("reading_date=2025-01-03" in f for f in files)
    assert jobs.newest_mark(lake, "stg_meter_health_logs").first()[0] == ts("2025-01-03T07:00:00")
    # A later day that has only lines without a time of their own doesn't count.
    topics.send(["[INFO] MTR-1 HEALTH_CHECK_OK"], "logs")
    run(lake, topics)
    assert lake.dates("stg_meter_health_logs")[-1] == dt.date(2025, 12, 9)
    assert jobs.newest_mark(lake, "stg_meter_health_logs").first()[0] == ts("2025-01-03T07:00:00")


def test_sql_namespaces(lake, topics, spark):
    topics.send(messages([1, 2]))
    run(lake, topics)
    lake.register()
    got = spark.sql("SELECT count(*) n FROM energy_data_marts.device_daily_metrics WHERE reading_date = DATE '2025-01-02'")
    assert got.first().n == 3
    assert spark.sql("SELECT count(*) n FROM energy_data_staging.stg_telemetry_raw").first().n == 12


# ---------------------------------------------------------------------------


def test_topics_from_files(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines/a.txt").write_text("\n".join(LINES))
    text = read_topic(spark, Topic("text", path=str(tmp_path / "lines")))
    assert text.schema.names == ["_key", "_message", "_timestamp"]
    assert staging.parse_logs(text, LOADED).count() == 2
    (tmp_path / "json").mkdir()
    (tmp_path / "json/a.json").write_text(json.dumps({"_key": "k", "_message": message(), "_timestamp": "2025-01-01T00:00:00Z"}))
    assert staging.parse_telemetry(read_topic(spark, Topic("json", path=str(tmp_path / "json"))), LOADED).count() == 1
    with pytest.raises(ValueError):
        read_topic(spark, Topic("pigeon", path="x"))


def test_kafka_options():
    topic = Topic("kafka", servers="broker:9092", name="default.telemetry_raw", expected_messages=25_001, max_per_trigger=500)
    batch, stream = topic.source_options(False), topic.source_options(True)
    assert batch["minPartitions"] == "3" and "maxOffsetsPerTrigger" not in batch
    assert stream["maxOffsetsPerTrigger"] == "500" and stream["subscribe"] == "default.telemetry_raw"


def test_records_round_trip(spark):
    rows = readings(spark, [("MTR-1", "CUST-1", "2025-01-01T00:00:00", 1.25, 230.5, 80, "OK")])
    record = to_records(telemetry_body(rows), "device_id").first()
    assert record.key == "MTR-1"
    back = staging.parse_telemetry(topic_rows(spark, [record.value]), LOADED).drop("telemetry_id", "sent_at")
    assert rows_of(back) == rows_of(rows)


def test_seeding_twice_adds_nothing(spark, tmp_path):
    source = Master(path=str(tmp_path))
    for _ in range(2):
        add_missing(spark, source, "customer_master", seed_customers(spark, LOADED))
        add_missing(spark, source, "device_master", seed_devices(spark, LOADED))
    assert read_master(spark, source, "customer_master").count() == 5
    assert read_master(spark, source, "device_master").count() == 10


def test_shuffles_fit_the_input(spark):
    width, split = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(width), spark.conf.get(split)
    for size, wide in ((None, old[0]), (1 << 20, old[0]), (1 << 40, "2048"), (100 << 40, "20000")):
        with fitted_to_input(spark, size):
            assert spark.conf.get(width) == wide
            assert (spark.conf.get(split) == "512m") == (size == 100 << 40)
        assert (spark.conf.get(width), spark.conf.get(split)) == old


def test_size_of_dates(lake, topics):
    topics.send(messages([1, 2]))
    run(lake, topics, select="staging")
    one, none = [dt.date(2025, 1, 1)], [dt.date(2030, 1, 1)]
    assert 0 == lake.size("stg_telemetry_raw", none) < lake.size("stg_telemetry_raw", one)
    assert lake.size("stg_telemetry_raw", one) < lake.size("stg_telemetry_raw", None)


def test_master_from_files(spark, tmp_path):
    seed_customers(spark, LOADED).write.parquet(str(tmp_path / "customer_master"))
    seed_devices(spark, LOADED).write.parquet(str(tmp_path / "device_master"))
    source = Master(path=str(tmp_path))
    assert read_master(spark, source, "customer_master").count() == 5
    devices = read_master(spark, source, "device_master")
    assert devices.schema["latitude"].dataType.simpleString() == "decimal(10,8)"
    assert devices.count() == 10
    with pytest.raises(ValueError):
        read_master(spark, Master(), "device_master")


def test_every_message_is_staged_or_rejected(lake, topics, spark):
    bad = [
        message(at="12:30"),
        message(energy="NaN"),
        message() + message(),
        "{bad",
        message(device=None),
        message(at="2099-01-01T00:00:00Z"),
    ]
    good = messages([1, 2])
    topics.send([*good, *bad])
    topics.send(["no meter here"], "logs")
    for _ in range(2):  # the second run reads the same topic again
        run(lake, topics)
        found = lake.read("rejected_messages").groupBy("topic", "reject_reason").count().collect()
        assert {(r.topic, r.reject_reason): r["count"] for r in found} == {
            ("stg_telemetry_raw", "unreadable_timestamp"): 1,
            ("stg_telemetry_raw", "unreadable_number"): 1,
            ("stg_telemetry_raw", "malformed_json"): 2,
            ("stg_telemetry_raw", "missing_device"): 1,
            ("stg_telemetry_raw", "time_ahead"): 1,
            ("stg_meter_health_logs", "missing_device"): 1,
        }
        sent = len(good) + len(bad) + len(LINES) + 1
        assert sum(lake.read(t).count() for t in (*jobs.STAGING_KEYS, "rejected_messages")) == sent


def test_one_bad_clock_does_not_end_loading(lake, topics):
    topics.send([*messages([1]), message(at="2099-01-01T00:00:00Z")])
    run(lake, topics, late="drop")
    topics.send(messages([2, 3]))
    assert run(lake, topics, late="drop")["stg_telemetry_raw"] == [dt.date(2025, 1, 2), dt.date(2025, 1, 3)]


@pytest.mark.parametrize("late", ["keep", "upsert"])
def test_correction_inside_one_load(lake, topics, spark, late):
    topics.send(messages([1]))
    run(lake, topics)
    one = message(at="2025-01-02T00:00:00Z", energy=9.0), message(at="2025-01-02T00:00:00Z", energy=1.0)
    rows = topic_rows(spark, one[:1]).union(topic_rows(spark, one[1:], at="2025-12-09T00:05:00"))
    rows.coalesce(1).write.mode("append").parquet(f"{topics.root}/telemetry")
    run(lake, topics, late=late)
    held = lake.read("stg_telemetry_raw").filter("reading_timestamp = TIMESTAMP '2025-01-02 00:00:00'").collect()
    assert [r.energy_kwh for r in held] == [1.0]


def test_emptied_date_loses_its_partition(lake, topics):
    topics.send(messages([1, 2]))
    run(lake, topics)
    kept = lake.read("device_daily_metrics").filter("reading_date = DATE '2025-01-01'")
    lake.replace_dates(kept, "device_daily_metrics", [dt.date(2025, 1, 1), dt.date(2025, 1, 2)])
    assert lake.dates("device_daily_metrics") == [dt.date(2025, 1, 1)]


def test_readers_see_old_or_new(lake, topics, spark):
    """A reader that runs all the while never meets a table or a date half replaced."""
    topics.send(messages([1, 2]))
    run(lake, topics)
    name = "device_daily_metrics"
    old = lake.read(name)
    other = old.withColumn("active_hours", F.lit(99).cast("bigint"))
    day = [dt.date(2025, 1, 1)]
    seen, stop = set(), threading.Event()

    def look():
        while not stop.is_set():
            rows = lake.read(name).filter(F.col("reading_date") == day[0]).collect()
            seen.add((len(rows), tuple(sorted({r.active_hours for r in rows}))))

    reader = threading.Thread(target=look)
    reader.start()
    try:
        began = lake.read(name)  # planned before the replacements, run after them
        before = rows_of(began)
        for rows in (other, old, other, old):
            kept = lake.write_work(rows, "test", name, uuid.uuid4().hex)
            lake.write_full(kept, name)
            lake.write_dates(kept.filter(F.col("reading_date") == day[0]), name, day)
        assert rows_of(began) == before
    finally:
        stop.set()
        reader.join()
    assert seen <= {(3, (2,)), (3, (99,))} and seen
    assert rows_of(lake.read(name)) == before
    assert len(lake.drop_replaced(name)) >= 4
    assert rows_of(lake.read(name)) == before
    assert lake.drop_replaced(name) == []


def test_failed_date_write_keeps_the_old_dates(lake, topics):
    topics.send(messages([1, 2]))
    run(lake, topics)
    name = "device_daily_metrics"
    before = rows_of(lake.read(name))
    boom = F.raise_error(F.lit("boom")).cast("string")
    bad = lake.read(name).withColumn("device_id", F.when(F.col("device_id") == "MTR-2", boom).otherwise(F.col("device_id")))
    with pytest.raises(Exception):
        lake.write_dates(bad, name, lake.dates(name))
    assert rows_of(lake.read(name)) == before


# ---------------------------------------------------------------------------
# progress


def test_second_run_reads_new_files_only(lake, topics, monkeypatch):
    read = []
    load = jobs.load_messages
    monkeypatch.setattr(jobs, "load_messages", lambda lake, name, messages, *a, **k: (
        read.append((name, messages.inputFiles(), messages.count())), load(lake, name, messages, *a, **k))[1])
    topics.send(messages([1, 2]))
    run(lake, topics)
    topics.send(messages([3]))
    run(lake, topics)
    run(lake, topics)
    assert [(n, len(f), c) for n, f, c in read] == [
        ("stg_telemetry_raw", 1, 12), ("stg_meter_health_logs", 1, 2), ("stg_telemetry_raw", 1, 6)]
    assert read[0][1] != read[2][1]
    ledger = lake.read("load_ledger").filter("topic = 'stg_telemetry_raw'").orderBy("messages").collect()
    assert [(r.start_offset, r.end_offset, r.messages) for r in ledger] == [(0, 6, 6), (0, 12, 12)]
    assert {r.split for r in ledger} == {*read[0][1], *read[2][1]}
    assert_marts_current(lake)


def test_load_cut_short_before_its_progress(lake, topics, monkeypatch):
    """Rows are in, progress isn't: they are read again and nothing comes twice."""
    topics.send(messages([1]))
    run(lake, topics)
    topics.send(messages([2]))
    with monkeypatch.context() as m:
        m.setattr(jobs, "_keep_progress", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run(lake, topics)
    assert lake.read("stg_telemetry_raw").count() == 12
    assert run(lake, topics)["stg_telemetry_raw"] == []
    assert lake.read("stg_telemetry_raw").count() == 12
    assert lake.read("load_ledger").filter("topic = 'stg_telemetry_raw'").count() == 2
    assert_marts_current(lake)


def test_full_refresh_begins_the_ledger_anew(lake, topics):
    topics.send(messages([1]))
    run(lake, topics)
    topics.send(messages([2]))
    run(lake, topics)
    run(lake, topics, full_refresh=True)
    ledger = lake.read("load_ledger").filter("topic = 'stg_telemetry_raw'")
    assert ledger.count() == 2 and ledger.select("load_id").distinct().count() == 1
    assert run(lake, topics)["stg_telemetry_raw"] == []


def test_files_with_odd_names_and_without_messages(spark, tmp_path):
    place = tmp_path / "a b%c"
    place.mkdir()
    (place / "one,two=3.txt").write_text("x\ny\n")
    (place / "empty.txt").write_text("")
    topic = Topic("text", path=str(tmp_path / "a b%c"))
    found, files = read_new(spark, topic, None)
    assert len(files) == 2
    rows = progress.progress_rows(found, "l", "t", F.lit(LOADED).cast("timestamp")).collect()
    assert [(r.messages, r.end_offset) for r in rows] == [(2, 2)] and rows[0].split in files
    done = spark.createDataFrame([(f, 0) for f in files], "split STRING, end_offset BIGINT")
    assert read_new(spark, topic, done)[1] == []


def test_offsets_of_a_partitioned_topic(spark):
    """What a topic with partitions and offsets would give, load after load."""
    rows = spark.createDataFrame(
        [(p, o, f"{p}-{o}") for p in (0, 1) for o in range(10)], "_split INT, _offset BIGINT, _message STRING")
    at = F.lit(LOADED).cast("timestamp")
    first = progress.progress_rows(rows.filter("_offset < 4 and _split = 0"), "l1", "t", at)
    assert {r._message for r in progress.unread(rows, first, "t").collect()} == {
        *(f"0-{o}" for o in range(4, 10)), *(f"1-{o}" for o in range(10))}
    second = first.unionByName(progress.progress_rows(progress.unread(rows, first, "t").filter("_offset < 7"), "l2", "t", at))
    ends = {r.split: r.end_offset for r in progress.ends(second, "t").collect()}
    assert ends == {"0": 7, "1": 7}
    assert progress.unread(rows, second, "t").count() == 6
    assert progress.unread(rows, second, "other").count() == 20
    assert json.loads(progress.starting_offsets(ends, "t", 3)) == {"t": {"0": 7, "1": 7, "2": -2}}


def test_messages_of_each_load_add_up(lake, topics, spark):
    bad = [message(energy="NaN"), "", "{bad"]
    topics.send([*messages([3, 4]), *messages([4]), *bad])
    run(lake, topics)
    topics.send([*messages([2, 4, 5]), *messages([5]), *bad])
    held = lake.read("stg_telemetry_raw").select(*jobs.STAGING_KEYS["stg_telemetry_raw"]).collect()
    held = spark.createDataFrame(held, "reading_timestamp TIMESTAMP, device_id STRING")
    new = read_new(spark, topics.topics["stg_telemetry_raw"], progress.ends(lake.read("load_ledger"), "stg_telemetry_raw"))[0]
    found = jobs.read("stg_telemetry_raw", new, LOADED)
    kinds = ("stg_telemetry_raw", found, jobs.STAGING_KEYS["stg_telemetry_raw"], jobs.LATEST_BY["stg_telemetry_raw"])
    plain = {r.fate: r.messages for r in progress.fates(found, held, *kinds[2:]).collect()}
    assert plain == {"blank": 1, "rejected": 2, "copy": 12, "staged": 12}
    late = F.col("reading_timestamp") > F.lit(ts("2025-01-04T05:10:00"))
    plain_drop = {r.fate: r.messages for r in progress.fates(found, held, *kinds[2:], late).collect()}
    assert plain_drop == {"blank": 1, "rejected": 2, "lost": 12, "copy": 6, "staged": 6}
    run(lake, topics, late="drop")
    counts = lake.read("load_counts").filter("topic = 'stg_telemetry_raw'").orderBy("messages").collect()
    assert [tuple(r[2:8]) for r in counts] == [(21, 1, 2, 0, 6, 12), (27, 1, 2, 12, 6, 6)]
    assert all(r.messages == r.blank + r.rejected + r.lost + r.copies + r.staged for r in counts)


def test_corrections_rewrite_their_dates_only(lake, topics, tmp_path):
    topics.send(messages([1, 2, 3]))
    run(lake, topics)
    files = lambda: set(lake.read("stg_telemetry_raw").inputFiles())
    old = files()
    topics.send(messages([4]))
    assert run(lake, topics, late="upsert")["stg_telemetry_raw"] == [dt.date(2025, 1, 4)]
    assert old < files()
    old = files()
    topics.send(messages([2], energy=9.0, hours=(5,)))
    assert run(lake, topics, late="upsert", batch_ts=LOADED + dt.timedelta(days=1))["stg_telemetry_raw"] == [dt.date(2025, 1, 2)]
    assert len(old - files()) == 1
    counts = lake.read("load_counts").orderBy("loaded_at").collect()[-1]
    assert (counts.messages, counts.copies, counts.staged) == (3, 0, 3)
    assert_marts_current(lake)


def test_note_during_a_refresh_is_not_forgotten(lake, topics):
    topics.send(messages([1, 2]))
    run(lake, topics)
    hours = lake.read("device_hourly_metrics").select("device_id", "reading_hour", "reading_date")
    lake.note_pending(hours.filter("reading_date = DATE '2025-01-01'"))
    notes = lake.pending_notes()
    lake.note_pending(hours.filter("reading_date = DATE '2025-01-02'"))
    lake.clear_pending(notes)
    assert lake.pending_dates() == [dt.date(2025, 1, 2)]


def test_late_reading_is_added_to_the_marts(lake, topics, monkeypatch):
    """One late reading: no grain is built anew, one group of each changes."""
    topics.send(messages(range(1, 6)))
    run(lake, topics)
    before = {n: set(rows_of(lake.read(n))) for n in jobs.MART_INPUT}
    built = []
    build = jobs.build_mart
    monkeypatch.setattr(jobs, "build_mart", lambda lake, name, *a: (built.append(name), build(lake, name, *a)))
    topics.send([message(device="MTR-2", customer="CUST-0", at="2025-01-03T01:40:00Z", energy=4.0, volts=1.0)])
    assert run(lake, topics)["stg_telemetry_raw"] == [dt.date(2025, 1, 3)]
    assert built == ["customer_usage_mtd_summary"]
    after = {n: set(rows_of(lake.read(n))) for n in jobs.MART_INPUT}
    assert {n: (len(before[n] - after[n]), len(after[n] - before[n])) for n in before} == dict.fromkeys(before, (1, 1))
    assert_marts_current(lake)
    assert lake.pending_dates() == []


def test_maintenance_cut_short_is_rebuilt(lake, topics, monkeypatch):
    """Changes must not be added twice: after half a maintenance the dates are built from their readings."""
    topics.send(messages([1, 2]))
    run(lake, topics)
    topics.send(messages([2], hours=(7,)))
    replace, done = Lake.replace_dates, []

    def stops(self, df, name, dates):
        if len(done) == 3:
            raise RuntimeError("lost")
        done.append(name)
        replace(self, df, name, dates)

    with monkeypatch.context() as m:
        m.setattr(Lake, "replace_dates", stops)
        with pytest.raises(RuntimeError):
            run(lake, topics)
    assert len(lake.pending_notes()) == 2
    run(lake, topics)
    assert_marts_current(lake)
    assert lake.pending_dates() == []


def test_relational_master_is_not_written(spark):
    with pytest.raises(ValueError, match="path"):
        add_missing(spark, Master(url="jdbc:none"), "device_master", seed_devices(spark, LOADED))


def test_rebuild_in_slices(lake, topics, monkeypatch):
    topics.send(messages(range(1, 4)))
    run(lake, topics, select="staging")
    monkeypatch.setattr(jobs, "SLICE_BYTES", 1)
    assert lake.date_slices("stg_telemetry_raw", 1) == [[dt.date(2025, 1, d)] for d in (1, 2, 3)]
    run(lake, topics)
    assert_marts_current(lake)
