"""Streams over files, drained batch by batch."""

import datetime as dt

import pytest

from meterflow.operators import rollups, staging
from meterflow.plans import jobs
from meterflow.session import shared_dir
from meterflow.sources.tables import Lake
from meterflow.sources.topics import Topic, read_topic
from meterflow.streaming import streams
from tests.helpers import LOADED, message, rows_of, topic_rows

AS_OF = dt.date(2025, 1, 20)
pytestmark = pytest.mark.usefixtures("interpreted")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


class Feed:
    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        self.topic = Topic("parquet", path=path, max_per_trigger=1)

    def send(self, texts):
        topic_rows(self.spark, texts).coalesce(1).write.mode("append").parquet(self.path)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path / "feed"))


def texts(day, hours, device="MTR-1", energy=1.0):
    return [message(device=device, at=f"2025-01-{day:02d}T{h:02d}:15:00Z", energy=energy, volts=220.0 + h) for h in hours]


def load(lake, feed, **kw):
    query = streams.load_stream(lake, "stg_telemetry_raw", feed.topic, interval=None, as_of=AS_OF, batch_ts=LOADED, **kw)
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def same_as_batch(lake, feed, spark):
    rows = staging.parse_telemetry(read_topic(spark, Topic("parquet", path=feed.path)), LOADED)
    hourly = rollups.device_hourly(rows)
    daily = rollups.device_daily(hourly)
    monthly = rollups.device_monthly(daily)
    assert rows_of(lake.read("device_hourly_metrics")) == rows_of(hourly)
    assert rows_of(lake.read("device_daily_metrics")) == rows_of(daily)
    assert rows_of(lake.read("device_monthly_metrics")) == rows_of(monthly)
    assert rows_of(lake.read("customer_monthly_usage_summary")) == rows_of(rollups.customer_monthly(monthly))


def test_loading_stream_equals_batch(spark, lake, feed):
    feed.send(texts(1, range(6)))
    load(lake, feed)
    feed.send(texts(1, range(4, 9)))  # two hours come twice
    feed.send(texts(2, range(3), device="MTR-2") + texts(1, [20]))
    load(lake, feed)
    same_as_batch(lake, feed, spark)
    feed.send(texts(1, range(3), device="MTR-9"))  # long after the newest reading
    load(lake, feed)
    same_as_batch(lake, feed, spark)
    assert lake.pending_dates() == []


def test_late_rows_dropped_on_request(spark, lake, feed):
    feed.send(texts(3, range(2)))
    load(lake, feed)
    feed.send(texts(1, range(2), device="MTR-2"))
    load(lake, feed, late="drop")
    assert lake.read("stg_telemetry_raw").count() == 2


def test_log_stream(spark, lake, feed):
    feed.send(["2025-01-02 06:00:00 [INFO] MTR-1 CUST-1 HEALTH_CHECK_OK battery=85", "no meter"])
    query = streams.load_stream(lake, "stg_meter_health_logs", feed.topic, interval=None, batch_ts=LOADED)
    query.awaitTermination(120)
    assert lake.read("stg_meter_health_logs").count() == 1


def drain(lake, feed, build, path, name):
    rows = staging.parse_telemetry(read_topic(lake.spark, feed.topic, streaming=True), LOADED)
    query = streams.append_stream(lake, build(rows), path, name, interval=None)
    query.awaitTermination(120)
    assert query.exception() is None


def test_hour_windows_equal_batch(spark, lake, feed, tmp_path):
    feed.send(texts(1, range(6)) + texts(1, [2], device="MTR-2"))
    feed.send(texts(1, range(4, 10)))  # repeated within the delay
    feed.send(texts(2, [23], device="MTR-3"))  # moves the watermark past day 1
    feed.send(texts(3, [23], device="MTR-3"))
    path = str(tmp_path / "hours")
    drain(lake, feed, streams.hourly_stream, path, "hours")
    rows = staging.parse_telemetry(read_topic(spark, Topic("parquet", path=feed.path)), LOADED)
    batch = rollups.device_hourly(rows).filter("reading_date = DATE '2025-01-01'")
    done = spark.read.parquet(path).filter("reading_date = DATE '2025-01-01'")
    assert rows_of(done) == rows_of(batch)


def test_day_windows_equal_batch(spark, lake, feed, tmp_path):
    feed.send(texts(1, range(6)))
    feed.send(texts(1, range(4, 10)))
    for day in (3, 5, 7):
        feed.send(texts(day, [23], device="MTR-3"))
    path = str(tmp_path / "days")
    drain(lake, feed, streams.daily_stream, path, "days")
    rows = staging.parse_telemetry(read_topic(spark, Topic("parquet", path=feed.path)), LOADED)
    batch = rollups.device_daily(rollups.device_hourly(rows)).filter("reading_date = DATE '2025-01-01'")
    done = spark.read.parquet(path).filter("reading_date = DATE '2025-01-01'")
    assert rows_of(done) == rows_of(batch)


def test_corrections_win_and_late_readings_are_kept(spark, lake, feed):
    """On time and late add up to what was read, over a watermark that moves and a restart."""

    def send(rows, at="2025-12-09T00:00:00"):
        topic_rows(spark, rows, at).coalesce(1).write.mode("append").parquet(feed.path)

    def drain():
        query = streams.correcting_stream(lake, feed.topic, interval=None, as_of=AS_OF, batch_ts=LOADED)
        query.awaitTermination(120)
        assert query.exception() is None

    send(texts(1, range(4)) + texts(1, [2]))  # one comes twice
    drain()
    send(texts(1, [2, 5], energy=9.0), "2025-12-09T01:00:00")  # a correction inside the delay, and a new one
    drain()
    send(texts(1, [5], energy=7.0), "2025-12-09T00:30:00")  # an older version comes later
    drain()
    send(texts(2, [20], device="MTR-3"))  # moves the watermark past day 1
    drain()
    send(texts(1, [6, 7], device="MTR-2") + texts(2, [21], device="MTR-3"))
    drain()
    held = lake.read("stg_telemetry_raw")
    late = lake.read("late_readings")
    # 11 were read: two copies, one reading that a correction replaced, two late ones.
    assert (held.count(), late.count()) == (7, 2)
    assert {(r.device_id, r.reading_timestamp.hour) for r in late.collect()} == {("MTR-2", 6), ("MTR-2", 7)}
    rows = staging.parse_telemetry(read_topic(spark, Topic("parquet", path=feed.path)), LOADED)
    on_time = rows.filter("device_id <> 'MTR-2'")
    assert rows_of(lake.read("device_hourly_metrics")) == rows_of(rollups.device_hourly(on_time))
    energy = {r.reading_timestamp.hour: r.energy_kwh for r in held.filter("device_id = 'MTR-1'").collect()}
    assert (energy[2], energy[5]) == (9.0, 9.0)


def test_kinds_add_up_to_what_was_read(spark, lake, feed, tmp_path):
    feed.send(texts(1, range(4)) + texts(1, [3]))
    feed.send(texts(2, [20], device="MTR-3"))
    feed.send(texts(2, [21], device="MTR-3"))
    feed.send(texts(1, range(2), device="MTR-2"))
    path = str(tmp_path / "kinds")
    drain(lake, feed, streams.versions_stream, path, "kinds")
    kinds = {r.kind: r["count"] for r in spark.read.parquet(path).groupBy("kind").count().collect()}
    assert kinds == {"new": 6, "copy": 1, "late": 2}


class Conf(dict):
    """A session that only has settings; the real one's checkpoint folder cannot be changed."""

    @property
    def conf(self):
        return self


def test_shared_folder_is_the_cluster_setting():
    assert shared_dir(Conf({"spark.checkpoint.dir": "/shared"}), "/lake") == "/shared"
    assert shared_dir(Conf(), "/lake") == "/lake"


def test_lakes_do_not_share_checkpoints(spark, lake, tmp_path):
    mine = streams._checkpoint(lake, "x")
    assert mine.startswith(shared_dir(spark, lake.root))
    assert streams._checkpoint(Lake(spark, str(tmp_path / "other")), "x") != mine
