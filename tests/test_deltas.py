"""Grains maintained by changes against grains built anew."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterflow import session
from meterflow.operators import deltas, rollups
from tests.helpers import readings, rows_of

pytestmark = pytest.mark.usefixtures("interpreted")
AS_OF = dt.date(2025, 1, 20)


@pytest.fixture(scope="module", autouse=True)
def shared(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(f"file://{tmp_path_factory.mktemp('shared')}")


def close(rows):
    """Rows with doubles cut to what the order of addition can't change."""
    return sorted((tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


def some(seed, n, devices=4, days=40):
    draw = random.Random(seed)
    out = {}
    for _ in range(n):
        d = draw.randrange(devices)
        at = dt.datetime(2024, 12, 20) + dt.timedelta(days=draw.randrange(days), hours=draw.randrange(24), minutes=draw.randrange(60))
        energy = draw.choice([None, draw.uniform(0, 5), draw.uniform(0, 5)])
        status = draw.choice(["OK", "OK", "WARNING", None])
        customer = draw.choice([f"C{d % 2}", f"C{d % 2}", None])
        out[d, at] = (f"D{d}", customer, at.isoformat(), energy, draw.uniform(200, 240), draw.choice([None, 50, 90]), status)
    return out


def built(hours):
    rows, states = {"device_hourly_metrics": hours}, {}
    for name, grain in deltas.grains().items():
        states[name] = session.kept(deltas.state_of(rows[grain.source], grain))
        rows[name] = deltas.finished(states[name], grain)
    return states, rows


def hours_of(spark, held):
    return session.kept(rollups.device_hourly(readings(spark, list(held.values())), unique=True))


def plainly(hours):
    daily = rollups.device_daily(hours)
    monthly = rollups.device_monthly(daily)
    return {
        "device_daily_metrics": daily,
        "device_monthly_metrics": monthly,
        "customer_daily_usage_summary": rollups.customer_daily(daily),
        "customer_monthly_usage_summary": rollups.customer_monthly(monthly),
    }


def test_states_give_the_grains(spark):
    hours = hours_of(spark, some(1, 300))
    rows = built(hours)[1]
    for name, plain in plainly(hours).items():
        assert rows[name].schema.names == plain.schema.names
        assert close(rows[name].collect()) == close(plain.collect()), name


def test_changes_equal_a_rebuild(spark):
    """New readings, corrections, readings that go, groups that appear and vanish, twice over."""
    held = some(2, 250)
    hours = hours_of(spark, held)
    states, rows = built(hours)
    draw = random.Random(3)
    for step in range(2):
        for key in draw.sample(sorted(held), 25):
            old = held.pop(key)
            if draw.random() < 0.6:
                held[key] = (*old[:3], draw.uniform(0, 9), draw.uniform(190, 250), *old[5:])
        held |= some(10 + step, 20, devices=5, days=45)
        now = hours_of(spark, held)
        after = deltas.maintained(
            session.kept(deltas.changes(hours, now)), now, {n: (states[n], rows[n]) for n in states}, deltas.grains(), lambda d, _: session.kept(d)
        )
        for name, plain in plainly(now).items():
            keys = list(deltas.grains()[name].keys)
            groups, state, new = after[name]
            states[name] = session.kept(deltas.replaced(states[name], groups, state, keys))
            rows[name] = session.kept(deltas.replaced(rows[name], groups, new, keys))
            assert close(rows[name].collect()) == close(plain.collect()), (step, name)
        hours = now


def test_one_late_reading_touches_one_group_of_each_grain(spark):
    held = some(4, 300, devices=6)
    hours = hours_of(spark, held)
    states, rows = built(hours)
    late = ("D1", "C1", "2025-01-05T07:31:00", 2.5, 230.0, 70, "OK")
    now = hours_of(spark, {**held, "late": late})
    after = deltas.maintained(deltas.changes(hours, now), now, {n: (states[n], rows[n]) for n in states}, deltas.grains(), lambda d, _: session.kept(d))
    assert {n: g.count() for n, (g, _, _) in after.items()} == dict.fromkeys(after, 1)
    day = after["device_daily_metrics"][2].first()
    assert (day.device_id, day.customer_id, day.reading_date) == ("D1", "C1", dt.date(2025, 1, 5))


@pytest.mark.parametrize("big", [1e12, 1e300])
def test_a_huge_value_that_goes_leaves_no_trace(spark, big):
    held = {i: ("D", "C", f"2025-01-02T{i:02d}:00:00", 0.1, 230.0 + i, 50, "OK") for i in range(5)}
    wrong = {**held, "x": ("D", "C", "2025-01-02T09:00:00", big, 1.0, 50, "OK")}
    hours, now = hours_of(spark, wrong), hours_of(spark, held)
    states, rows = built(hours)
    after = deltas.maintained(deltas.changes(hours, now), now, {n: (states[n], rows[n]) for n in states}, deltas.grains(), lambda d, _: session.kept(d))
    for name, plain in plainly(now).items():
        assert close(after[name][2].collect()) == close(plain.collect()), name


def test_month_to_date_after_changes(spark):
    held = some(6, 200, devices=4, days=45)
    days = rollups.customer_daily(rollups.device_daily(hours_of(spark, held)))
    held |= some(7, 40, devices=4, days=45)
    new = session.kept(rollups.customer_daily(rollups.device_daily(hours_of(spark, held))))
    grain, month = deltas.mtd_grain(AS_OF), F.col("reading_date").between(dt.date(2025, 1, 1), dt.date(2025, 1, 31))
    state = session.kept(deltas.state_of(days.filter(month), grain))
    moved = session.kept(deltas.changes(days.filter(month), new.filter(month)))
    touched = deltas.updated(state, moved, new.filter(month), grain)
    now = deltas.replaced(state, deltas.touched(moved, grain), touched, ["customer_id"])
    got = rollups.with_latest_day(deltas.finished(now, grain), new, AS_OF)
    assert close(got.collect()) == close(rollups.customer_usage_mtd(new, AS_OF).collect())


def test_nothing_changed(spark):
    hours = hours_of(spark, some(8, 50))
    states, rows = built(hours)
    after = deltas.maintained(deltas.changes(hours, hours), hours, {n: (states[n], rows[n]) for n in states}, deltas.grains(), lambda d, _: session.kept(d))
    assert all(part.count() == 0 for parts in after.values() for part in parts)
    assert rows_of(deltas.replaced(rows["device_daily_metrics"], *[after["device_daily_metrics"][i] for i in (0, 2)],
                                   ["device_id", "customer_id", "reading_date"])) == rows_of(rows["device_daily_metrics"])
