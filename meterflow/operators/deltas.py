"""Coarser grains kept up to date by what changed in the finer one.

A group's state holds the sums and counts that its means are made of, and its extremes.
Rows of the finer grain that went are taken off, rows that came are added, so that a group
costs as much as its changes. Only where that can't be exact is a group summed up anew
from its finer rows: the least or greatest value went, or so large a number came or went
that the digits of the others would be lost.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow import schemas
from meterflow.functions import calendar as C
from meterflow.functions import rules as R
from meterflow.operators import rollups

# A group is summed up anew if a number that came or went is this much larger than what is left.
DIGITS = 1e4


@dataclass(frozen=True)
class Grain:
    """How a coarser grain follows from the rows of a finer one.

    ``keys`` are its columns by expression; ``sums`` and ``means`` the output columns by
    the finer column they add up or average, null or not; ``lows`` and ``highs`` extremes;
    ``rows`` the column that counts finer rows. ``finish`` adds what is worked out from those.
    """

    source: str
    keys: Mapping[str, Column]
    sums: Mapping[str, str]
    means: Mapping[str, str]
    lows: Mapping[str, str]
    highs: Mapping[str, str]
    rows: str
    finish: Callable[[DataFrame], DataFrame]
    columns: Sequence[str] = field(default=())

    @property
    def added(self) -> dict[str, str]:
        """Columns of the state that are sums, by the finer column they add up."""
        return {**{f"sum_{c}": v for c, v in self.sums.items()}, **{f"sum_{c}": v for c, v in self.means.items()}}


def _device(keys: Mapping[str, Column], source: str, rows: str, finish, columns) -> Grain:
    same = ("total_energy_kwh", "reading_count", "warning_count", "ok_count")
    return Grain(
        source,
        keys,
        sums={c: c for c in same},
        means={c: c for c in ("avg_voltage", "avg_battery_pct")},
        lows={"min_voltage": "min_voltage"},
        highs={"max_voltage": "max_voltage"},
        rows=rows,
        finish=finish,
        columns=columns,
    )


def _customer(keys, source, energy, devices, finish, columns, **means: str) -> Grain:
    return Grain(
        source,
        keys,
        sums={
            energy: "total_energy_kwh",
            "total_readings": "reading_count",
            "total_warnings": "warning_count",
            "total_ok": "ok_count",
        },
        means={
            "avg_voltage": "avg_voltage",
            "avg_battery_pct": "avg_battery_pct",
            "avg_device_health_pct": "health_score_pct",
            **means,
        },
        lows={"min_voltage": "min_voltage"},
        highs={"max_voltage": "max_voltage"},
        rows=devices,
        finish=finish,
        columns=columns,
    )


def _plain(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def grains() -> dict[str, Grain]:
    """The grains above the device hour, finest first; each is built from an earlier one or from the hours."""
    month = {"reading_month": C.month_start(F.col("reading_date"))}
    parts = lambda d: d.withColumns({"year": F.year("reading_month"), "month": F.month("reading_month")})
    return {
        "device_daily_metrics": _device(
            _plain("device_id", "customer_id", "reading_date"),
            "device_hourly_metrics",
            "active_hours",
            rollups.with_device_health,
            schemas.DEVICE_DAILY.names,
        ),
        "device_monthly_metrics": _device(
            {**_plain("device_id", "customer_id"), **month},
            "device_daily_metrics",
            "active_days",
            lambda d: rollups.with_device_health(parts(d)),
            schemas.DEVICE_MONTHLY.names,
        ),
        "customer_daily_usage_summary": _customer(
            _plain("customer_id", "reading_date"),
            "device_daily_metrics",
            "daily_total_energy_kwh",
            "active_devices",
            rollups.finished_customer_day,
            schemas.CUSTOMER_DAILY.names,
        ),
        "customer_monthly_usage_summary": _customer(
            _plain("customer_id", "reading_month"),
            "device_monthly_metrics",
            "monthly_total_energy_kwh",
            "total_devices",
            rollups.finished_customer_month,
            schemas.CUSTOMER_MONTHLY.names,
            avg_device_active_days="active_days",
        ),
    }


def mtd_grain(as_of: C.AsOf) -> Grain:
    """Month to date of one month's customer days, but for the energy of the latest day."""
    return Grain(
        "customer_daily_usage_summary",
        _plain("customer_id"),
        sums={
            "mtd_total_energy_kwh": "daily_total_energy_kwh",
            "mtd_total_readings": "total_readings",
            "mtd_total_warnings": "total_warnings",
            "mtd_total_ok": "total_ok",
        },
        means={
            "mtd_avg_voltage": "avg_voltage",
            "mtd_avg_battery_pct": "avg_battery_pct",
            "avg_daily": "daily_total_energy_kwh",
        },
        lows={"mtd_min_voltage": "min_voltage", "first_reading_date": "reading_date"},
        highs={
            "mtd_max_voltage": "max_voltage",
            "max_active_devices": "active_devices",
            "last_reading_date": "reading_date",
        },
        rows="days_with_data",
        finish=lambda d: rollups.finished_mtd(d, as_of),
        columns=[c for c in schemas.CUSTOMER_MTD.names if c != "latest_day_energy_kwh"],
    )


# --------------------------------------------------------------------------


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys, nulls included."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def of_groups(rows: DataFrame, groups: DataFrame, keys: Mapping[str, Column], how: str = "left_semi") -> DataFrame:
    """Rows whose keys are among the groups, or with ``left_anti`` are not."""
    named = groups.select(*[F.col(k).alias(f"_group_{k}") for k in keys])
    match = reduce(Column.__and__, [e.eqNullSafe(F.col(f"_group_{k}")) for k, e in keys.items()])
    return rows.join(named, match, how)


def state_of(finer: DataFrame, grain: Grain) -> DataFrame:
    """State of every group, from all its finer rows."""
    parts = [F.sum(v).alias(c) for c, v in grain.added.items()]
    parts += [F.count(v).alias(f"n_{c}") for c, v in {**grain.sums, **grain.means}.items()]
    parts += [F.min(v).alias(c) for c, v in grain.lows.items()]
    parts += [F.max(v).alias(c) for c, v in grain.highs.items()]
    return finer.groupBy(*[e.alias(k) for k, e in grain.keys.items()]).agg(*parts, F.count(F.lit(1)).alias("_rows"))


def finished(state: DataFrame, grain: Grain) -> DataFrame:
    """The rows of the grain, from the state of its groups."""
    known = lambda c, value: F.when(F.col(f"n_{c}") > 0, value)
    rows = state.select(
        *grain.keys,
        *[known(c, F.col(f"sum_{c}")).alias(c) for c in grain.sums],
        *[known(c, F.col(f"sum_{c}") / F.col(f"n_{c}")).alias(c) for c in grain.means],
        *grain.lows,
        *grain.highs,
        F.col("_rows").alias(grain.rows),
    )
    return grain.finish(rows).select(*grain.columns)


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that went (``_sign`` -1) and rows that came (1); a row that is in both is neither."""
    both = old.withColumn("_sign", F.lit(-1)).unionByName(new.withColumn("_sign", F.lit(1)))
    names = [c for c in both.columns if c != "_sign"]
    net = both.groupBy(*names).agg(F.sum("_sign").cast("int").alias("_sign"))
    return net.filter("_sign != 0")


def _change_of_groups(changed: DataFrame, grain: Grain) -> DataFrame:
    came, sign = F.col("_sign") > 0, F.col("_sign")
    parts = [F.sum(F.col(v) * sign).alias(f"d_{c}") for c, v in grain.added.items()]
    parts += [F.max(F.abs(F.col(v).cast("double"))).alias(f"big_{c}") for c, v in grain.added.items()]
    parts += [
        F.sum(F.when(F.col(v).isNotNull(), sign).otherwise(0)).alias(f"dn_{c}")
        for c, v in {**grain.sums, **grain.means}.items()
    ]
    for kind, columns in ((F.min, grain.lows), (F.max, grain.highs)):
        for c, v in columns.items():
            parts += [kind(F.when(came, F.col(v))).alias(f"came_{c}"), kind(F.when(~came, F.col(v))).alias(f"went_{c}")]
    return changed.groupBy(*[e.alias(k) for k, e in grain.keys.items()]).agg(*parts, F.sum("_sign").alias("_d_rows"))


def _merged(state: DataFrame, change: DataFrame, grain: Grain) -> DataFrame:
    """State of the touched groups after the change, and whether it has to be worked out anew (``_anew``)."""
    held = state.select(*[F.col(c).alias(f"h_{c}") for c in state.columns])
    match = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"h_{k}")) for k in grain.keys])
    joined = change.join(held, match, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    rows = {"_rows": zero("h__rows") + F.col("_d_rows")}
    for c in grain.added:
        rows[c] = zero(f"h_{c}") + zero(f"d_{c}")
    for c in {**grain.sums, **grain.means}:
        rows[f"n_{c}"] = zero(f"h_n_{c}") + F.col(f"dn_{c}")
    for kind, columns in ((F.least, grain.lows), (F.greatest, grain.highs)):
        for c in columns:
            rows[c] = kind(F.col(f"h_{c}"), F.col(f"came_{c}"))
    anew = F.lit(False)
    for c in (*grain.lows, *grain.highs):
        edge = F.col(f"went_{c}") <= F.col(f"h_{c}") if c in grain.lows else F.col(f"went_{c}") >= F.col(f"h_{c}")
        anew |= F.coalesce(edge, F.lit(False))
    for c, value in rows.items():
        if c in grain.added:
            # Whole numbers lose no digits.
            if isinstance(state.schema[c].dataType, T.DoubleType):
                largest = F.greatest(zero(f"big_{c}"), F.abs(zero(f"h_{c}")))
                anew |= ((largest > DIGITS * F.abs(value)) & (largest > 0)) | F.isnan(value)
    return joined.select(*grain.keys, *[v.alias(c) for c, v in rows.items()], anew.alias("_anew"))


def updated(
    state: DataFrame,
    changed: DataFrame,
    finer: DataFrame,
    grain: Grain,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """State of the groups that the changes touch, afterwards; groups without rows are left out.

    ``state`` has the groups as they were, ``changed`` the finer rows that came and went,
    ``finer`` the finer rows as they are now: of these only the groups that have to be
    summed up anew are read. ``keep`` may write a frame that is used twice.
    """
    merged = keep(_merged(state, _change_of_groups(changed, grain), grain), "merged")
    left = merged.filter("_rows > 0")
    anew = state_of(of_groups(finer, left.filter("_anew"), grain.keys), grain)
    return left.filter("not _anew").select(*state.columns).unionByName(anew.select(*state.columns))


def touched(changed: DataFrame, grain: Grain) -> DataFrame:
    """Keys of the groups that changes touch."""
    return changed.select(*[e.alias(k) for k, e in grain.keys.items()]).distinct()


def replaced(held: DataFrame, gone: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``held`` without the groups ``gone`` and with the rows ``new``."""
    return of_groups(held, gone, _plain(*keys), "left_anti").unionByName(new.select(*held.columns))


def maintained(
    changed: DataFrame,
    hours: DataFrame,
    old: Mapping[str, tuple[DataFrame, DataFrame]],
    order: Mapping[str, Grain],
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> dict[str, tuple[DataFrame, DataFrame, DataFrame]]:
    """Per grain the keys touched, their states and their rows, after device hours changed.

    ``changed`` are device hours that went and came (:func:`changes`), ``hours`` all of the touched periods as they
    are now, ``old`` the states and rows of each grain as they were, for the periods touched there and above.
    """
    now, moved, out = {"device_hourly_metrics": hours}, {"device_hourly_metrics": changed}, {}
    for name, grain in order.items():
        state, rows = old[name]
        change = moved[grain.source]
        groups = keep(touched(change, grain), f"{name}-touched")
        new_state = keep(updated(state, change, now[grain.source], grain, lambda d, n: keep(d, f"{name}-{n}")), f"{name}-state")
        new_rows = keep(finished(new_state, grain), f"{name}-rows")
        before = of_groups(rows, groups, _plain(*grain.keys))
        moved[name] = keep(changes(before.select(*grain.columns), new_rows), f"{name}-changes")
        now[name] = replaced(rows.select(*grain.columns), groups, new_rows, list(grain.keys))
        out[name] = (groups, new_state, new_rows)
    return out
