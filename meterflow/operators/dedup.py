"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(
    df: DataFrame, keys: Sequence[str], first: Sequence[str | Column], descending: bool = True
) -> list[Column]:
    """Sort keys within one group that leave no ties but between fully equal rows.

    ``first`` decides; every other column follows, so that a retried task picks
    the same row again.
    """
    named = {*keys, *(c for c in first if isinstance(c, str))}
    rest = [c for c in df.columns if c not in named]
    cols = [F.col(c) if isinstance(c, str) else c for c in (*first, *rest)] or [F.lit(1)]
    return [c.desc_nulls_last() if descending else c.asc_nulls_last() for c in cols]


def _first_ranked(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    """One row per key.

    A rank filter of this form is cut down on both sides of the shuffle: each
    map task sends one row per key at most, so that a key repeated any number
    of times never gathers in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedup_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str | Column]) -> DataFrame:
    """The latest row of each key."""
    return _first_ranked(df, keys, total_order(df, keys, latest_by))


def first_of_each(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by the other columns."""
    return _first_ranked(df, keys, total_order(df, keys, [], descending=False))
