"""Checks the master tables' constraints would make, as queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow import schemas
from meterflow.functions.calendar import as_instant
from meterflow.operators.lookup import lookup_join


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with how many."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-NULL key the parent table lacks."""
    return lookup_join(
        child.filter(F.col(key).isNotNull()), parent.select(key).distinct(), key, "left_anti"
    ).select(*child.columns)


def not_null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column, how many rows hold NULL where they must not; only columns with any."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "null_count").filter("null_count > 0")


def too_long(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Rows with a text longer than its column allows."""
    over = [F.length(c) > n for c, n in lengths.items()]
    return df.filter(reduce(Column.__or__, over))


def apply_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """NULLs replaced by the column's default value."""
    return df.withColumns({c: F.coalesce(F.col(c), value) for c, value in defaults.items()})


def with_master_defaults(rows: DataFrame, table: str, now: dt.datetime | None = None) -> DataFrame:
    """Rows of a master table as an insert would store them."""
    values = {c: F.lit(v) for c, v in schemas.MASTER_DEFAULTS[table].items()}
    values |= {c: as_instant(now) for c in schemas.MASTER_TIMES}
    return apply_defaults(rows, {c: v for c, v in values.items() if c in rows.columns})


def master_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """What in the given master tables breaks their promises: table, check, column and how many rows."""

    def found(rows: DataFrame, table: str, check: str, column: str) -> DataFrame:
        counted = rows.agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 0")
        return counted.select(
            F.lit(table).alias("table_name"), F.lit(check).alias("check"), F.lit(column).alias("column_name"), "row_count"
        )

    parts = []
    for name, df in tables.items():
        key = schemas.MASTER_KEYS[name]
        parts.append(found(duplicate_keys(df.filter(F.col(key).isNotNull()), key), name, "duplicate_key", key))
        nulls = not_null_violations(df, schemas.MASTER_REQUIRED[name])
        parts.append(
            nulls.select(
                F.lit(name).alias("table_name"), F.lit("null").alias("check"), "column_name",
                F.col("null_count").alias("row_count"),
            )
        )
        lengths = {c: n for c, n in schemas.MASTER_TEXT_LENGTHS[name].items() if c in df.columns}
        over = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in lengths.items()])
        over = over.unpivot([], list(lengths), "column_name", "row_count").filter("row_count > 0")
        parts.append(over.select(F.lit(name).alias("table_name"), F.lit("too_long").alias("check"), "column_name", "row_count"))
        if name in schemas.MASTER_REFERENCES:
            column, parent = schemas.MASTER_REFERENCES[name]
            if parent in tables:
                parts.append(found(orphans(df, tables[parent], column), name, "orphan", column))
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name and number of rows of every table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
