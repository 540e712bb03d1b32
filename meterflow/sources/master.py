"""Relational master data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from meterflow import schemas
from meterflow.operators.dedup import first_of_each
from meterflow.operators.keyfilter import FULL, blocks_for, fill_share, key_filter, merged, split_by_filter
from meterflow.operators.quality import with_master_defaults

TABLES = {"customer_master": schemas.CUSTOMER_MASTER, "device_master": schemas.DEVICE_MASTER}


@dataclass(frozen=True)
class Master:
    """Where the master tables are: a JDBC ``url``, or a folder of Parquet tables.

    ``split`` cuts the JDBC read of a large table into parallel ranges:
    ``{"partitionColumn": ..., "lowerBound": ..., "upperBound": ..., "numPartitions": ...}``.
    """

    url: str | None = None
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    split: Mapping[str, str] = field(default_factory=dict)


def read_master(spark: SparkSession, master: Master, table: str) -> DataFrame:
    """A master table with its declared columns."""
    schema = TABLES[table]
    if master.path is not None:
        return spark.read.schema(schema).parquet(f"{master.path}/{table}")
    if master.url is None:
        raise ValueError("a master source needs a url or a path")
    rows = (
        spark.read.format("jdbc")
        .options(url=master.url, dbtable=table, **{**master.options, **master.split})
        .load()
    )
    return rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def _there(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _filter_widths(spark: SparkSession, folder: str) -> list[int]:
    """Widths of the key filters that were written to the end."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(place)] if system.exists(place) else []
    return sorted(int(n.split("-")[1]) for n in names if _there(spark, f"{folder}/{n}/_SUCCESS"))


def held_keys(spark: SparkSession, source: Master, table: str) -> tuple[DataFrame, int, str]:
    """The filter over the keys of a Parquet master table, its blocks and its place.

    It is kept beside the table. Where there is none, or most of its bits are set, a wider one is built from
    the table, in a place of its own: one cut short has no ``_SUCCESS`` and isn't used.
    """
    key, folder = schemas.MASTER_KEYS[table], f"{source.path}/_keys/{table}"
    schema = "blocks BIGINT, block BIGINT, bits BINARY"
    for blocks in _filter_widths(spark, folder)[-1:]:
        held = merged(spark.read.schema(schema).parquet(f"{folder}/blocks-{blocks}"))
        if held.agg(fill_share(held, blocks)).first()[0] <= FULL:
            return held, blocks, f"{folder}/blocks-{blocks}"
    rows = read_master(spark, source, table)
    blocks = max([blocks_for(rows.count()), *(w + 1 for w in _filter_widths(spark, folder))])
    place = f"{folder}/blocks-{blocks}"
    key_filter(rows, [key], blocks).write.mode("overwrite").parquet(place)
    return merged(spark.read.schema(schema).parquet(place)), blocks, place


def add_missing(spark: SparkSession, source: Master, table: str, rows: DataFrame) -> None:
    """Insert the rows whose key a Parquet master table lacks; a second run adds nothing.

    The first run creates the table. A filter over the held keys tells most new keys apart; the table is only
    read if a key may be there. New keys go to the filter before the rows go to the table: what a run cut short leaves
    is a key too many, which is then looked for. One writer at a time. Relational masters are read only: a source
    without a path is refused.
    """
    if source.path is None:
        raise ValueError("rows can only be added to a master with a path")
    key = schemas.MASTER_KEYS[table]
    rows = with_master_defaults(rows, table).select(*TABLES[table].names)
    path = f"{source.path}/{table}"
    if not _there(spark, path):
        first_of_each(rows, [key]).write.mode("append").parquet(path)
        return
    held, blocks, place = held_keys(spark, source, table)
    missing, unsure = split_by_filter(rows, key, held, blocks)
    if not unsure.isEmpty():
        stored = read_master(spark, source, table).select(key)
        missing = missing.unionByName(unsure.join(stored, key, "left_anti").select(*rows.columns))
    if missing.isEmpty():
        return
    key_filter(missing, [key], blocks).write.mode("append").parquet(place)
    missing.write.mode("append").parquet(path)


# The sample customers and devices.
SEED_CUSTOMERS = [
    ("CUST-8000", "Acme Corporation", "billing@acmecorp.com", "+1-555-0100", "123 Industrial Blvd", "San Francisco", "CA", "94102", "ACTIVE"),
    ("CUST-8001", "TechStart Industries", "accounts@techstart.com", "+1-555-0101", "456 Innovation Drive", "Austin", "TX", "78701", "ACTIVE"),
    ("CUST-8002", "Global Manufacturing Ltd", "finance@globalmanuf.com", "+1-555-0102", "789 Factory Lane", "Chicago", "IL", "60601", "ACTIVE"),
    ("CUST-8003", "Green Energy Co", "info@greenenergy.com", "+1-555-0103", "321 Solar Street", "Portland", "OR", "97201", "ACTIVE"),
    ("CUST-8004", "Metro Services Inc", "admin@metroservices.com", "+1-555-0104", "654 Commerce Way", "Seattle", "WA", "98101", "ACTIVE"),
]
SEED_DEVICES = [
    ("MTR-10000", "CUST-8000", "SmartMeter-Pro-X1", "v2.4.1", "2023-01-15", "Building A - Main Floor", "37.7749", "-122.4194", "ACTIVE", "2024-11-01", "2026-01-15"),
    ("MTR-10001", "CUST-8000", "SmartMeter-Pro-X1", "v2.4.1", "2023-01-20", "Building B - Basement", "37.7750", "-122.4195", "ACTIVE", "2024-11-05", "2026-01-20"),
    ("MTR-10002", "CUST-8001", "SmartMeter-Plus-S2", "v2.3.5", "2023-02-10", "Warehouse Section 1", "30.2672", "-97.7431", "ACTIVE", "2024-10-15", "2026-02-10"),
    ("MTR-10003", "CUST-8001", "SmartMeter-Plus-S2", "v2.3.5", "2023-02-15", "Warehouse Section 2", "30.2673", "-97.7432", "ACTIVE", "2024-10-20", "2026-02-15"),
    ("MTR-10004", "CUST-8002", "SmartMeter-Industrial-I5", "v3.0.2", "2023-03-01", "Production Line A", "41.8781", "-87.6298", "ACTIVE", "2024-12-01", "2026-03-01"),
    ("MTR-10005", "CUST-8002", "SmartMeter-Industrial-I5", "v3.0.2", "2023-03-05", "Production Line B", "41.8782", "-87.6299", "ACTIVE", "2024-12-05", "2026-03-05"),
    ("MTR-10006", "CUST-8003", "SmartMeter-Eco-E3", "v2.5.0", "2023-04-12", "Solar Panel Array 1", "45.5152", "-122.6784", "ACTIVE", "2024-09-10", "2026-04-12"),
    ("MTR-10007", "CUST-8003", "SmartMeter-Eco-E3", "v2.5.0", "2023-04-18", "Solar Panel Array 2", "45.5153", "-122.6785", "ACTIVE", "2024-09-15", "2026-04-18"),
    ("MTR-10008", "CUST-8004", "SmartMeter-Commercial-C4", "v2.4.3", "2023-05-01", "Office Complex - East Wing", "47.6062", "-122.3321", "ACTIVE", "2024-11-20", "2026-05-01"),
    ("MTR-10009", "CUST-8004", "SmartMeter-Commercial-C4", "v2.4.3", "2023-05-10", "Office Complex - West Wing", "47.6063", "-122.3322", "ACTIVE", "2024-11-25", "2026-05-10"),
]


def seed_customers(spark: SparkSession, created_at: dt.datetime) -> DataFrame:
    """The sample customers as rows of ``customer_master``."""
    rows = [(*r, created_at, created_at) for r in SEED_CUSTOMERS]
    return spark.createDataFrame(rows, schemas.CUSTOMER_MASTER)


def seed_devices(spark: SparkSession, created_at: dt.datetime) -> DataFrame:
    """The sample devices as rows of ``device_master``."""
    day = dt.date.fromisoformat
    rows = [
        (*r[:4], day(r[4]), r[5], Decimal(r[6]), Decimal(r[7]), r[8], day(r[9]), day(r[10]), created_at, created_at)
        for r in SEED_DEVICES
    ]
    return spark.createDataFrame(rows, schemas.DEVICE_MASTER)
