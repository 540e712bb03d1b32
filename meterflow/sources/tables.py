"""The lake: Parquet tables in one folder per layer, partitioned by date."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from meterflow import schemas
from meterflow.operators.lookup import estimated_bytes
from meterflow.session import use_utc

STAGING, MARTS = "energy_data_staging", "energy_data_marts"


@dataclass(frozen=True)
class Table:
    """Layout of one table.

    ``date_col`` is the partition column; where the table itself has no such
    column it is derived from ``date_from``. Rows are written in the order of
    date and ``id_cols``, which keeps the rows of one device together for the
    next rollup and lets scans skip by id.
    """

    layer: str
    schema: StructType
    date_col: str | None = None
    date_from: str | None = None
    id_cols: tuple[str, ...] = ()

    @property
    def stored_schema(self) -> StructType:
        if self.date_from is None:
            return self.schema
        return StructType([*self.schema.fields, StructField(self.date_col, DateType())])


TABLES = {
    "stg_telemetry_raw": Table(
        STAGING, schemas.STG_TELEMETRY, "reading_date", "reading_timestamp", ("device_id", "reading_timestamp")
    ),
    "stg_meter_health_logs": Table(
        STAGING, schemas.STG_HEALTH_LOGS, "log_date", "log_timestamp", ("device_id", "log_timestamp")
    ),
    "load_ledger": Table(STAGING, schemas.LEDGER, id_cols=("topic", "split")),
    "load_counts": Table(STAGING, schemas.LOAD_COUNTS),
    # Partitioned by note rather than by date, so that a note goes with its partition.
    "pending_changes": Table(STAGING, schemas.PENDING, "note"),
    "rejected_messages": Table(STAGING, schemas.REJECTS, "reject_date", "rejected_at", ("topic",)),
    "late_readings": Table(
        STAGING, schemas.LATE_READINGS, "reading_date", "reading_timestamp", ("batch", "device_id", "reading_timestamp")
    ),
    "device_hourly_metrics": Table(
        MARTS, schemas.DEVICE_HOURLY, "reading_date", id_cols=("device_id", "reading_hour")
    ),
    "device_daily_metrics": Table(MARTS, schemas.DEVICE_DAILY, "reading_date", id_cols=("device_id",)),
    "device_monthly_metrics": Table(MARTS, schemas.DEVICE_MONTHLY, "reading_month", id_cols=("device_id",)),
    "customer_daily_usage_summary": Table(
        MARTS, schemas.CUSTOMER_DAILY, "reading_date", id_cols=("customer_id",)
    ),
    "customer_monthly_usage_summary": Table(
        MARTS, schemas.CUSTOMER_MONTHLY, "reading_month", id_cols=("customer_id",)
    ),
    "customer_usage_mtd_summary": Table(MARTS, schemas.CUSTOMER_MTD, id_cols=("customer_id",)),
    "device_daily_metrics_state": Table(MARTS, schemas.DEVICE_DAILY_STATE, "reading_date", id_cols=("device_id",)),
    "device_monthly_metrics_state": Table(MARTS, schemas.DEVICE_MONTHLY_STATE, "reading_month", id_cols=("device_id",)),
    "customer_daily_usage_summary_state": Table(
        MARTS, schemas.CUSTOMER_DAILY_STATE, "reading_date", id_cols=("customer_id",)
    ),
    "customer_monthly_usage_summary_state": Table(
        MARTS, schemas.CUSTOMER_MONTHLY_STATE, "reading_month", id_cols=("customer_id",)
    ),
}


class Lake:
    """Tables below ``root``, a folder that every executor can reach, known to Spark's catalog.

    The catalog says which files a table has, so replacing is a change of the catalog: a
    partition gets the location of its new files, a table that is rebuilt is written as a new table that
    its name, a view, is then switched to. A reader that has started keeps the files it
    began with; :meth:`drop_replaced` removes them later. Sessions that are to share a lake
    share a catalog (a metastore); in a session of its own, a lake begins empty.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = use_utc(spark)
        self.root = root.rstrip("/")
        self._catalog_name = "lake_" + hashlib.sha256(self.root.encode()).hexdigest()[:12]

    # -- places ------------------------------------------------------------

    def _database(self, name: str) -> str:
        return f"{self._catalog_name}_{TABLES[name].layer}"

    def name(self, name: str) -> str:
        """What SQL calls a table of this lake: a view of the table that holds its rows now."""
        return f"`{self._database(name)}`.`{name}`"

    def _held_by(self, name: str) -> str:
        """The table that holds the rows now."""
        version = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(name)} ('version')").first()["value"]
        return f"`{self._database(name)}`.`{name}__{version}`"

    def _new_place(self, name: str) -> str:
        return f"{self.root}/{TABLES[name].layer}/{name}/{uuid.uuid4().hex}"

    def work_path(self, load: str, name: str, step: str) -> str:
        """Place for the rows of one load; no two loads share one."""
        return f"{self.root}/_work/load-{load}/{name}-{step}"

    def clear_work(self, load: str) -> None:
        self._remove(f"{self.root}/_work/load-{load}")

    def _remove(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self._database(name)}.{name}")

    # -- reading -----------------------------------------------------------

    def read(self, name: str, where: Column | None = None) -> DataFrame:
        """A table with its declared columns; ``where`` may use the partition column."""
        table, held = TABLES[name], self._held_by(name)
        # Another session may have added files or partitions.
        self.spark.catalog.refreshTable(held)
        df = self.spark.table(held)
        if where is not None:
            df = df.filter(where)
        return df.select(*table.schema.names)

    def read_dates(self, name: str, dates: Sequence[dt.date] | None) -> DataFrame:
        """The partitions of the given dates, or the whole table for None; only their folders are listed."""
        if dates is None:
            return self.read(name)
        return self.read(name, F.col(TABLES[name].date_col).isin(list(dates)))

    def dates(self, name: str) -> list[dt.date]:
        """Dates a table has partitions for, from the catalog alone."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self._held_by(name)}").collect()
        days = [r["partition"].split("=", 1)[1] for r in rows]
        return sorted(dt.date.fromisoformat(d) for d in days if not d.startswith("__"))

    def size(self, name: str, dates: Sequence[dt.date] | None) -> int:
        """Bytes on disk of the given dates, or of the whole table for None."""
        if TABLES[name].date_col is None:
            return estimated_bytes(self.read(name)) or 0
        there = self.dates(name)
        wanted = there if dates is None else [d for d in dates if d in set(there)]
        # A condition on the partition column makes Spark list the files.
        return estimated_bytes(self.read_dates(name, wanted)) or 0 if wanted else 0

    def date_slices(self, name: str, most: int) -> list[list[dt.date]]:
        """Dates of a table in runs of up to ``most`` bytes, one date at least."""
        slices: list[list[dt.date]] = []
        total = 0
        for date in self.dates(name):
            size = self.size(name, [date])
            if not slices or total + size > most:
                slices.append([])
                total = 0
            slices[-1].append(date)
            total += size
        return slices

    def read_newest(self, name: str) -> DataFrame:
        """The partition of the latest date: the newest rows are there."""
        dates = self.dates(name)
        return self.read_dates(name, dates[-1:]) if dates else self.read(name)

    # -- changes the marts do not show yet ----------------------------------

    def pending_notes(self) -> list[str]:
        """Names of the notes that are there now."""
        if not self.exists("pending_changes"):
            return []
        rows = self.spark.sql(f"SHOW PARTITIONS {self._held_by('pending_changes')}").collect()
        return sorted(r["partition"].split("=", 1)[1] for r in rows)

    def pending(self, notes: Sequence[str] | None = None) -> DataFrame:
        """Device hours whose readings changed but whose marts may be old.

        A row without a device stands for its whole date, one without a date for everything.
        """
        notes = self.pending_notes() if notes is None else notes
        return self.read("pending_changes", F.col("note").isin(list(notes)))

    def pending_dates(self, notes: Sequence[str] | None = None) -> list[dt.date] | None:
        """Dates whose readings changed but whose marts may be old (None: all dates).

        Noted before staging changes, one note per load, and removed after the marts
        are done, so that a run cut short in between is made good by the next one.
        """
        notes = self.pending_notes() if notes is None else notes
        if not notes:
            return []
        found = {r[0] for r in self.pending(notes).select("reading_date").distinct().collect()}
        return None if None in found else sorted(found)

    def note_pending(self, changed: DataFrame | Sequence[dt.date] | None) -> str:
        """Add a note of changed device hours, or of whole dates (None: of everything); those of other loads stay."""
        schema, note = TABLES["pending_changes"].schema, uuid.uuid4().hex
        if not isinstance(changed, DataFrame):
            dates = [None] if changed is None else changed
            columns = "device_id STRING, reading_hour TIMESTAMP, reading_date DATE"
            changed = self.spark.createDataFrame([(None, None, d) for d in dates], columns)
        rows = changed.withColumn("note", F.lit(note)).select(*schema.names)
        self.append(rows, "pending_changes")
        return note

    def clear_pending(self, notes: Sequence[str]) -> None:
        """Remove the notes that were read; one that has come since stays."""
        for note in notes:
            self.spark.sql(f"ALTER TABLE {self._held_by('pending_changes')} DROP IF EXISTS PARTITION (note = '{note}')")

    # -- writing -----------------------------------------------------------

    def _stored(self, df: DataFrame, table: Table) -> DataFrame:
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields])
        if table.date_from is not None:
            df = df.withColumn(table.date_col, F.to_date(table.date_from))
        return df

    def _laid_out(self, df: DataFrame, table: Table) -> DataFrame:
        """Rows range-partitioned by date and id.

        Ranges are cut from a sample of the rows, so that a date or device with
        very many rows is spread over several files, and small dates share a task.
        """
        keys = [c for c in (table.date_col, *table.id_cols) if c]
        return df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df

    def _in_file_order(self, df: DataFrame, table: Table) -> DataFrame:
        """Columns as tables store them: the partition column last."""
        names = [f.name for f in table.stored_schema.fields if f.name != table.date_col]
        return df.select(*names, *([table.date_col] if table.date_col else []))

    def _create(self, name: str) -> str:
        """A new, empty table of a name of its own in a folder of its own."""
        table, database = TABLES[name], self._database(name)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        held = f"`{database}`.`{name}__{uuid.uuid4().hex}`"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.stored_schema.fields)
        by_date = f"PARTITIONED BY (`{table.date_col}`)" if table.date_col else ""
        self.spark.sql(
            f"CREATE TABLE {held} ({columns}) USING parquet OPTIONS (compression 'snappy') {by_date} "
            f"LOCATION '{self._new_place(name)}'"
        )
        return held

    def _switch(self, name: str, held: str) -> None:
        """Make the name stand for another table: one change of the catalog.

        The old one stays until :meth:`drop_replaced`: a reader may be at it.
        """
        columns = ", ".join(f"`{c}`" for c in TABLES[name].schema.names)
        version = held.rstrip("`").rsplit("__", 1)[1]
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(name)} TBLPROPERTIES ('version' = '{version}') AS SELECT {columns} FROM {held}"
        )

    def _insert(self, df: DataFrame, name: str, held: str, seen: Observation | None = None) -> None:
        table = TABLES[name]
        rows = self._in_file_order(self._laid_out(self._stored(df, table), table), table)
        if seen is not None:
            # Above the range partitioning, whose sample runs what is below it once more.
            rows = rows.observe(seen, F.count(F.lit(1)).alias("n"))
        rows.write.insertInto(held)

    def write_full(self, df: DataFrame, name: str, seen: Observation | None = None) -> None:
        """Replace a table: a failed job leaves the old one. ``seen`` gets the number of rows as ``n``."""
        held = self._create(name)
        self._insert(df, name, held, seen)
        self._switch(name, held)

    def write_in_slices(self, slices: Iterable[DataFrame], name: str) -> None:
        """Replace a table by the rows of several frames, written one after the other."""
        held = self._create(name)
        for df in slices:
            self._insert(df, name, held)
        self._switch(name, held)

    def write_dates(self, df: DataFrame, name: str, dates: Sequence[dt.date]) -> None:
        """Replace the partitions of the given dates; those that ``df`` has no rows for go, all others stay.

        The new files are written to a place of their own first. Then each date changes at once
        in the catalog: a reader sees a date as it was or as it is.
        """
        table, place, held = TABLES[name], self._new_place(name), self._held_by(name)
        rows = self._laid_out(self._stored(df, table), table)
        rows.write.option("compression", "snappy").partitionBy(table.date_col).parquet(place)
        schema = StructType([StructField(table.date_col, DateType())])
        written = self.spark.read.schema(table.stored_schema).parquet(place)
        found = {r[0] for r in written.select(schema[0].name).distinct().collect()}
        there = set(self.dates(name))
        for date in dates:
            part = f"PARTITION (`{table.date_col}` = DATE '{date}')"
            where = f"LOCATION '{place}/{table.date_col}={date}'"
            if date not in found:
                self.spark.sql(f"ALTER TABLE {held} DROP IF EXISTS {part}")
            elif date in there:
                self.spark.sql(f"ALTER TABLE {held} {part} SET {where}")
            else:
                self.spark.sql(f"ALTER TABLE {held} ADD IF NOT EXISTS {part} {where}")

    def replace_dates(self, df: DataFrame, name: str, dates: Sequence[dt.date] | None) -> None:
        """Partitions of the given dates, or the whole table for None."""
        if dates is None or not self.exists(name) or TABLES[name].date_col is None:
            self.write_full(df, name)
        else:
            self.write_dates(df, name, dates)

    def append(self, df: DataFrame, name: str) -> None:
        """Add rows to a table, each date's to its own partition."""
        if not self.exists(name):
            self._switch(name, self._create(name))
        self._insert(df, name, self._held_by(name))

    def drop_replaced(self, name: str) -> list[str]:
        """Remove the versions of a table that its name stood for before, and the folders without its rows; their names.

        For a time when no reader is left that began before the last replacement, and no load is running.
        """
        if not self.exists(name):
            return []
        database, held = self._database(name), self._held_by(name)
        for row in self.spark.sql(f"SHOW TABLES IN `{database}` LIKE '{name}__*'").collect():
            if f"`{database}`.`{row['tableName']}`" != held:
                self.spark.sql(f"DROP TABLE `{database}`.`{row['tableName']}`")
        used = {f.split(f"/{name}/", 1)[1].split("/", 1)[0] for f in self.read(name).inputFiles() if f"/{name}/" in f}
        # New files of the table itself go below its own location.
        own = self.spark.sql(f"DESCRIBE FORMATTED {held}").filter("col_name = 'Location'").first()
        used.add(own["data_type"].rstrip("/").rsplit("/", 1)[1])
        home = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{TABLES[name].layer}/{name}")
        folders = home.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(home)
        gone = sorted({f.getPath().getName() for f in folders} - used)
        for folder in gone:
            self._remove(f"{self.root}/{TABLES[name].layer}/{name}/{folder}")
        return gone

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """Rows as they are stored: declared columns and the date column."""
        return self._stored(df, TABLES[name])

    def write_work(self, df: DataFrame, load: str, name: str, step: str) -> DataFrame:
        """Write the rows of one load as they are and read them back.

        Later steps use the rows several times; from here on a lost executor
        costs a file read, not another scan of the source.
        """
        path = self.work_path(load, name, step)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # -- catalog -----------------------------------------------------------

    def register(self) -> None:
        """Make every existing table known to SQL as ``layer.table``."""
        for name, table in TABLES.items():
            if self.exists(name):
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{table.layer}`")
                self.spark.sql(f"CREATE OR REPLACE VIEW `{table.layer}`.`{name}` AS SELECT * FROM {self.name(name)}")
