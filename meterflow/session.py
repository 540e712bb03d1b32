"""Spark session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# UTC keeps hour and day boundaries the same on every executor; the adaptive
# settings let Spark size, split and re-plan shuffles from what they really hold.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "meterflow", master: str | None = None, **conf) -> SparkSession:
    """Session with the library's settings; ``conf`` adds or replaces settings."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Make an existing session evaluate timestamps in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, fallback: str) -> str:
    """Folder every executor can reach: the cluster's own, or ``fallback`` where none is set."""
    return spark.conf.get("spark.checkpoint.dir", None) or fallback


def kept(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read from there, which cuts their lineage.

    The folder is the cluster's own (``spark.checkpoint.dir``); a local session without one gets a temporary one.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="meterflow-"))
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    path = f"{folder.rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# One reduce task should get about this much, and one shuffle no more tasks than this:
# every map task writes a block for each of them.
REDUCE_BYTES = 512 << 20
MAX_REDUCERS = 20_000
# Inputs above this are read in larger pieces, again to keep the number of blocks down.
LARGE_INPUT = 10 << 40


@contextmanager
def fitted_to_input(spark: SparkSession, input_bytes: int | None):
    """Shuffles as wide as an input of this size needs, for the jobs run inside.

    The width is only ever raised: adaptive execution joins small partitions, but
    does not split those of an aggregation that was planned too narrow.
    """
    settings: dict[str, str] = {}
    if input_bytes is not None:
        needed = min(MAX_REDUCERS, -(-input_bytes // REDUCE_BYTES))
        if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
            settings["spark.sql.shuffle.partitions"] = str(needed)
        if input_bytes > LARGE_INPUT:
            settings["spark.sql.files.maxPartitionBytes"] = "512m"
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
