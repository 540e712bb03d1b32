"""What the operators share: reading tables, text keys, the shared folder."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# ASCII white space: the characters that separate words.
BLANKS = " \t\n\r\x0b\x0c"


def reach_workers() -> None:
    """Where Python workers can't import this package, send its functions along instead."""
    paths = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths and os.path.abspath(os.getcwd()) != ROOT:
        cloudpickle.register_pickle_by_value(sys.modules[__package__])


reach_workers()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. A local session without one (tests) gets a temporary one, a cluster an error."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="llm-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder once and read from there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def packed(df: DataFrame, keep: list[str] | None = None) -> Column:
    """The kept columns of a row (all by default) in one, so that helper columns can't clash with them."""
    names = [c.replace("`", "``") for c in keep or df.columns]
    return F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")


def with_row(rows: DataFrame, **columns: str | T.DataType) -> T.StructType:
    """Schema of the packed row and further columns."""
    schema = T.StructType([rows.schema["row"]])
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


def key_columns(value: Column, name: str = "k") -> list[Column]:
    """128 bits that stand for a text: two hashes with different seeds."""
    return [F.xxhash64(value).alias(f"{name}1"), F.xxhash64(F.lit(7), value).alias(f"{name}2")]


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
