"""Message topics: reading them, as a table or a stream, and encoding records for them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from meterflow import schemas
from meterflow.operators.progress import starting_offsets

# Fixed value: messages one scan task should read.
MESSAGES_PER_SPLIT = 10_000


@dataclass(frozen=True)
class Topic:
    """Where the messages of one topic are.

    ``kind`` is ``kafka``, or ``parquet`` / ``json`` / ``text`` for files that
    hold the same columns (text files: one message per line, without key and
    time). A task of a Kafka scan reads ``MESSAGES_PER_SPLIT`` messages at most;
    ``expected_messages`` asks for more, smaller splits. ``max_per_trigger`` bounds one
    micro-batch (messages, or files). ``partitions`` is the number of partitions a Kafka
    topic has, so that progress by offsets finds new ones.
    """

    kind: str
    path: str | None = None
    servers: str | None = None
    name: str | None = None
    expected_messages: int | None = None
    max_per_trigger: int | None = None
    partitions: int = 0
    options: Mapping[str, str] = field(default_factory=dict)

    def source_options(self, streaming: bool) -> dict[str, str]:
        opts = dict(self.options)
        if self.kind == "kafka":
            opts.setdefault("kafka.bootstrap.servers", self.servers or "")
            opts.setdefault("subscribe", self.name or "")
            opts.setdefault("startingOffsets", "earliest")
            opts.setdefault("maxRecordsPerPartition", str(MESSAGES_PER_SPLIT))
            if self.expected_messages:
                splits = -(-self.expected_messages // MESSAGES_PER_SPLIT)
                opts.setdefault("minPartitions", str(splits))
            if streaming and self.max_per_trigger:
                opts.setdefault("maxOffsetsPerTrigger", str(self.max_per_trigger))
        elif streaming and self.max_per_trigger:
            opts.setdefault("maxFilesPerTrigger", str(self.max_per_trigger))
        return opts


def read_topic(spark: SparkSession, topic: Topic, streaming: bool = False) -> DataFrame:
    """Messages as ``_key``, ``_message``, ``_timestamp``."""
    if topic.kind not in ("kafka", "text", "parquet", "json"):
        raise ValueError(f"unknown topic kind {topic.kind!r}")
    reader = (spark.readStream if streaming else spark.read).options(**topic.source_options(streaming))
    if topic.kind == "kafka":
        return _kafka_columns(reader.format("kafka").load(), [])
    if topic.kind != "text":
        reader = reader.schema(schemas.TOPIC)
    return _file_columns(reader.format(topic.kind).load(topic.path), topic)


def _kafka_columns(raw: DataFrame, place: list[Column]) -> DataFrame:
    return raw.select(
        F.col("key").cast("string").alias("_key"),
        F.col("value").cast("string").alias("_message"),
        F.col("timestamp").alias("_timestamp"),
        *place,
    )


def _file_columns(rows: DataFrame, topic: Topic) -> DataFrame:
    if topic.kind != "text":
        return rows
    return rows.select(
        F.lit(None).cast("string").alias("_key"),
        F.col("value").alias("_message"),
        F.lit(None).cast("timestamp").alias("_timestamp"),
    )


def read_new(spark: SparkSession, topic: Topic, done: DataFrame | None) -> tuple[DataFrame, list[str] | None]:
    """Messages that no load has read, with their place (``_split``, ``_offset``), and the new files.

    ``done`` has the end of each split read so far (None: nothing). A Kafka scan starts at
    these offsets; of files only those whose names aren't there are opened, so files must not change.
    The list of new files is None for Kafka, whose end shows in the messages.
    """
    if topic.kind == "kafka":
        known = {r["split"]: r["end_offset"] for r in done.collect()} if done is not None else {}
        options = topic.source_options(False)
        if known:
            options["startingOffsets"] = starting_offsets(known, topic.name or "", topic.partitions)
        raw = spark.read.format("kafka").options(**options).load()
        place = [F.col("partition").cast("string").alias("_split"), F.col("offset").alias("_offset")]
        return _kafka_columns(raw, place), None
    files = spark.createDataFrame([(f,) for f in _reader(spark, topic).load(topic.path).inputFiles()], "split STRING")
    if done is not None:
        files = files.join(done, "split", "left_anti")
    new = sorted(r["split"] for r in files.distinct().collect())
    if not new:
        none = spark.createDataFrame([], schemas.TOPIC)
        return none.withColumns({"_split": F.lit(""), "_offset": F.lit(0).cast("bigint")}), []
    rows = _reader(spark, topic).load([unquote(f) for f in new])
    place = {"_split": F.input_file_name(), "_offset": F.lit(None).cast("bigint")}
    return _file_columns(rows, topic).withColumns(place), new


def _reader(spark: SparkSession, topic: Topic) -> DataFrameReader:
    """Reader of the files of a topic."""
    reader = spark.read.options(**topic.source_options(False))
    if topic.kind == "text":
        return reader.format("text")
    if topic.kind in ("parquet", "json"):
        return reader.format(topic.kind).schema(schemas.TOPIC)
    raise ValueError(f"unknown topic kind {topic.kind!r}")


def dealt_out(messages: DataFrame) -> DataFrame:
    """Messages over all cores, where the source has fewer splits than that.

    Parsing costs far more than moving the text once; a source that already
    has enough splits is left as it is.
    """
    if messages.isStreaming:
        return messages
    cores = messages.sparkSession.sparkContext.defaultParallelism
    return messages if messages.rdd.getNumPartitions() >= cores else messages.repartition(cores)


def to_records(df: DataFrame, key_col: str) -> DataFrame:
    """Rows as keyed JSON records (``key``, ``value``), ready for a Kafka sink."""
    return df.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )


def telemetry_body(readings: DataFrame) -> DataFrame:
    """Readings in the shape of the JSON message."""
    return readings.select(
        "device_id",
        "customer_id",
        F.date_format("reading_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.struct("energy_kwh", "voltage", "battery_pct").alias("metrics"),
        "status",
    )


def write_records(records: DataFrame, topic: Topic) -> None:
    """Send ``key``/``value`` records to a Kafka topic."""
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", topic.servers)
        .option("topic", topic.name)
        .options(**topic.options)
        .save()
    )
