"""How far a topic has been read, and what became of its messages.

Progress is a table of offsets: one row per load and topic partition, or file. A load
reads from where the last one ended, so the topic is never read twice. The rows of a load
are written before its progress is: a load cut short in between is read again and, as
held keys are not loaded twice, adds nothing.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow import schemas
from meterflow.operators.dedup import dedup_latest

# Offset that stands for the oldest message a topic partition still holds.
EARLIEST = -2


def progress_rows(messages: DataFrame, load_id: str, topic: str, loaded_at: Column) -> DataFrame:
    """Ledger rows of one load, from messages that carry ``_split`` and ``_offset``.

    Messages of a file have no offset: their number counts in its place.
    """
    offset = F.col("_offset").cast("bigint")
    spans = messages.groupBy(F.col("_split").cast("string").alias("split")).agg(
        F.coalesce(F.min(offset), F.lit(0)).alias("start_offset"),
        F.coalesce(F.max(offset) + 1, F.count(F.lit(1))).alias("end_offset"),
        F.count(F.lit(1)).alias("messages"),
    )
    rows = spans.withColumns({"load_id": F.lit(load_id), "topic": F.lit(topic), "loaded_at": loaded_at})
    return rows.select(*schemas.LEDGER.names)


def ends(ledger: DataFrame, topic: str) -> DataFrame:
    """Per split of a topic, where the next load begins."""
    rows = ledger.filter(F.col("topic") == topic)
    return rows.groupBy("split").agg(F.max("end_offset").alias("end_offset"))


def unread(messages: DataFrame, ledger: DataFrame, topic: str) -> DataFrame:
    """Messages at or after the end of their split; those of a split not read yet are all unread."""
    done = ends(ledger, topic).select(F.col("split").alias("_split"), "end_offset")
    split = messages.withColumn("_split", F.col("_split").cast("string"))
    left = split.join(done, "_split", "left").filter(
        F.col("end_offset").isNull() | (F.col("_offset") >= F.col("end_offset"))
    )
    return left.select(*messages.columns)


def starting_offsets(known: Mapping[str, int], topic: str, partitions: int) -> str:
    """Where a topic scan begins, as the source wants it: every partition, new ones from their oldest message."""
    at = {str(p): EARLIEST for p in range(partitions)}
    at.update({split: int(offset) for split, offset in known.items()})
    return json.dumps({topic: dict(sorted(at.items(), key=lambda x: int(x[0])))})


def fates(
    read: DataFrame, held: DataFrame | None, key: Sequence[str], latest_by: Sequence[str], taken: Column | None = None
) -> DataFrame:
    """How many of the messages read a load leaves out, and why: ``fate``, ``messages``.

    A message is blank, rejected, lost (``taken`` is not true of it), staged, or a copy: its key is
    held already, or another message with that key is later. ``held`` has the keys a
    table holds. Fates without a message have no row.
    """
    reason = F.col("reject_reason")
    settled = F.when(reason == "blank", "blank").when(reason.isNotNull(), "rejected")
    if taken is not None:
        settled = settled.when(~F.coalesce(taken, F.lit(False)), "lost")
    marked = read.withColumn("_fate", settled)
    left = dedup_latest(marked.filter("_fate is null"), key, latest_by)
    if held is not None:
        left = left.join(held.select(*key), list(key), "left_anti")
    counted = marked.groupBy(F.coalesce("_fate", F.lit("copy")).alias("fate")).agg(F.count(F.lit(1)).alias("messages"))
    staged = left.agg(F.count(F.lit(1)).alias("n"))
    # What is staged is taken off those that were still open.
    moved = staged.select(F.inline(F.array(
        F.struct(F.lit("staged").alias("fate"), F.col("n").alias("messages")),
        F.struct(F.lit("copy").alias("fate"), (-F.col("n")).alias("messages")),
    )))
    total = counted.unionByName(moved).groupBy("fate").agg(F.sum("messages").alias("messages"))
    return total.filter("messages > 0")


def count_row(load_id: str, topic: str, counts: Mapping[str, int], loaded_at: dt.datetime | None) -> list[Column]:
    """One row of the counts table."""
    numbers = ("messages", "blank", "rejected", "lost", "copies", "staged")
    at = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return [
        F.lit(load_id).alias("load_id"),
        F.lit(topic).alias("topic"),
        *[F.lit(int(counts.get(n, 0))).cast("bigint").alias(n) for n in numbers],
        at.alias("loaded_at"),
    ]
