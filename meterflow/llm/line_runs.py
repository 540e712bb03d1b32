"""Line deduplication against levelled sorted runs of line hashes.

Documents come in batches by ascending ``doc_id``. A run is a table of line
hashes, each with the smallest ``doc_id`` that holds the line, bucketed and sorted
by hash. A new batch is merge-anti-joined with every run, what is left becomes a
run of level 0, and ``fan_in`` runs of a level are compacted into one of the next.
A line of a later document is dropped if a run or an earlier document of its own
batch holds it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.common import BLANKS, key_columns, packed, whole, written

MIN_CHARS = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST = 2**63 - 1
HASH = ["h1", "h2"]


def line_keys(text: Column) -> Column:
    """Lines of a text, stripped of ASCII blanks at both ends, A-Z in lower case."""
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.transform(F.split(lowered, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """The runs, in the warehouse; :meth:`close` drops them."""

    def __init__(self, spark: SparkSession, fan_in: int = 3):
        self.spark, self.fan_in = spark, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = [[]]

    def _write(self, run: DataFrame) -> str:
        name = f"{self.name}_{uuid.uuid4().hex[:12]}"
        dealt = run.repartition(self.buckets, *HASH).sortWithinPartitions(*HASH)
        dealt.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).format("parquet").saveAsTable(name)
        return name

    def _runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """Adds a batch of (h1, h2, did, ...) rows; returns those whose line is held by a smaller did.

        Every ``did`` has to be larger than those of all earlier batches.
        """
        keys = lines.groupBy(*HASH).agg(F.min("did").alias("first"), F.max("did").alias("last"))
        keys = written(keys, "line-keys")
        fresh = keys
        for run in self._runs():
            fresh = fresh.join(run.hint("merge"), HASH, "left_anti")
        fresh = written(fresh, "line-fresh")
        held = keys.join(fresh.select(*HASH), HASH, "left_anti").select(*HASH, F.lit(None).cast("long").alias("owner"))
        shared = fresh.filter("last > first").select(*HASH, F.col("first").alias("owner"))
        repeated = lines.join(held.unionByName(shared), HASH).filter("owner is null or did > owner").drop("owner")
        repeated = written(repeated, "line-repeated")
        self.levels[0].append(self._write(fresh.select(*HASH, "first")))
        self._compact()
        return repeated

    def _compact(self) -> None:
        for level, names in enumerate(self.levels):
            if len(names) < self.fan_in:
                return
            merged = self.spark.table(names[0])
            for name in names[1:]:
                merged = merged.unionByName(self.spark.table(name))
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(merged))
            self.levels[level] = []
            for name in names:
                self.spark.sql(f"DROP TABLE {name}")

    def close(self) -> None:
        for level in self.levels:
            for name in level:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = [[]]


def dedup_lines(documents: DataFrame, min_chars: int = MIN_CHARS, batches: int = 4, fan_in: int = 3) -> DataFrame:
    """``row`` (all input columns), ``n_lines``, ``n_dropped`` and ``kept``, the text that is left.

    A line counts by its key: stripped of ASCII blanks, A-Z in lower case. Keys of
    at least ``min_chars`` code points that occur in two documents or more lose all
    their lines but those in the document of the smallest ``doc_id``. Rows with
    the same ``doc_id`` are one document; a null ``doc_id`` comes after all others,
    and all such rows are one document. A null or empty text has one empty line.
    Lines repeated within one document only stay. An empty table gives no rows.
    ``batches`` is the number of batches by ``doc_id``; the result doesn't depend on it.
    """
    spark = documents.sparkSession
    did = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    text = whole(F.col("text"))
    cuts = documents.agg(
        F.percentile_approx(did, [i / batches for i in range(1, batches)], 10_000)
    ).first()[0] or []
    batch = F.lit(0)
    for cut in sorted(set(cuts)):
        batch = batch + F.when(did > cut, 1).otherwise(0)
    lines = (
        documents.select(did.alias("did"), *key_columns(text, "t"), batch.alias("batch"), line_keys(text).alias("keys"))
        .select("did", "t1", "t2", "batch", F.posexplode("keys").alias("pos", "key"))
        .filter(F.length("key") >= min_chars)
        .select("did", "t1", "t2", "batch", "pos", *key_columns(F.col("key"), "h"))
    )
    lines = written(lines, "lines")
    runs = LineRuns(spark, fan_in)
    dropped = None
    try:
        for number in range(len(set(cuts)) + 1):
            found = runs.add(lines.filter(F.col("batch") == number)).select("did", "t1", "t2", "pos")
            dropped = found if dropped is None else dropped.unionByName(found)
    finally:
        runs.close()
    places = dropped.groupBy("did", "t1", "t2").agg(F.collect_set(F.col("pos") + 1).alias("places"))
    rows = documents.select(packed(documents), did.alias("did"), *key_columns(text, "t"))
    joined = rows.join(places, ["did", "t1", "t2"], "left")
    split = F.split(whole(F.col("row.text")), "\n")
    marked = joined.select(
        "row", split.alias("lines"), F.coalesce("places", F.array().cast("array<int>")).alias("places")
    )
    stay = F.array_except(F.sequence(F.lit(1), F.size("lines")), F.col("places"))
    kept = F.when(F.size("places") == 0, whole(F.col("row.text"))).otherwise(
        F.array_join(F.transform(stay, lambda i: F.element_at("lines", i)), "\n")
    )
    return marked.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("places").cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )
