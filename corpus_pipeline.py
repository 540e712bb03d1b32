"""From raw documents to token ids: the stages, each over all that the one before kept.

In every stage a null text counts as an empty one, further columns pass through unchanged, whatever
their names, and an empty table gives an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import bpe, decontaminate, fertility, jaccard_forest, line_runs
from meterflow.llm.common import shared_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands; empty texts fail the base. Repeated rows share their fate."""
    return fertility.rate_documents(docs).filter("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of smaller id holds.

    Lines that only one document holds stay, however often. A document may end up empty.
    """
    kept = line_runs.dedup_lines(docs)
    fields = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    changed = F.col("row")
    for name, value in fields.items():
        if name in docs.columns:
            changed = changed.withField(name, value)
    return kept.select(F.when(F.col("n_dropped") > 0, changed).otherwise(F.col("row")).alias("row")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id, once if its row is repeated.

    Empty texts are copies of one another; ids of null go only where their class has another id.
    """
    near = jaccard_forest.join_near(docs)
    chosen = near.filter(F.col("row.doc_id").eqNullSafe(F.col("class_id")))
    # Rows may repeat an id.
    return chosen.withColumn("id", F.col("row.doc_id")).dropDuplicates(["root", "id"]).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item and no long part of one; an empty benchmark keeps all, empty texts stay."""
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), parts=True)
    return found.filter(F.size("leaks") == 0).select("row.*")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of what they decode to; an empty text has no ids."""
    encoded = bpe.encode_texts(docs, keep=["doc_id", *[c for c in ("lang", "source") if c in docs.columns]])
    return encoded.select(
        "row.*",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", byte_bpe),
]

# The stages can't be expressed in SQL: they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}-{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
