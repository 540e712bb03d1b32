"""Joins of many rows to a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.session import MAX_REDUCERS

# Keys a count of frequent keys returns, and keys a task keeps counters for while counting.
FREQUENT, COUNTERS = 1_000, 10_000

# Bytes of files that the rows a task groups in memory should stem from; the groups take far more room there.
TASK_BYTES = 8 << 20

# Estimates this large mean that Spark knows nothing about the size.
UNKNOWN_BYTES = 1 << 50


def estimated_bytes(df: DataFrame) -> int | None:
    """Size Spark's optimizer expects, from file sizes; None where it does not know."""
    if not hasattr(df, "_jdf"):  # a remote session has no local plan
        return None
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < UNKNOWN_BYTES else None


def stored_bytes(df: DataFrame) -> int | None:
    """Size of the files a frame is read from, each as often as it is read; None where Spark does not know."""
    if not hasattr(df, "_jdf") or df.isStreaming:
        return None
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(sizes) if max(sizes, default=0) < UNKNOWN_BYTES else None


def tasks_by_size(df: DataFrame) -> int | None:
    """Tasks that leave each about ``TASK_BYTES`` of a frame's files; None where the usual ones do.

    Adaptive execution joins what it finds small, up to 64 MB of compressed shuffle a task: a task's memory
    grows with the input until then. A number that is asked for by ``repartition`` stays.
    """
    size = stored_bytes(df)
    if size is None:
        return None
    spark = df.sparkSession
    usual = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    needed = min(MAX_REDUCERS, -(-size // TASK_BYTES))
    return needed if needed > usual else None


def broadcast_limit(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    text = raw.strip().lower().removesuffix("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    return int(text[:-1]) * units[text[-1]] if text[-1:] in units else int(text)


def small_enough_to_broadcast(df: DataFrame) -> bool:
    """Whether a table is known to fit, by its estimated size in bytes; one of unknown size is not."""
    limit = broadcast_limit(df)
    if limit < 0:
        return False
    size = estimated_bytes(df)
    return size is not None and size <= limit


def frequent_keys(rows: DataFrame, keys: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Hashes (``_key``) of the keys that hold more rows than a task should get, and in how many parts to cut each.

    A fair share is the rows over ``tasks`` (by default the shuffle partitions). The rows are
    counted by a sketch of frequent items: a task keeps ``COUNTERS`` counters whatever the number of
    keys, so a count may be off by a few of ``COUNTERS``-th parts of the rows. That only moves the
    number of parts. A part is half a share, as two may meet in one task. At most ``FREQUENT`` rows.
    """
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = rows.select(F.xxhash64(*keys).alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {FREQUENT}, {COUNTERS})").alias("top"), F.count(F.lit(1)).alias("n")
    )
    share = F.col("top.count") * tasks / F.col("n")
    return (
        counted.select("n", F.explode("top").alias("top"))
        .filter(share > 1)
        .select(F.col("top.item").alias("_key"), F.ceil(share * 2).alias("_parts"))
    )


def salted(rows: DataFrame, table: DataFrame, keys: Sequence[str], frequent: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: rows of a frequent key are dealt to its parts, which its table row is repeated for.

    All other rows have part 0, and their table rows stay single.
    """
    spread = [c for c in rows.columns if c not in keys] or list(keys)

    def with_parts(df: DataFrame) -> DataFrame:
        df = df.withColumn("_key", F.xxhash64(*keys)).join(F.broadcast(frequent), "_key", "left").drop("_key")
        return df.withColumn("_parts", F.coalesce("_parts", F.lit(1).cast("bigint")))

    dealt = with_parts(rows).withColumn("_salt", F.pmod(F.xxhash64(*spread), F.col("_parts")))
    repeated = with_parts(table).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)))
    return dealt.drop("_parts"), repeated.drop("_parts")


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    bound: DataFrame | None = None,
    counted: DataFrame | None = None,
    ship: bool | None = None,
) -> DataFrame:
    """Join ``rows`` to ``table``, which holds each key at most once.

    A table known to be small is shipped to every task; ``bound`` is a frame at
    least as large as ``table`` to judge by where ``table`` itself is a join, and ``ship`` decides
    without judging. A larger one is shuffled, and the keys that hold more of ``rows`` than a task should get
    are cut into parts by their measured share, those keys alone (:func:`frequent_keys`). Counting reads the key
    columns once more; ``counted`` is a frame with about the same keys that is cheaper to read than ``rows``.
    The part is a hash of the row itself: a re-run task puts each row where it was before.
    Copies of one row stay in one part. A stream can't be counted first: its keys are not cut.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if small_enough_to_broadcast(table if bound is None else bound) if ship is None else ship:
        return rows.join(F.broadcast(table), keys, how)
    if rows.isStreaming:
        return rows.join(table, keys, how)
    frequent = frequent_keys(rows if counted is None else counted, keys)
    dealt, repeated = salted(rows, table, keys, frequent)
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")
