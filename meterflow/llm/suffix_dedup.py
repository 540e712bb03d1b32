"""Removal of byte strings that occur more than once, by a sampled suffix array.

Not every suffix is sorted. In each string of ``length`` bytes a rule that looks at
its bytes only picks one place, the anchor; equal strings have equal anchors, so
suffixes that begin at anchors find every repeated string. An anchor with the
strings that chose it is a segment: the bytes before the anchor that they reach
back to, and the bytes after it.

Segments are first counted by hashes alone. Segments that occur twice or more as a
whole are repeated throughout, and need no bytes to be moved. Of the others, those
whose suffix is shared with a different segment come to the suffix array: sampled
splitters range-partition them by their leading tokens, buckets sort them by
multikey quicksort, and runs of suffixes that share the leading tokens are searched
for the strings that stand in two segments. Neighbours are compared across the
border of two buckets, which moves on to where the leading tokens differ.

Where more different segments share their leading tokens than a bucket should hold
(a passage that a large part of all documents has), their strings are counted by
128-bit hashes instead, with partial counts before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.batches import by_slice
from meterflow.llm.common import key_columns, packed, whole, written

LENGTH = 400
GRAM = 16  # bytes whose hash ranks a place
TOKEN = 8  # bytes of a token of the sort
# Strings held against each other at a time, and segments of a bucket.
STRINGS, BUCKET_ROWS = 1 << 20, 4096
# Different segments with the same leading tokens that still go to one bucket.
CROWD = 20_000
_ODD = 0x9E3779B97F4A7C15


def reach(length: int) -> int:
    """Places of a string among which its anchor is chosen."""
    return (length * 5) // 8


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last): the anchors of a text's strings, with the first and last start that chose each.

    The anchor of the string at s is the place of the least hash among the first
    ``reach`` places, the leftmost of several.
    """
    n = len(data) - length + 1
    width = reach(length)
    with np.errstate(over="ignore"):
        h, size = data.astype(np.uint64) + np.uint64(1), 1
        while size < GRAM and width + 2 * size <= length + 1:
            h = h[: len(h) - size] * np.uint64(pow(_ODD, size, 1 << 64)) + h[size:]
            size *= 2
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    m = n + width - 1
    ranked = (h[:m] & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    # Least value of each window: of the rest of one block and the beginning of the next.
    padded = np.full(-(-m // width) * width, 2**64 - 1, np.uint64)
    padded[:m] = ranked
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    chosen = (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    return chosen[first], first, np.append(first[1:], n) - 1


def _segments(texts: DataFrame, length: int) -> DataFrame:
    """(k1, k2, first, last, anchor, suffix, segment) of (k1, k2, text) rows; the last two are hashes."""
    sure = length - reach(length) + 1

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        import xxhash

        hashed = xxhash.xxh3_64_intdigest
        rows, places, hashes = [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            raw = text.encode("utf-8", "replace")
            if len(raw) < length:
                continue
            at, first, last = anchors(np.frombuffer(raw, np.uint8), length)
            rows.append(np.full(len(at), i))
            places.append(np.stack([first, last, at]))
            for a, f, e in zip(at.tolist(), first.tolist(), last.tolist()):
                hashes.append(hashed(raw[a : a + sure]))
                hashes.append(hashed(raw[f : e + length], a - f + 1))
        if not rows:
            return None
        places = np.concatenate(places, axis=1).astype(np.int32)
        hashes = np.array(hashes, np.uint64).view(np.int64).reshape(-1, 2)
        rows = pa.array(np.concatenate(rows))
        return pa.RecordBatch.from_arrays(
            [batch.column(k).take(rows) for k in ("k1", "k2")]
            + [pa.array(p) for p in places]
            + [pa.array(hashes[:, i].copy()) for i in (0, 1)],
            names=["k1", "k2", "first", "last", "anchor", "suffix", "segment"],
        )

    return texts.mapInArrow(
        by_slice(cut), "k1 long, k2 long, first int, last int, anchor int, suffix long, segment long"
    )


def multikey_order(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings of ``depth`` bytes at ``starts``, and the class of each in that order.

    Multikey quicksort: all strings that agree so far are split by their next token,
    and only classes of two or more go on to the one after. ``data`` reaches
    ``depth`` bytes beyond every start.
    """
    order, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for at in range(0, depth, TOKEN):
        size = min(TOKEN, depth - at)
        active = np.flatnonzero(np.bincount(group, minlength=1)[group] > 1) if len(group) else group
        if not len(active):
            break
        token = np.zeros(len(active), np.uint64)
        places = starts[order[active]] + at
        for i in range(size):
            token = token << np.uint64(8) | data[places + i]
        # Classes are ranges of the order, so sorting by class and token keeps each in its place.
        by = np.lexsort((token, group[active]))
        order[active] = order[active][by]
        token = token[by]
        split = np.zeros(len(group), bool)
        split[active[1:]] = token[1:] != token[:-1]
        begins = np.concatenate([[False], group[1:] != group[:-1]])
        group = np.cumsum(split | begins)
    return order, group


def shared_strings(
    data: np.ndarray, first: np.ndarray, count: np.ndarray, anchor: np.ndarray, group: np.ndarray, length: int
) -> np.ndarray:
    """Which strings stand in two segments of a group.

    Segment i has ``count[i]`` strings, at ``first[i]`` and on, and its anchor at
    ``anchor[i]``. Equal strings lie equally far before the anchor.
    """
    with np.errstate(over="ignore"):
        n = len(data)
        value = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        value ^= value >> np.uint64(32)
        own = np.repeat(np.arange(len(first)), count)
        ends = np.cumsum(count)
        start = np.arange(ends[-1]) - np.repeat(ends - count, count) + first[own]
        marks = []
        for base in (_ODD, 0xC2B2AE3D27D4EB4F):
            power = np.cumprod(np.full(n + 1, base, np.uint64))
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(value * power[:n], out=sums[1:])
            # Brought to the same power: that of the end of the data.
            marks.append((sums[start + length] - sums[start]) * power[n - start])
        where = (anchor[own] - start).astype(np.uint64) | group[own].astype(np.uint64) << np.uint64(32)
        marks[0] = marks[0] + where * np.uint64(0x9FB21C651E98DF25)
    order = np.lexsort(marks)
    same = (marks[0][order[1:]] == marks[0][order[:-1]]) & (marks[1][order[1:]] == marks[1][order[:-1]])
    same &= where[order[1:]] == where[order[:-1]]
    found = np.zeros(len(start), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def _runs(found: np.ndarray, count: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(segment, from, to): runs of found strings of one segment, as starts in the text, both inclusive."""
    own = np.repeat(np.arange(len(count)), count)
    ends = np.cumsum(count)
    start = np.arange(len(found)) - np.repeat(ends - count, count) + first[own]
    at = np.flatnonzero(found)
    if not len(at):
        return
    breaks = np.flatnonzero((np.diff(at) > 1) | (np.diff(own[at]) > 0)) + 1
    for a, b in pairwise([0, *breaks.tolist(), len(at)]):
        yield int(own[at[a]]), int(start[at[a]]), int(start[at[b - 1]])


def _search(bucket: list[dict], sure: int, length: int) -> Iterator[tuple]:
    """Repeated strings of the segments of one bucket: (k1, k2, from, to) where only one text has the segment."""
    data = np.frombuffer(b"".join(s["bytes"] for s in bucket) + bytes(sure), np.uint8)
    sizes = np.array([len(s["bytes"]) for s in bucket])
    base = np.cumsum(sizes) - sizes
    anchor = base + np.array([s["anchor"] - s["first"] for s in bucket])
    order, group = multikey_order(data, anchor, sure)
    ranked = np.zeros(len(bucket), np.int64)
    ranked[order] = group
    runs = np.bincount(ranked)
    count = np.array([s["last"] - s["first"] + 1 for s in bucket])
    order = order[runs[group] > 1]
    # Runs go on together as long as their strings fit; a run is never cut but by distance from the anchor.
    at = 0
    while at < len(order):
        to, total = at, 0
        while to < len(order):
            end = to
            while end < len(order) and ranked[order[end]] == ranked[order[to]]:
                end += 1
            more = int(count[order[to:end]].sum())
            if to > at and total + more > STRINGS:
                break
            to, total = end, total + more
        chosen = order[at:to]
        at = to
        bands = -(-total // STRINGS)
        step = -(-reach(length) // bands)
        back = anchor[chosen] - base[chosen]
        for band in range(bands):
            # Strings that begin from band * step to (band + 1) * step - 1 bytes before the anchor.
            high = np.minimum(back, (band + 1) * step - 1)
            low = np.maximum(back - count[chosen] + 1, band * step)
            some = np.flatnonzero(high >= low)
            if not len(some):
                continue
            part, number = chosen[some], high[some] - low[some] + 1
            begin = anchor[part] - high[some]
            found = shared_strings(data, begin, number, anchor[part], ranked[part], length)
            for i, a, b in _runs(found, number, begin):
                s = bucket[part[i]]
                if s["n"] == 1:
                    shift = s["first"] - int(base[part[i]])
                    yield s["k1"], s["k2"], a + shift, b + shift


def _repeated(segments: DataFrame, texts: DataFrame, length: int, crowd: int) -> DataFrame:
    """(k1, k2, from, to): starts of strings that occur elsewhere too, in runs, both inclusive."""
    spark = segments.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sure = length - reach(length) + 1
    counted = segments.groupBy("suffix", "segment").agg(
        F.count("*").alias("n"),
        F.min(F.struct("k1", "k2", "first", "last", "anchor")).alias("at"),
    )
    counted = written(counted, "segments-counted")
    often = counted.filter("n > 1").select("suffix", "segment")
    throughout = segments.join(often, ["suffix", "segment"], "left_semi").select(
        "k1", "k2", F.col("first").alias("from"), F.col("last").alias("to")
    )
    several = counted.groupBy("suffix").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    asked = counted.join(several, "suffix").select("at.*", "n", (F.col("kinds") > crowd).alias("crowded"))
    cuts = F.collect_list(F.struct("first", "last", "anchor", "n", "crowded"))
    wanted = asked.groupBy("k1", "k2").agg(cuts.alias("cuts"))
    # One row per text: a text's copies are one, before the shuffle already.
    bodies = texts.groupBy("k1", "k2").agg(F.first("text").alias("text")).join(wanted, ["k1", "k2"])

    def slice_out(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("k1", "k2", "text", "cuts")]
        for k1, k2, text, cuts in zip(*columns):
            raw = text.encode("utf-8", "replace")
            for c in cuts:
                body = raw[c["first"] : c["last"] + length]
                lead = raw[c["anchor"] : c["anchor"] + sure]
                out.append((k1, k2, c["first"], c["last"], c["anchor"], c["n"], lead, body, c["crowded"]))
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in out], schema=schema) if out else None

    schema = pa.schema(
        [("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("anchor", pa.int32())]
        + [("n", pa.int64()), ("lead", pa.binary()), ("bytes", pa.binary()), ("crowded", pa.bool_())]
    )
    shape = "k1 long, k2 long, first int, last int, anchor int, n long, lead binary, bytes binary, crowded boolean"
    loose = written(bodies.mapInArrow(by_slice(slice_out), shape), "segments-cut")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                # A bucket ends where the leading tokens change, so that no run lies in two.
                if len(bucket) >= BUCKET_ROWS and row["lead"] != bucket[-1]["lead"]:
                    yield from listed(bucket)
                    bucket = []
                bucket.append(row)
        if bucket:
            yield from listed(bucket)

    def listed(bucket: list[dict]) -> Iterator[pa.RecordBatch]:
        rows = list(_search(bucket, sure, length))
        if rows:
            k1, k2, a, b = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1), pa.array(k2), pa.array(a, pa.int32()), pa.array(b, pa.int32())],
                names=["k1", "k2", "from", "to"],
            )

    buckets = loose.filter("not crowded").repartitionByRange(n, "lead").sortWithinPartitions("lead")
    partly = buckets.mapInArrow(search, "k1 long, k2 long, from int, to int")
    found = throughout.unionByName(partly)
    if several.filter(F.col("kinds") > crowd).isEmpty():
        return found
    strings = loose.filter("crowded").mapInArrow(_strings(length), "k1 long, k2 long, from int, n long, s1 long, s2 long")
    strings = written(strings, "strings")
    twice = strings.groupBy("s1", "s2").agg(F.count("*").alias("times")).filter("times > 1").select("s1", "s2")
    counted_ones = strings.filter("n = 1").join(twice, ["s1", "s2"], "left_semi")
    return found.unionByName(counted_ones.select("k1", "k2", "from", F.col("from").alias("to")))


def _strings(length: int):
    """Function for mapInArrow: a row with a 128-bit hash for each string of a segment."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for s in batch.to_pylist():
                starts = range(s["last"] - s["first"] + 1)
                marks = b"".join([xxhash.xxh3_128_digest(s["bytes"][i : i + length]) for i in starts])
                marks = np.frombuffer(marks, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([s["k1"]] * len(starts), pa.int64()),
                        pa.array([s["k2"]] * len(starts), pa.int64()),
                        pa.array(range(s["first"], s["last"] + 1), pa.int32()),
                        pa.array([s["n"]] * len(starts), pa.int64()),
                        pa.array(marks[:, 0].copy()),
                        pa.array(marks[:, 1].copy()),
                    ],
                    names=["k1", "k2", "from", "n", "s1", "s2"],
                )

    return run


def remove_repeats(
    documents: DataFrame, keep: list[str] | None = None, length: int = LENGTH, crowd: int = CROWD
) -> DataFrame:
    """``row`` (the kept columns, all by default), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes).

    Every byte of a text's UTF-8 that is covered by a string of ``length`` bytes that
    also starts anywhere else, in the same document or another, is removed.
    Strings lie within one document and are judged on the input. A null text is empty.
    ``n_spans`` counts maximal removed runs. Rows with the same text repeat
    each other, whatever their ids; an empty table gives no rows. The bytes left may
    be no valid UTF-8, so ``kept`` is binary.
    """
    text = whole(F.col("text"))
    texts = documents.select(*key_columns(text), text.alias("text"))
    segments = written(_segments(texts, length), "segments")
    spans = _repeated(segments, texts, length, crowd)
    # Overlapping and touching strings become spans, text by text.
    spans = spans.select("k1", "k2", "from", (F.col("to") + length).alias("end")).distinct()
    before = Window.partitionBy("k1", "k2").orderBy("from", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("new", F.coalesce(F.col("from") > F.max("end").over(before), F.lit(True)).cast("int"))
    spans = spans.withColumn("span", F.sum("new").over(Window.partitionBy("k1", "k2").orderBy("from", "end")))
    spans = spans.groupBy("k1", "k2", "span").agg(F.min("from").alias("from"), F.max("end").alias("end"))
    removed = spans.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("from", "end"))).alias("spans"))
    # Written, so that the rows of a text with very many copies can be split between tasks.
    removed = written(removed, "spans")
    rows = documents.select(
        packed(documents, keep),
        *key_columns(text),
        text.alias("text"),
    )
    joined = rows.join(removed, ["k1", "k2"], "left")
    raw = F.col("text").cast("binary")
    none = F.array().cast("array<struct<from:int,end:int>>")
    joined = joined.select("row", raw.alias("raw"), F.coalesce("spans", none).alias("spans"))
    # What is left stands between the end of one span and the beginning of the next.
    begins = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["from"]), F.array(F.octet_length("raw")))
    pieces = F.zip_with(begins, ends, lambda a, b: F.hex(F.substring(F.col("raw"), a + 1, b - a)))
    return joined.select(
        "row",
        F.octet_length("raw").cast("long").alias("n_bytes"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + (s["end"] - s["from"])).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.when(F.size("spans") == 0, F.col("raw")).otherwise(F.unhex(F.array_join(pieces, ""))).alias("kept"),
    )
