"""Near-duplicate join on word shingles by an LSH forest of MinHash signatures.

Each tree of the forest is a sorted list of signatures, which is a trie read in
order: neighbours in it share a prefix, and one walk notes how long it is. Matching
starts at the full depth. What matches there forms candidate groups; from the
agreement of the signatures that met, a group's expected recall at this depth is
worked out. Groups that reach the target are settled. The prefixes of the others, and
of texts that have met none, are shortened by one value, and so on until none is
left; a settled group is still a partner for those that go on. Inside a group all pairs
of texts are verified exactly, in blocks, without emitting them: a text gets its
number of links, a block the links that span it.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.batches import by_slice
from meterflow.llm.common import packed, whole, written
from meterflow.llm.components import components

log = logging.getLogger(__name__)

WORDS, SIMILARITY = 5, 0.8
TREES, DEPTH, RECALL = 18, 5, 0.9999
# Texts and bytes of one block of a candidate group.
BLOCK_TEXTS, BLOCK_BYTES = 512, 4 << 20
SLAB = 8192
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_ODD = 0x9E3779B97F4A7C15


def found_share(similarity: float | np.ndarray, trees: int, level: int) -> float | np.ndarray:
    """Probability that a pair of this similarity shares ``level`` values in one of the trees."""
    return 1 - (1 - similarity**level) ** trees


def last_level(similarity: float, trees: int, depth: int, recall: float) -> int:
    """Longest prefix at which even texts that met nothing reach the target, by what a pair at the threshold has."""
    while depth > 1 and found_share(similarity, trees, depth) < recall:
        depth -= 1
    return depth


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of the word shingles of texts, many texts at a time."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) <= n:
            base, back = _ODD, pow(_ODD, -1, 1 << 64)
            with np.errstate(over="ignore"):
                self.powers = np.cumprod(np.full(n + 1, base, np.uint64))
                self.inverse = np.cumprod(np.full(n + 1, back, np.uint64))

    def shingles(self, texts: list[bytes]) -> list[np.ndarray]:
        """Hashes per text, in order and with repeats; texts of fewer words have one shingle of all, empty ones none."""
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self._reach(len(data))
        inside = ~_BLANK[data]
        edge = np.diff(np.concatenate([[0], inside.view(np.int8)]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
            word = (sums[ends] - sums[starts]) * self.inverse[starts]
            word = _mixed(word + (ends - starts).astype(np.uint64) * np.uint64(_ODD))
            bounds = np.cumsum([len(t) + 1 for t in texts])
            last = np.searchsorted(starts, bounds)
            first = np.concatenate([[0], last[:-1]])
            rolled = np.zeros(max(0, len(word) - self.words + 1), np.uint64)
            for i in range(self.words):
                rolled = _mixed(rolled * np.uint64(_ODD) + word[i : i + len(rolled)])
            out = []
            for a, b in zip(first.tolist(), last.tolist()):
                if b - a >= self.words:
                    out.append(rolled[a : b - self.words + 1])
                elif b > a:
                    one = np.zeros(1, np.uint64)
                    for x in word[a:b]:
                        one = _mixed(one * np.uint64(_ODD) + x)
                    out.append(_mixed(one + np.uint64(b - a)))
                else:
                    out.append(np.empty(0, np.uint64))
        return out


def signature(shingles: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """MinHash values as a (trees, depth) array of big-endian 32-bit integers."""
    draw = np.random.Generator(np.random.PCG64(20240229))
    a = draw.integers(1, 2**63, (trees * depth, 1), np.uint64) * np.uint64(2) + np.uint64(1)
    b = draw.integers(0, 2**63, (trees * depth, 1), np.uint64)
    least = np.full(trees * depth, 2**64 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 1024):
            least = np.minimum(least, (shingles[at : at + 1024] * a + b).min(axis=1))
    return (least >> np.uint64(32)).astype(">u4").reshape(trees, depth)


_SHINGLERS: dict[int, Shingler] = {}


def shingler(words: int) -> Shingler:
    return _SHINGLERS.setdefault(words, Shingler(words))


def _signed(texts: DataFrame, words: int, trees: int, depth: int) -> DataFrame:
    """(tid, did, n_bytes, signature) of (tid, did, text) rows; the signature of a text without words is empty."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = [t.encode("utf-8", "replace") for t in batch.column("text").to_pylist()]
        found = [signature(s, trees, depth).tobytes() if len(s) else b"" for s in shingler(words).shingles(raw)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("tid"),
                batch.column("did"),
                pa.array(map(len, raw), pa.int64()),
                pa.array(found, pa.binary()),
            ],
            names=["tid", "did", "n_bytes", "signature"],
        )

    return texts.mapInArrow(by_slice(sign), "tid string, did long, n_bytes long, signature binary")


def _matches(signed: DataFrame, trees: int, depth: int, least: int) -> DataFrame:
    """Links (a, b, level) between neighbours of each tree, with the values they share, ``least`` or more.

    The trees are range-partitioned by sampled splitters and sorted; what stands at
    the ends of the partitions is compared in a second, small step.
    """
    spark = signed.sparkSession
    width = 4 * depth
    rows = signed.filter(F.length("signature") > 0).select(
        "tid",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.lit(trees - 1)),
                lambda t: F.concat(
                    F.unhex(F.lpad(F.hex(t), 2, "0")),
                    F.substring(F.col("signature"), t * width + 1, F.lit(width)),
                ),
            )
        ).alias("leaf"),
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "leaf", "tid").sortWithinPartitions("leaf", "tid")
    levels = range(depth, least - 1, -1)

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[bytes, str] | None = None
        for batch in batches:
            out = []
            for leaf, tid in zip(batch.column("leaf").to_pylist(), batch.column("tid").to_pylist()):
                if before is None:
                    out.append((tid, None, None, leaf))
                elif tid != before[1] and leaf[: 1 + 4 * least] == before[0][: 1 + 4 * least]:
                    shared = next(k for k in levels if leaf[: 1 + 4 * k] == before[0][: 1 + 4 * k])
                    out.append((tid, before[1], shared, None))
                before = leaf, tid
            yield links_of(out)
        if before is not None:
            yield links_of([(before[1], None, None, before[0])])

    def links_of(rows: list[tuple]) -> pa.RecordBatch:
        a, b, level, leaf = zip(*rows) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(level, pa.int32()), pa.array(leaf, pa.binary())],
            names=["a", "b", "level", "leaf"],
        )

    found = written(ordered.mapInArrow(walk, "a string, b string, level int, leaf binary"), "forest")
    # Two rows a partition, in the order of the trees: those of one prefix belong together.
    ends = found.filter("b is null").select("a", "leaf", F.explode(F.lit(list(levels))).alias("level"))
    ends = ends.select("a", "level", F.substring("leaf", F.lit(1), 1 + 4 * F.col("level")).alias("prefix"))
    heads = ends.groupBy("level", "prefix").agg(F.min("a").alias("b"))
    return (
        found.filter("b is not null")
        .select("a", "b", "level")
        .unionByName(ends.join(heads, ["level", "prefix"]).select("a", "b", "level"))
        .filter("a != b")
    )


def _expected(met: DataFrame, distinct: DataFrame, trees: int, level: int, similarity: float) -> DataFrame:
    """(root, n_met, n_expected) per group of the links (a, b, root) that met at ``level``.

    The similarity of a link is the share of values in which its signatures agree;
    a link of similarity s that met stands for 1 / found_share(s) such links. Links
    below the threshold are none, and not counted.
    """
    signatures = distinct.select("tid", "signature")
    pairs = met.join(signatures.withColumnsRenamed({"tid": "a", "signature": "left"}), "a").join(
        signatures.withColumnsRenamed({"tid": "b", "signature": "right"}), "b"
    )

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u4").reshape(batch.num_rows, -1)
                for c in ("left", "right")
            )
            share = (left == right).mean(axis=1) if batch.num_rows else np.empty(0)
            true = share >= similarity
            weight = np.where(true, 1 / found_share(np.maximum(share, similarity), trees, level), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("root"), pa.array(true.astype(np.int64)), pa.array(weight)],
                names=["root", "n_met", "n_expected"],
            )

    weighed = pairs.select("root", "left", "right").mapInArrow(weigh, "root string, n_met long, n_expected double")
    return weighed.groupBy("root").agg(F.sum("n_met").alias("n_met"), F.sum("n_expected").alias("n_expected"))


def _groups(distinct: DataFrame, trees: int, depth: int, similarity: float, recall: float) -> DataFrame:
    """(node, root): the candidate group of each text that met another, by prefixes shortened level by level."""
    last = last_level(similarity, trees, depth, recall)
    links = written(_matches(distinct, trees, depth, last).distinct(), "matches")
    groups = written(components(links.filter(F.col("level") == depth).select("a", "b")), "groups")
    for level in range(depth, last, -1):
        rooted = groups.withColumnRenamed("node", "a")
        met = links.filter(F.col("level") >= level).select("a", "b").distinct().join(rooted, "a")
        rated = written(
            _expected(met, distinct, trees, level, similarity).withColumn(
                "settled", F.expr(f"n_met > 0 and n_met >= {recall}D * n_expected")
            ),
            "recall",
        )
        one = rated.agg(
            F.count("*").alias("n"), F.sum(F.col("settled").cast("long")).alias("settled"), F.sum("n_met").alias("met"),
            F.sum("n_expected").alias("expected"),
        ).first()
        log.info("level %d: %d groups, %s settled, %s links met of %s expected", level, *one)
        named = groups.join(rated.select("root", "settled"), "root", "left")
        shorter = links.filter(F.col("level") == level - 1).select("a", "b")
        for end in ("a", "b"):
            side = named.select(
                F.col("node").alias(end), F.col("root").alias(f"root_{end}"), F.col("settled").alias(f"settled_{end}")
            )
            shorter = shorter.join(side, end, "left")
        opened = shorter.filter("not coalesce(settled_a, false) or not coalesce(settled_b, false)").select(
            F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")
        )
        merged = written(components(opened), "merged")
        into = merged.select(F.col("node").alias("root"), F.col("root").alias("into"))
        moved = groups.join(into, "root", "left").select("node", F.coalesce("into", "root").alias("root"))
        groups = written(moved.unionByName(merged.join(groups, "node", "left_anti").select("node", "root")), "groups")
    return groups


class _Roots:
    def __init__(self, n: int):
        self.root = list(range(n))

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = x = self.root[self.root[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.root[max(x, y)] = min(x, y)
        return x != y


def verified(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Matrix of which sets have at least this Jaccard similarity."""
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    flat, ids = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.repeat(np.arange(n), sizes)
    common = np.zeros((n, n), np.float64)
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    for at in range(0, len(flat), SLAB):
        lo, hi = np.searchsorted(ids, [at, at + SLAB])
        slab = np.zeros((n, min(SLAB, len(flat) - at)), np.float32)
        slab[rows[lo:hi], ids[lo:hi] - at] = 1
        common += slab @ slab.T
    union = sizes[:, None] + sizes[None, :] - common
    return common >= similarity * union - 1e-9


def _verify(members: DataFrame, words: int, similarity: float) -> DataFrame:
    """Rows (a, null, n): a text's links inside a pair of blocks; rows (a, b, 0): links that span it.

    ``members`` holds (root, left, right, block, tid, text): the two blocks of a pair.
    """
    spark = members.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = ["root", "left", "right"]
    dealt = members.repartition(n, *place).sortWithinPartitions(*place)

    def check(group: list[tuple]) -> Iterator[tuple]:
        left, right = group[0][1], group[0][2]
        blocks, tids = np.array([m[3] for m in group]), [m[4] for m in group]
        sets = [np.unique(s) for s in shingler(words).shingles([m[5].encode("utf-8", "replace") for m in group])]
        near = verified(sets, similarity)
        if left == right:
            np.fill_diagonal(near, False)
        else:
            near &= blocks[:, None] != blocks[None, :]
        roots = _Roots(len(group))
        for i, count in enumerate(near.sum(axis=1).tolist()):
            if count:
                yield tids[i], None, count
        for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(near)))):
            if roots.join(i, j):
                yield tids[i], tids[j], 0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            a, b, n = zip(*out)
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(n, pa.int64())], names=["a", "b", "n"]
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[:3] != group[0][:3]:
                    out.extend(check(group))
                    group = []
                    if len(out) > 10_000:
                        yield flushed()
                group.append(row)
        if group:
            out.extend(check(group))
        if out:
            yield flushed()

    return dealt.mapInArrow(run, "a string, b string, n long")


def join_near(
    documents: DataFrame,
    keep: list[str] | None = None,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
) -> DataFrame:
    """``row`` (the kept columns, all by default), ``root``, ``class_id``, ``n_links``, ``n_copies``.

    Two texts are linked if the sets of their shingles of ``words`` blank-separated
    words have a Jaccard similarity of ``similarity`` or more; a text of fewer words
    is one shingle. ``n_links`` counts the different texts linked to a document's,
    ``n_copies`` the rows with the very same text, itself included. A class is a
    connected component of links and copies, ``root`` names it, ``class_id`` is its
    smallest ``doc_id`` (null if it has none). A null text is empty; texts without a
    word have no links, and equal ones are copies. A link at the threshold is found
    with probability ``recall`` at least, each found one is verified exactly. An
    empty table gives no rows.
    """
    text = whole(F.col("text"))
    texts = documents.select(F.md5(text).alias("tid"), F.col("doc_id").cast("long").alias("did"), text.alias("text"))
    signed = written(_signed(texts, words, trees, depth), "signatures")
    distinct = signed.groupBy("tid").agg(
        F.min("did").alias("did"),
        F.count("*").alias("n_copies"),
        F.max("n_bytes").alias("n_bytes"),
        F.first("signature").alias("signature"),
    )
    distinct = written(distinct, "texts")
    groups = _groups(distinct, trees, depth, similarity, recall)
    sizes = groups.join(distinct.select(F.col("tid").alias("node"), "n_bytes"), "node").groupBy("root").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("n_bytes") / BLOCK_BYTES)
        ).cast("int").alias("blocks")
    )
    placed = groups.join(sizes, "root").select(
        F.col("node").alias("tid"), "root", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    )
    bodies = texts.groupBy("tid").agg(F.first("text").alias("text"))
    members = placed.join(bodies, "tid").select(
        "root", "tid", "block", "text", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    members = members.select(
        "root",
        F.least("block", "other").alias("left"),
        F.greatest("block", "other").alias("right"),
        "block",
        "tid",
        "text",
    )
    found = written(_verify(members, words, similarity), "verified")
    counts = found.filter("b is null").groupBy(F.col("a").alias("tid")).agg(F.sum("n").alias("n_links"))
    roots = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "tid")
    known = (
        distinct.select("tid", "did", "n_copies")
        .join(roots, "tid", "left")
        .join(counts, "tid", "left")
        .withColumn("root", F.coalesce("root", "tid"))
    )
    classes = known.groupBy("root").agg(F.min("did").alias("class_id"))
    known = known.join(classes, "root").select(
        "tid", "root", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies"
    )
    rows = documents.select(
        packed(documents, keep), F.md5(text).alias("tid")
    )
    return rows.join(known, "tid", "left").drop("tid")
