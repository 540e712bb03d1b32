"""Ranked lexical search without random access: impact-sorted lists, read until every score is settled.

Spark counts terms, weighs them and deals the documents' postings out to shards of bounded
size. A shard's lists are read from their highest impacts on for one item after the other;
each document has a lower and an upper score until nothing that is still open can matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.batches import by_slice
from meterflow.llm.common import whole, written

BEST = 50
# Postings of a shard, and terms of items that meet it in one task, at most about so many.
SHARD_POSTINGS = 2_000_000
BLOCK_TERMS = 1_000_000
# A table of so many terms, of KEPT_BYTES together, is sent to all executors; a larger one is joined by shuffling.
SENT_TERMS, SENT_BYTES = 100_000, 4 << 20
# Places of each list read in the first turn; every turn doubles what has been read.
FIRST_READ = 128

# Bytes of terms: ASCII letters and digits, and all bytes of characters beyond ASCII. A-Z are lower-cased.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLDED).split()


def _lengths(batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes = [len(terms_of(t)) for t in batch.column("text").to_pylist()]
    return pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n"])


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row per document and different term."""
    at, terms, counts, sizes = [], [], [], []
    for i, text in enumerate(batch.column("text").to_pylist()):
        found = terms_of(text)
        held = Counter(found)
        at.extend([i] * len(held))
        terms.extend(held.keys())
        counts.extend(held.values())
        sizes.extend([len(found)] * len(held))
    rows = pa.array(at, pa.int64())
    rest = [batch.column(i).take(rows) for i in range(batch.num_columns) if batch.schema.names[i] != "text"]
    names = [n for n in batch.schema.names if n != "text"]
    extra = [pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays([*rest, *extra], [*names, "n", "term", "tf"])


def _text(column: str) -> Column:
    return whole(F.col(f"`{column}`").cast("string")).cast("binary").alias("text")


def _sent(small: DataFrame, count: int, size: int) -> DataFrame:
    """The hint to broadcast, where count and bytes of the terms prove the table small."""
    return F.broadcast(small) if count <= SENT_TERMS and size <= SENT_BYTES else small


# --------------------------------------------------------------------------
# one shard


def settled(lists: list[tuple[np.ndarray, np.ndarray]], size: int, best: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents 0 .. size - 1 that can be among the ``best`` (all that tie with the last) and their exact scores.

    Each list holds different documents and their impacts, highest first. Only the next
    places of a list are ever read. What is known of a document is the sum of its impacts
    read; what it can still get is, for each list it wasn't met in, the last impact read
    there. Reading goes on while a document that may belong is not settled, in the lists
    it wasn't met in.
    """
    lower = np.zeros(size, dtype=np.int64)
    reads = [0] * len(lists)
    wanted = [True] * len(lists)
    depth = FIRST_READ
    while True:
        for t, (docs, impacts) in enumerate(lists):
            if wanted[t]:
                upto = min(depth, len(docs))
                lower[docs[reads[t] : upto]] += impacts[reads[t] : upto]
                reads[t] = upto
        # The most that a document not met in a list yet can get from it.
        ahead = [int(impacts[r - 1]) if r < len(impacts) else 0 for r, (_, impacts) in zip(reads, lists)]
        upper = lower + sum(ahead)
        for t, (docs, _) in enumerate(lists):
            if ahead[t]:
                upper[docs[: reads[t]]] -= ahead[t]
        least = max(1, int(np.partition(lower, size - best)[size - best])) if size > best else 1
        unsure = (upper >= least) & (upper > lower)
        if not unsure.any():
            found = np.nonzero(lower >= least)[0]
            return found, lower[found]
        n_unsure = int(unsure.sum())
        wanted = [a > 0 and int(unsure[docs[:r]].sum()) < n_unsure for a, r, (docs, _) in zip(ahead, reads, lists)]
        depth *= 2


def _best_of_shard(best: int):
    def run(postings: pa.Table, asked: pa.Table) -> pa.Table:
        items, ids, scores = [np.empty(0, np.int64)], [pa.array([], pa.int64())], [np.empty(0, np.int64)]
        if postings.num_rows and asked.num_rows:
            docs, first, at = np.unique(postings.column("doc").to_numpy(), return_index=True, return_inverse=True)
            did = postings.column("did").combine_chunks().take(pa.array(first))
            # Among equal scores smaller ids come first, missing ones last.
            missing, known = did.is_null().to_numpy(zero_copy_only=False), did.fill_null(0).to_numpy()
            terms, impacts = postings.column("term_no").to_numpy(), postings.column("impact").to_numpy()
            order = np.lexsort((at, -impacts, terms))
            terms, impacts, at = terms[order], impacts[order], at[order]
            numbers, begin = np.unique(terms, return_index=True)
            spans = {int(t): (int(a), int(z)) for t, a, z in zip(numbers, begin, [*begin[1:], len(terms)])}
            item, wanted = asked.column("item_no").to_numpy(), asked.column("term_no").to_numpy()
            by_item = np.argsort(item, kind="stable")
            item, wanted = item[by_item], wanted[by_item]
            for part in np.split(np.arange(len(item)), np.nonzero(np.diff(item))[0] + 1):
                lists = [(at[a:z], impacts[a:z]) for a, z in (spans.get(int(t), (0, 0)) for t in wanted[part]) if z > a]
                if not lists:
                    continue
                found, score = settled(lists, len(docs), best)
                found_first = np.lexsort((known[found], missing[found], -score))[:best]
                items.append(np.full(len(found_first), item[part[0]]))
                ids.append(did.take(pa.array(found[found_first])))
                scores.append(score[found_first])
        return pa.table(
            {
                "item_no": pa.array(np.concatenate(items), pa.int64()),
                "did": pa.chunked_array(ids).combine_chunks(),
                "score": pa.array(np.concatenate(scores), pa.int64()),
            }
        )

    return run


# --------------------------------------------------------------------------
# all of it


def _item_terms(items: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Written: the different items with numbers; the different terms of each."""
    named = items.select(F.col(f"`{key}`").alias("item"), _text(text))
    numbered = written(named.select("item").distinct().withColumn("item_no", F.monotonically_increasing_id()), "items")
    joined = named.join(numbered, named["item"].eqNullSafe(numbered["item"])).select("item_no", "text")
    terms = joined.mapInArrow(by_slice(_counted), "item_no long, n long, term binary, tf long")
    return numbered, written(terms.select("item_no", "term").distinct(), "item-terms")


def rank_documents(
    documents: DataFrame,
    items: DataFrame,
    best: int = BEST,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    shard_postings: int = SHARD_POSTINGS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item``, ``rank``, ``doc``, ``score``: the ``best`` documents of each item, scores above 0 only.

    A document's score sums w * ((1000000000 tf) div (1000 tf + 20 m)) over the item's different terms,
    w = floor(1000 ln((2 N + 2) / (2 df + 1))), m = 100 - 50 + ((50 n N) div L), n its terms with repeats,
    N the documents that have a term, L all their terms; equal scores go by ascending key, rows
    without a key last. A null text has no terms. Every row of ``documents`` is a document of its
    own, also where rows or keys repeat. Rows of ``items`` with one key, null included, are one item with the terms of
    all of them. An item without a known term gets no rows; nor do empty tables give any. All other columns
    are left alone.
    """
    numbered, item_terms = _item_terms(items, item_text, item_key)
    terms = written(
        item_terms.select("term").distinct().withColumn("term_no", F.monotonically_increasing_id()), "terms"
    )
    n_terms, term_bytes, n_wanted = (
        terms.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first() + (item_terms.count(),)
    )
    wanted = item_terms.join(_sent(terms, n_terms, term_bytes), "term").select("item_no", "term_no")
    # A row keeps its number when its task is run again: the scan deals rows out the same way.
    docs = documents.select(
        F.monotonically_increasing_id().alias("doc"), F.col(f"`{key}`").cast("long").alias("did"), _text(text)
    )
    sizes = documents.select(_text(text)).mapInArrow(by_slice(_lengths), "n long").filter("n > 0")
    n_docs, n_all = sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counted = docs.mapInArrow(by_slice(_counted), "doc long, did long, n long, term binary, tf long")
    postings = written(counted.join(_sent(terms, n_terms, term_bytes), "term").drop("term"), "postings")
    ratio = F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)
    weights = written(
        postings.groupBy("term_no")
        .agg(F.count("*").alias("df"))
        .select("term_no", "df", F.floor(1000 * F.log(ratio)).alias("w")),
        "weights",
    )
    total, known = weights.agg(F.coalesce(F.sum("df"), F.lit(0)), F.count("*")).first()
    shards = max(1, -(-total // shard_postings))
    blocks = max(1, -(-n_wanted // block_terms))
    medium = F.expr(f"100 - 50 + ((50 * n * {n_docs}L) div {max(1, n_all)}L)")
    weighed = postings.join(_sent(weights, known, 0), "term_no").withColumn("m", medium)
    impacts = weighed.select(
        "doc", "did", "term_no", F.expr("w * ((1000000000 * tf) div (1000 * tf + 20 * m))").alias("impact")
    ).filter("impact > 0")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    lists = impacts.withColumn("shard", place("doc", shards)).withColumn("block", every(blocks))
    asked = wanted.withColumn("block", place("item_no", blocks)).withColumn("shard", every(shards))
    found = (
        lists.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInArrow(_best_of_shard(best), "item_no long, did long, score long")
    )
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("did"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.join(numbered, "item_no").select("item", "rank", F.col("did").alias("doc"), "score")
