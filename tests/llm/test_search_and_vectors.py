"""Ranked search, whitening and the neighbour graph against brute force, and on awkward tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.llm import pruned_graph, queries, ranked_search, whitening
from tests.llm.helpers import DOCUMENTS, awkward_documents, with_clashes
from tests.llm.test_operators import shared  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
VECTORS = "vec_id long, embedding array<float>, label int"


def folded(text):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return TERM.findall((text or "").translate(str.maketrans(upper, upper.lower())))


def ranked_plainly(documents, items, best):
    """(item, rank, doc, score) straight from the definition."""
    docs = [(i, Counter(folded(t)), len(folded(t))) for i, t in documents]
    n_docs, n_all = sum(n > 0 for _, _, n in docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item].update(folded(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc, counts, n in docs:
            m = 100 - 50 + (50 * n * n_docs) // max(1, n_all)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 20 * m))
                for t in terms & counts.keys()
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:best])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --------------------------------------------------------------------------
# ranked search


@pytest.mark.parametrize("shard_postings, block_terms", [(10**6, 10**6), (300, 7)])
def test_ranking_equals_brute_force(spark, shared, shard_postings, block_terms):  # noqa: F811
    draw = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    documents = [(i, " ".join(draw.choices(words, weights, k=draw.randint(0, 40)))) for i in range(400)]
    documents += [(i + 400, documents[7][1]) for i in range(150)]  # ties beyond the cut
    items = [(i, " ".join(draw.choices(words, k=draw.randint(1, 9)))) for i in range(12)]
    docs = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = ranked_search.rank_documents(
        docs, asked, best=20, shard_postings=shard_postings, block_terms=block_terms
    )
    assert rows_of(got) == ranked_plainly(documents, items, 20)


def test_ranking_on_awkward_tables(spark, shared):  # noqa: F811
    documents = awkward_documents(spark, (8, "Café CAFÉ plain\x00words", "fr", "a", 3), (None, "plain", "en", "b", 5))
    items = spark.createDataFrame(
        [(1, "Plain words"), (1, "café"), (1, "Plain words"), (None, "naïve"), (2, None), (3, ""), (4, "漢字 word5")],
        "item_id long, text string",
    )
    plain = ranked_plainly(
        [(r.doc_id, r.text) for r in documents.collect()], [tuple(r) for r in items.collect()], 50
    )
    got = ranked_search.rank_documents(with_clashes(documents), with_clashes(items))
    assert rows_of(got) == plain
    assert {r[0] for r in plain} == {1, None, 4}
    assert ranked_search.rank_documents(documents.limit(0), items).count() == 0
    assert ranked_search.rank_documents(documents, items.limit(0)).count() == 0


def test_terms_join_without_broadcast(spark, shared, monkeypatch):  # noqa: F811
    monkeypatch.setattr(ranked_search, "SENT_TERMS", 0)
    documents = [(i, f"common rare{i % 7} word{i % 3}") for i in range(40)]
    items = [(0, "common rare3"), (1, "word1 rare3 rare5")]
    got = ranked_search.rank_documents(
        spark.createDataFrame(documents, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert rows_of(got) == ranked_plainly(documents, items, 50)


def test_reading_stops_before_the_end_of_the_lists():
    """A long list whose rest can't change the best documents is not read to its end."""
    size = 100_000
    short = (np.arange(60), np.full(60, 10**6))
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice) and key.stop is not None:
                read.append(key.stop)
            return super().__getitem__(key)

    long = (np.arange(size).view(Watched), np.sort(np.arange(1, size + 1))[::-1].copy())
    found, scores = ranked_search.settled([short, long], size, 50)
    want = np.zeros(size, dtype=np.int64)
    want[:60] += 10**6
    want += np.arange(size, 0, -1)
    best = np.argsort(-want, kind="stable")[:50]
    kept = np.lexsort((found, -scores))[:50]
    assert list(found[kept]) == list(best) and list(scores[kept]) == list(want[best])
    assert max(read) <= 1024


# --------------------------------------------------------------------------
# whitening


def embeddings(spark, rows):
    return spark.createDataFrame(rows, VECTORS)


def test_whitening_equals_plain_numbers(spark, shared, sf_dir):  # noqa: F811
    rows = queries.QUERIES["op12_whitening"](spark, sf_dir).collect()
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    x = {r.vec_id: [math.floor(1024 * c) + 100000 for c in r.embedding] for r in given}
    n, dims = len(x), len(given[0].embedding)
    sums = [sum(v[j] for v in x.values()) for j in range(dims)]
    off = {i: [n * c - s for c, s in zip(v, sums)] for i, v in x.items()}
    v = np.array([[float(c) / n for c in o] for o in off.values()])
    values, vectors = np.linalg.eigh(v.T @ v / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    got = defaultdict(dict)
    for r in rows:
        assert r.n == n and r.deviation == sum(c * c for c in off[r.vec_id])
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
        assert r.identity_error < 1e-9
        got[r.component][r.vec_id] = r.whitened
    assert sorted(got) == list(range(1, 9)) and all(len(g) == n for g in got.values())
    for k, g in got.items():
        plain = v @ vectors[:, k - 1] / math.sqrt(values[k - 1])
        mine = np.array([g[i] for i in off])
        assert min(np.abs(mine - plain).max(), np.abs(mine + plain).max()) < 1e-9


@pytest.mark.parametrize(
    "values",
    [
        [5, 3, 2, 1, 0.5],
        [1 + 3e-9, 1 + 2e-9, 1 + 1e-9, 1, 0.25],  # float32 can't tell the first four apart
        [2, 2, 2, 1, 1],  # equal ones
        [1e9, 1, 1e-3, 1e-3 + 1e-12, 0],
        [7, 7, 7, 7, 7],
    ],
)
def test_refined_eigenvectors(values):
    draw = np.random.default_rng(3)
    turn = np.linalg.qr(draw.normal(size=(5, 5)))[0].astype(np.longdouble)
    turn = turn + turn @ (np.eye(5, dtype=np.longdouble) - turn.T @ turn) / 2
    matrix = np.asarray((turn * np.array(values, dtype=np.longdouble)) @ turn.T, dtype=np.float64)
    matrix = (matrix + matrix.T) / 2
    got, vectors = whitening.refined_eigenvectors(matrix)
    wide = vectors.astype(np.longdouble)
    scale = max(values)
    assert np.abs(got - np.array(sorted(values, reverse=True))).max() < 4e-16 * scale
    assert np.abs(wide.T @ wide - np.eye(5)).max() < 1e-15
    assert np.abs(matrix @ wide - wide * got).max() < 1e-15 * scale
    assert all(v[np.abs(v).argmax()] > 0 for v in vectors.T)


def test_near_eigenvalues_give_the_right_vectors():
    """Gaps of 1e-9: beyond float32, well within doubles."""
    values = np.array([1 + 2e-9, 1 + 1e-9, 1, 0.5], dtype=np.longdouble)
    draw = np.random.default_rng(5)
    turn = np.linalg.qr(draw.normal(size=(4, 4)))[0].astype(np.longdouble)
    for _ in range(2):
        turn = turn + turn @ (np.eye(4, dtype=np.longdouble) - turn.T @ turn) / 2
    matrix = np.asarray((turn * values) @ turn.T, dtype=np.float64)
    _, vectors = whitening.refined_eigenvectors((matrix + matrix.T) / 2)
    # Rounding the matrix to doubles alone moves them by 1e-16 over the gap.
    assert np.abs(np.abs((turn.T @ vectors).astype(float)) - np.eye(4)).max() < 1e-6


def test_awkward_vectors(spark, shared):  # noqa: F811
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 5), float(i % 3), 1.0], 0) for i in range(30)]
    odd = [(90, None, 1), (91, [], 1), (92, [1.0, None, 2.0], 1), (93, [nan, 0.0, 0.0], 1), (94, [inf, 0.0, 0.0], 1)]
    odd += [(95, [1.0, 2.0], 1), (0, [0.0, 0.0, 1.0], None), (None, [1.0, 1.0, 1.0], 2)]
    table = embeddings(spark, rows + odd).repartition(3)
    got = whitening.whiten(with_clashes(table)).select("row.vec_id", "n", "deviation", "whitened", "explained", "identity_error")
    got = got.collect()
    assert len(got) == 32 and {r.n for r in got} == {32}
    assert {r.vec_id for r in got} == {*range(30), None}
    # The third dimension doesn't vary.
    assert all(len(r.whitened) == 3 and r.whitened[2] is None and r.whitened[1] is not None for r in got)
    assert got[0].identity_error < 1e-12 and abs(sum(got[0].explained) - 1) < 1e-12
    same = whitening.whiten(embeddings(spark, [(i, [2.0, 3.0], 0) for i in range(4)])).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(0, [None, None], [None, None], 0.0)] * 4
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.filter("vec_id > 89")).select("row.vec_id").collect() == [(95,)]


def test_huge_entries_stay_exact(spark, shared):  # noqa: F811
    draw = random.Random(2)
    rows = [(i, [draw.uniform(-1e6, 1e6), draw.uniform(-1e38, 1e38)], 0) for i in range(50)]
    got = whitening.whiten(embeddings(spark, rows)).collect()
    limit = whitening.LARGEST - whitening.SHIFT
    x = [
        [math.floor(max(-limit, min(limit, 1024 * float(np.float32(c))))) + 100000 for c in v] for _, v, _ in rows
    ]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((50 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert [r.deviation for r in got] == [d if d < 1 << 63 else None for d in exact]
    assert got[0].identity_error < 1e-9
    fitted = whitening.fit(
        embeddings(spark, rows).select(whitening.whole_numbers(F.col("embedding").cast("array<double>")).alias("x")), 2
    )
    trace = sum(Fraction(sum((50 * v[j] - sums[j]) ** 2 for v in x), 50**3) for j in range(2))
    assert abs(fitted.trace / float(trace) - 1) < 1e-14


# --------------------------------------------------------------------------
# neighbours


def nearest_plainly(rows, asked, k):
    usable = {
        (i, tuple(float(np.float32(c)) for c in v))
        for i, v in rows
        if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
    }
    out = defaultdict(list)
    for i, v in usable:
        if asked(i):
            scores = [(-float(np.dot(v, w)), j) for j, w in usable if j != i and len(w) == len(v)]
            out[i].append(sorted(scores)[:k])
    return out


@pytest.mark.parametrize("shard_rows, query_rows", [(10_000, 50_000), (60, 9)])
def test_few_vectors_are_all_found(spark, shared, shard_rows, query_rows):  # noqa: F811
    """Fewer nodes than the beam holds: the search is exact, over any number of shards and blocks."""
    draw = np.random.default_rng(8)
    vectors = draw.normal(size=(300, 6)).round(1) * draw.integers(1, 4, size=(300, 1))
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[5][1]) for i in range(100)]  # a hot group of equal vectors
    rows += [(40, [0.0] * 6), (60, None), (2000, [float("nan")] * 6), (2001, [1.0]), (None, rows[0][1]), rows[20], (80, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = pruned_graph.build_index(with_clashes(table), neighbours=12, shard_rows=shard_rows)
    got = defaultdict(list)
    found = pruned_graph.search(index, table.filter("vec_id % 20 = 0"), neighbours=12, beam=400, query_rows=query_rows)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    want = nearest_plainly([r for r in rows if not (r[1] and len(r[1]) == 1)], lambda i: i % 20 == 0, 12)
    assert got.keys() == want.keys()
    for q, (best,) in want.items():
        assert [r[0] for r in got[q]] == list(range(1, 13))
        assert [r[2] for r in got[q]] == pytest.approx([-s for s, _ in best], abs=1e-9)
        assert [r[1] for r in got[q]] == [j for _, j in best] or len({round(s, 9) for s, _ in best}) < 12


def test_equal_vectors_come_by_id(spark, shared):  # noqa: F811
    rows = [(i, [1.0, 2.0]) for i in range(50)] + [(70, [-1.0, 0.0]), (71, [2.0, 4.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = pruned_graph.nearest(table, table.filter("vec_id in (0, 40, 71)"), neighbours=5)
    got = [tuple(r) for r in got.orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in got if r[0] == 0] == [(0, 1, 71), (0, 2, 1), (0, 3, 2), (0, 4, 3), (0, 5, 4)]
    assert [r[2] for r in got if r[0] == 40] == [71, 0, 1, 2, 3]
    assert [r[2] for r in got if r[0] == 71] == [0, 1, 2, 3, 4] and got[-1][3] == 10.0


def test_fewer_candidates_than_asked_for(spark, shared):  # noqa: F811
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    got = pruned_graph.nearest(table, table.filter("vec_id = 0"))
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 1, 0.0), (0, 2, 2, -1.0)]
    assert pruned_graph.nearest(table.limit(1), table).count() == 2
    assert pruned_graph.nearest(table.limit(0), table).count() == 0
    assert pruned_graph.nearest(table, table.limit(0)).count() == 0


def python_bytes(df):
    """Bytes that Python workers sent back while the rows were collected."""
    df.collect()
    nodes, total = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        if node.metrics().contains("pythonDataReceived"):
            total += node.metrics().apply("pythonDataReceived").value()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_what_is_found_carries_no_vectors(spark, shared):  # noqa: F811
    """A task's results are a few numbers a row, however long the vectors are that were asked for."""
    draw = np.random.default_rng(3)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(draw.normal(size=(400, 200)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = pruned_graph.build_index(table, neighbours=10)
    found = python_bytes(pruned_graph.search(index, table, neighbours=10))
    assert 400 * 10 * 24 <= found < 400 * 10 * 100


def test_groups_may_be_cut_by_batches(spark, shared):  # noqa: F811
    """Nodes and queries of one shard come in several batches, and several shards in one."""
    draw = np.random.default_rng(4)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(draw.normal(size=(150, 5)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = pruned_graph.build_index(table, neighbours=6, shard_rows=40)
    want = nearest_plainly(rows, lambda i: i % 3 == 0, 6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = defaultdict(list)
        for r in pruned_graph.search(index, table.filter("vec_id % 3 = 0"), neighbours=6, query_rows=20).collect():
            got[r.query_id].append((r.rank, r.vec_id))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {q: [j for _, j in sorted(found)] for q, found in got.items()} == {q: [j for _, j in best] for q, (best,) in want.items()}


def recall(got, vectors, k):
    """Share of the true nearest that were found, over all queries."""
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], dtype=np.float64)
    hits = total = 0
    for q in {g[0] for g in got}:
        score = x @ np.array(vectors[q], dtype=np.float64)
        true = ids[np.lexsort((ids, -score))]
        true = set([int(i) for i in true if i != q][:k])
        hits += len(true & {g[2] for g in got if g[0] == q})
        total += len(true)
    return hits / total


def test_query_recall(spark, shared, sf_dir):  # noqa: F811
    got = [tuple(r) for r in queries.QUERIES["op13_pruned_graph"](spark, sf_dir).collect()]
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    vectors = {r.vec_id: r.embedding for r in given}
    assert {g[0] for g in got} == {i for i in vectors if i % 20 == 0}
    assert Counter(g[0] for g in got) == {i: 20 for i in vectors if i % 20 == 0}
    for q, _, v, score in got:
        assert score == pytest.approx(float(np.dot(np.array(vectors[q], float), np.array(vectors[v], float))), abs=1e-12)
    assert recall(got, vectors, 20) >= 0.9


def test_graph_of_near_copies_is_reached_whole():
    draw = np.random.default_rng(1)
    centre = draw.normal(size=(3, 16))
    points = np.concatenate([c + draw.normal(size=(400, 16)) * 1e-4 for c in centre]).astype(np.float32)
    edges, start = pruned_graph.build_graph(points, degree=8, beam=16)
    assert pruned_graph._reached(edges, start).all()
    for own, ends in enumerate(edges):
        ends = ends[ends >= 0]
        assert len(set(ends)) == len(ends) and own not in ends


def test_pruned_edges_are_diverse():
    points = np.array([[0.0, 0], [1, 0], [1.1, 0], [0, 2], [0, -3]], dtype=np.float32)
    kept = pruned_graph._pruned(points, np.array([0]), np.array([[1, 2, 3, 4]]), 4, 1.2)[0]
    assert list(kept) == [1, 3, 4, -1]
