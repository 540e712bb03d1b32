"""Registered queries against SQL or brute force on the given tables, and the pipeline."""

from __future__ import annotations

import hashlib
import struct
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from meterflow.llm import bpe, fertility, queries, vocabularies
from oracles.compare import connect, differences
from tests.llm.helpers import awkward_documents, with_clashes
from tests.llm.test_operators import base_measures, base_spans, classes, lines_kept, removed, shared  # noqa: F401


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def documents(con):
    return con.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def rows_of(spark, sf_dir, prefix):
    name = next(n for n in queries.QUERIES if n.startswith(prefix))
    return {r[0]: tuple(r[1:]) for r in queries.QUERIES[name](spark, sf_dir).collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, shared, con, sf_dir, name):  # noqa: F811
    assert differences(con, queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name]) == []


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("prefix", ["op7_", "op9_", "op10_"])
def test_native_queries_run_no_python(spark, shared, sf_dir, prefix):  # noqa: F811
    name = next(n for n in queries.QUERIES if n.startswith(prefix))
    text = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_quality(spark, shared, sf_dir, documents):  # noqa: F811
    got = rows_of(spark, sf_dir, "op1_")
    assert {i: r[:6] for i, r in got.items()} == {i: base_measures(t) for i, t in documents}
    assert not any(r[5] and r[6] for r in got.values())


def test_quality_keeps_clean_documents(spark, shared, sf_dir, con):  # noqa: F811
    got = rows_of(spark, sf_dir, "op1_")
    labels = con.sql("SELECT doc_id, quality FROM labels").fetchall()
    clean = [got[i] for i, q in labels if q == 1 and i in got and not got[i][5]]
    assert clean and all(r[6] for r in clean)


def test_repeats(spark, shared, sf_dir, documents):  # noqa: F811
    got = rows_of(spark, sf_dir, "op2_")
    want = removed([t for _, t in documents], 400)
    assert got == {i: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for (i, _), w in zip(documents, want)}


def test_near(spark, shared, sf_dir, documents):  # noqa: F811
    assert rows_of(spark, sf_dir, "op6_") == classes(documents)


def test_secrets(spark, shared, sf_dir, documents):  # noqa: F811
    got = rows_of(spark, sf_dir, "op7_")
    assert {i: r[3] for i, r in got.items()} == {
        i: hashlib.sha256(base_spans(t).encode()).hexdigest() for i, t in documents
    }


def test_pipeline(spark, shared, sf_dir):  # noqa: F811
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "near duplicates", "benchmark decontamination", "byte-level BPE"]
    out = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert len(out) and (out.ids.str.len() == 4 * out.n_tokens).all()
    assert [hashlib.sha256(bytes(i)).hexdigest() for i in out.ids] == out.ids_sha256.tolist()


def compared(text):
    """Letters, digits and marks in lower case, single spaces between."""
    low = [c.lower() if len(c.lower()) == 1 else c for c in text or ""]
    words = (c if o.isalnum() or unicodedata.category(o)[0] == "M" else " " for c, o in zip(low, text or ""))
    return " ".join(w for w in "".join(words).split(" ") if w)


def stands_in(item, text):
    """Whether some part of the text is the item with up to 8 % edits."""
    n = len(item)
    budget = max(0, min(int(n * 0.08), (n - 10) // 10))
    # One of budget + 1 pieces is unchanged.
    cuts = [n * k // (budget + 1) for k in range(budget + 2)]
    if not any(item[a:b] in text for a, b in zip(cuts, cuts[1:])):
        return False
    chars = np.array([ord(c) for c in text])
    step = np.arange(len(chars) + 1)
    cost = np.zeros(len(chars) + 1, np.int64)
    for c in item:
        now = cost + 1
        now[1:] = np.minimum(now[1:], cost[:-1] + (chars != ord(c)))
        cost = np.minimum.accumulate(now - step) + step
    return int(cost.min()) <= budget


def pieces(item):
    last = len(item) - 100
    return [item] + ([item[a : a + 100] for a in {*range(0, last, 50), last}] if last > 0 else [])


def leaking(documents, con):
    items = [(i, compared(t)) for i, t in con.sql("SELECT item_id, text FROM benchmark").fetchall()]
    assert min(len(t) for _, t in items) >= 24
    texts = [(i, compared(t)) for i, t in documents]
    return {(d, i) for d, text in texts for i, item in items if any(stands_in(p, text) for p in pieces(item))}


def test_leaks_by_brute_force(spark, shared, con, sf_dir, documents):  # noqa: F811
    name = next(n for n in queries.QUERIES if n.startswith("op4_"))
    found = queries.QUERIES[name](spark, sf_dir).select("doc_id", "item_id").collect()
    want = leaking(documents, con)
    assert want and sorted(tuple(r) for r in found) == sorted(want)


def test_pipeline_by_brute_force(spark, shared, con, sf_dir, documents):  # noqa: F811
    langs = dict(con.sql("SELECT doc_id, lang FROM documents").fetchall())
    # The base rules by brute force; the measures of the bands have tests of their own.
    meter = fertility.meter(vocabularies.path(fertility.RANKS), vocabularies.path(fertility.PIECES))
    rows = [(i, t) for i, t in documents if not base_measures(t)[5]]
    rows = [(i, t) for (i, t), m in zip(rows, meter.measure([t for _, t in rows])) if fertility.accepted(m, t, langs[i])]
    rows = [(r[0], r[3]) for r in lines_kept(rows)]
    near = classes(rows)
    rows = [(i, t) for i, t in rows if near[i][0] == i]
    leaks = {d for d, _ in leaking(rows, con)}
    encoding = vocabularies.rank_encoding(vocabularies.path(bpe.RANKS))
    want = {}
    for i, t in rows:
        if i not in leaks:
            ids = encoding.encode_ordinary(t)
            want[i] = struct.pack(f"<{len(ids)}I", *ids)
    got = [(r.doc_id, bytes(r.ids)) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "ids").collect()]
    assert want and leaks and sorted(got) == sorted(want.items())


def test_stages_on_awkward_documents(spark, shared, sf_dir):  # noqa: F811
    docs = with_clashes(awkward_documents(spark))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        kept[name] = sorted(r[0] for r in out.select(F.coalesce("doc_id", F.lit(-1))).collect())
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert kept["quality rules"] == [-1, 1, 1]
    assert kept["line dedup"] == [-1, 1, 1, 2, 3, 4, 5, 6, 7]
    assert kept["near duplicates"] == [1, 2, 4, 5, 6, 7]
    assert kept["benchmark decontamination"] == [-1, 1, 1, 2, 3, 4, 5, 6, 7]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == 9
