"""Queries of this subpackage: one per operator, over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import (
    bpe,
    chat,
    credentials,
    decontaminate,
    fertility,
    jaccard_forest,
    line_runs,
    pruned_graph,
    ranked_search,
    suffix_dedup,
    token_counts,
    whitening,
    wrappers,
)
from meterflow.llm.common import sha256, table, whole

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = fertility.rate_documents(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return rated.select(
        F.col("row.doc_id").alias("doc_id"),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
        *("n_tokens", "chars_per_token", "fallback_share", "token_entropy"),
    )


@_query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return cleaned.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


ORACLES["op2_suffix_dedup"] = r"""
WITH raw AS (
    SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents
), windows AS (
    SELECT r, s, b[s + 1:s + 400] AS w
    FROM (SELECT r, b, unnest(range(octet_length(b) - 399)) AS s FROM raw WHERE octet_length(b) >= 400) AS starts
), found AS (
    SELECT r, s FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)
), edges AS (
    SELECT *, coalesce(s > lag(s) OVER (PARTITION BY r ORDER BY s) + 400, true)::INT AS fresh FROM found
), numbered AS (
    SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS span FROM edges
), spans AS (
    SELECT r, span, min(s) AS a, max(s) + 400 AS z FROM numbered GROUP BY r, span
), gaps AS (
    SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS z FROM spans
    UNION ALL SELECT r, max(z), NULL FROM spans GROUP BY r
    UNION ALL SELECT r, 0, NULL FROM raw WHERE r NOT IN (SELECT r FROM spans)
), left_over AS (
    SELECT r, string_agg(hex(b[a + 1:coalesce(z, octet_length(b))]), '' ORDER BY a) AS kept FROM gaps JOIN raw USING (r) GROUP BY r
), sums AS (
    SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r
)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM raw JOIN left_over USING (r) LEFT JOIN sums USING (r)
"""


@_query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_texts(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return encoded.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"], parts=True
    )
    return found.select(F.col("row.doc_id").alias("doc_id"), F.inline("leaks"))


@_query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrappers.extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


ORACLES["op5_html_extraction"] = r"""
-- All given pages have one plain article element.
WITH articles AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS a FROM pages
), blocks AS (
    SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(a, '</?(?:p|h1)>'), lambda x: trim(regexp_replace(
        replace(replace(replace(replace(replace(regexp_replace(replace(x, '<br>', ' '), '<[a-zA-Z/][^>]*>', '', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS b
    FROM articles
)
SELECT page_id, url, array_to_string(b, chr(10)) AS text, length(array_to_string(b, chr(10))) AS n_chars FROM blocks
"""


@_query
def op6_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = jaccard_forest.join_near(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return near.select(F.col("row.doc_id").alias("doc_id"), "class_id", "n_links", "n_copies")


ORACLES["op6_jaccard_forest"] = r"""
WITH RECURSIVE texts AS (
    SELECT coalesce(text, '') AS t, min(doc_id) AS least, count(*) AS n_copies, row_number() OVER (ORDER BY coalesce(text, '')) AS i
    FROM documents GROUP BY 1
), words AS (
    SELECT i, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts
), shingles AS (
    SELECT DISTINCT i, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))
                                   WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM words
), sizes AS (
    SELECT i, count(*) AS n FROM shingles GROUP BY i
), shared AS (
    SELECT a.i AS i, b.i AS j, count(*) AS n FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.i <> b.i GROUP BY ALL
), links AS (
    SELECT shared.i, j FROM shared JOIN sizes AS x ON x.i = shared.i JOIN sizes AS y ON y.i = j
    WHERE 5 * shared.n >= 4 * (x.n + y.n - shared.n)
), reached(i, j) AS (
    SELECT i, i FROM texts UNION SELECT reached.i, links.j FROM reached JOIN links ON links.i = reached.j
), classes AS (
    SELECT reached.i, min(least) AS class_id FROM reached JOIN texts ON texts.i = reached.j GROUP BY reached.i
), degrees AS (
    SELECT i, count(*) AS n_links FROM links GROUP BY i
)
SELECT doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links, n_copies
FROM documents JOIN texts ON t = coalesce(text, '') JOIN classes USING (i) LEFT JOIN degrees USING (i)
"""


@_query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = credentials.scan_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    of_kind = lambda kind: F.size(F.filter("strong", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        F.col("row.doc_id").alias("doc_id"),
        of_kind("assign").alias("n_assign"),
        of_kind("access").alias("n_access"),
        of_kind("hex").alias("n_hex"),
        sha256(credentials.listing(F.col("strong"))).alias("base_sha256"),
        credentials.listing(F.array_sort(F.concat("strong", "linked"))).alias("spans"),
    )


@_query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return counted.select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit")
    )


@_query
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    awkward = r"\### Assistant: </turn> ok"
    # The contract's own conversation, whose texts hold the template's control strings.
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(awkward).alias("text"),
    )
    rows = given.select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest(chat.format_chats(rows))


ORACLES["op9_chat_formatting"] = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), turns AS (
    SELECT *, length(role) + length('###  : </turn>')
        + length(replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '#', '\#')) AS chars
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars,
    regexp_full_match(string_agg(role || ' ', '' ORDER BY turn, role, text), '(system )?(user assistant )+') AS valid
FROM turns GROUP BY conv_id
"""


@_query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", sha256(F.col("kept")).alias("kept_sha256")
    )


ORACLES["op10_line_dedup"] = r"""
WITH split AS (
    SELECT doc_id, coalesce(doc_id, 9223372036854775807) AS did, row_number() OVER () AS row_id,
        string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
), lines AS (
    SELECT doc_id, did, row_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM split
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), owners AS (
    SELECT key, min(did) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key
), marked AS (
    SELECT keyed.*, coalesce(did > owner, false) AS dropped FROM keyed LEFT JOIN owners USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY row_id
"""


@_query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


ORACLES["op11_ranked_search"] = r"""
WITH item_terms AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), doc_terms AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), totals AS (
    SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_all FROM doc_terms WHERE len(terms) > 0
), postings AS (
    SELECT r, doc_id, len(terms) AS n, term, count(*) AS tf
    FROM (SELECT r, doc_id, terms, unnest(terms) AS term FROM doc_terms) AS t
    WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM postings, totals GROUP BY term
), impacts AS (
    SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_all))) AS impact
    FROM postings JOIN weights USING (term), totals
), scores AS (
    SELECT item_id, r, doc_id, sum(impact)::BIGINT AS score FROM impacts JOIN item_terms USING (term) GROUP BY item_id, r, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@_query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"), keep=["vec_id"])
    placed = white.select("row.vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("i", "whitened"))
    return placed.select(
        "vec_id",
        (F.col("i") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.element_at("explained", F.col("i") + 1).alias("explained"),
        "identity_error",
    )


@_query
def op13_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return pruned_graph.nearest(vectors, vectors.filter("vec_id % 20 = 0"))
