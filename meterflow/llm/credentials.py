"""Secrets in text, with multipart credentials linked inside scopes.

Strong findings (an assigned secret, an access identifier, a long hexadecimal
string) are reported on their own. Weak parts (names of users or clients, hosts
and URLs, tokens of mixed characters) are common in clean text: they are reported
only where the parts that complete them come together within one scope: an
identifier for a secret, a secret for an identifier, both for an endpoint. The join of parts by interval runs per text over
parts sorted by place, so a text full of parts costs no more than sorting them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import key_columns, packed, whole, written

# The strong patterns, with the least code points of the value.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"

# Weak parts: what each is alone says little. Values of any length; nothing is read
# twice, as quantifiers are possessive and look-aheads start at the start of a run only.
IDENTIFIER = r"""(?i)(?<![a-z0-9])(?:user(?:_?name)?|login|client_?id|access_?key_?id|account)["']?\x20*+[:=]\x20*+["']?[a-z0-9@._-]{3,}+"""
ENDPOINT = r"""(?i)(?<![a-z0-9])(?:(?:https?|jdbc:[a-z]{2,}+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]{4,}+|(?:host|endpoint|server)["']?\x20*+[:=]\x20*+["']?[a-z0-9.-]{4,}+)"""
OPAQUE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_=-])"

# Kinds in the order of listing; part: what a finding can complete.
KINDS = ("assign", "access", "hex", "identifier", "endpoint", "opaque")
PARTS = {"assign": "secret", "hex": "secret", "opaque": "secret", "access": "id", "identifier": "id", "endpoint": "place"}
STRONG = ("assign", "access", "hex")
# What has to stand near a weak finding.
COMPLETES = {"identifier": ("secret",), "endpoint": ("id", "secret"), "opaque": ("id",)}
SCOPE = 400  # code points between parts of one credential

# Matches whose places are summed up together: appending to an array copies it.
TOGETHER = 256

SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def spans_of(text: Column, pattern: str, kind: str, value_chars: Column | None = None) -> Column:
    """Array of (start, rank, end, kind) of the pattern's matches, leftmost first, in code points.

    What stands between the matches and the matches themselves alternate, so their
    lengths give the places.
    """
    between, found = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)),
        found,
        lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("size")),
    )

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        place = F.struct(start.alias("start"), (start + x["size"]).alias("end"))
        return F.struct((start + x["size"]).alias("at"), F.concat(state["places"], F.array(place)).alias("places"))

    # Places from the start of each run of matches first, then the starts of the runs.
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("places"))
    runs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found) - 1) / TOGETHER).cast("int")),
        lambda r: F.aggregate(F.slice(steps, r * TOGETHER + 1, TOGETHER), empty, step),
    )
    begins = F.aggregate(
        runs,
        F.array(F.lit(0)),
        lambda state, run: F.concat(state, F.array(F.element_at(state, -1) + run["at"])),
    )

    def span(place: Column, begin: Column) -> Column:
        return F.struct(
            (begin + place["start"]).alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            (begin + place["end"]).alias("end"),
            F.lit(kind).alias("kind"),
        )

    spans = F.flatten(
        F.zip_with(
            runs,
            F.slice(begins, F.lit(1), F.size(runs)),
            lambda run, begin: F.transform(run["places"], lambda place: span(place, begin)),
        )
    )
    if value_chars is not None:
        enough = F.zip_with(
            spans, value_chars, lambda span, chars: F.struct(span.alias("span"), chars.alias("chars"))
        )
        spans = F.transform(F.filter(enough, lambda x: x["chars"] >= 8), lambda x: x["span"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def strong_spans(text: Column) -> dict[str, Column]:
    values = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), F.length)
    return {
        "assign": spans_of(text, ASSIGN, "assign", values),
        "access": F.when(F.contains(text, F.lit("AKIA")), spans_of(text, ACCESS, "access")).otherwise(
            F.array().cast(SPAN)
        ),
        "hex": spans_of(text, HEX, "hex"),
    }


def weak_spans(text: Column) -> Column:
    return F.concat(
        spans_of(text, IDENTIFIER, "identifier"), spans_of(text, ENDPOINT, "endpoint"), spans_of(text, OPAQUE, "opaque")
    )


def linked_parts(parts: DataFrame, key: list[str], scope: int = SCOPE) -> DataFrame:
    """Weak parts of (key, span) rows that have what completes them within ``scope`` code points.

    Those that overlap a strong finding are left out.

    A part's partner of another sort is the nearest one before or after it by place;
    one sorted pass in each direction finds both.
    """
    rows = parts.select(*key, "span", F.col("span.start").alias("start"), F.col("span.end").alias("end"))
    rows = rows.withColumn("part", _part(F.col("span.kind")))
    before = Window.partitionBy(*key).orderBy("start", "end", "span.rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*key).orderBy("start", "end", "span.rank").rowsBetween(1, Window.unboundedFollowing)
    complete = F.lit(False)
    near = {}
    for part in sorted(set(PARTS.values())):
        other = F.col("part") == part
        behind = F.col("start") - F.max(F.when(other, F.col("end"))).over(before) <= scope
        ahead = F.min(F.when(other, F.col("start"))).over(after) - F.col("end") <= scope
        near[part] = F.coalesce(behind, F.lit(False)) | F.coalesce(ahead, F.lit(False))
    rows = rows.withColumns({f"near_{part}": found for part, found in near.items()})
    for kind, needed in COMPLETES.items():
        has = F.col("span.kind") == kind
        for part in needed:
            has = has & F.col(f"near_{part}")
        complete = complete | has
    # A strong finding that starts no later and ends inside, or that starts inside.
    strong = F.col("span.kind").isin(*STRONG)
    upto = Window.partitionBy(*key).orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    on = Window.partitionBy(*key).orderBy("start").rangeBetween(0, Window.unboundedFollowing)
    covered = F.max(F.when(strong, F.col("end"))).over(upto) > F.col("start")
    meets = F.min(F.when(strong, F.col("start"))).over(on) < F.col("end")
    rows = rows.withColumn("free", ~F.coalesce(covered, F.lit(False)) & ~F.coalesce(meets, F.lit(False)))
    return rows.filter(complete & F.col("free")).select(*key, "span")


def _part(kind: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in PARTS.items() for x in pair]), kind)


def scan_secrets(documents: DataFrame, keep: list[str] | None = None, scope: int = SCOPE) -> DataFrame:
    """``row`` (the kept columns, all by default), ``strong`` and ``linked``: arrays of (start, rank, end, kind).

    Places are in code points, the end is exclusive. ``strong`` has the findings of
    the three strong kinds, by start and kind; ``linked`` adds weak parts with what
    completes them within ``scope`` code points, less those that overlap a strong
    finding. A null text is empty. Results depend on the text alone, so repeated rows
    get the same; an empty table gives no rows.
    """
    text = whole(F.col("text"))
    strong = strong_spans(text)
    # Where a text has no identifier, no weak part can be completed.
    weak = F.when(text.rlike(IDENTIFIER) | F.contains(text, F.lit("AKIA")), weak_spans(text))
    scanned = documents.select(
        *key_columns(text),
        packed(documents, keep),
        F.array_sort(F.concat(*strong.values())).alias("strong"),
        F.coalesce(weak, F.array().cast(SPAN)).alias("weak"),
    )
    # Scanning is the costly part: once for all that follows.
    scanned = written(scanned, "scanned")
    parts = (
        scanned.filter(F.size("weak") > 0)
        .select("k1", "k2", F.explode(F.concat("strong", "weak")).alias("span"))
        .dropDuplicates(["k1", "k2", "span"])
    )
    linked = linked_parts(parts, ["k1", "k2"], scope)
    linked = linked.groupBy("k1", "k2").agg(F.array_sort(F.collect_list("span")).alias("found"))
    # Written, so that the rows of a text with very many copies can be split between tasks.
    linked = written(linked, "linked")
    plain = scanned.filter(F.size("weak") == 0).select("row", "strong", F.array().cast(SPAN).alias("linked"))
    joined = scanned.filter(F.size("weak") > 0).join(linked, ["k1", "k2"], "left")
    found = F.coalesce(F.col("found"), F.array().cast(SPAN))
    return plain.unionByName(joined.select("row", "strong", found.alias("linked")))


def listing(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
