"""Main text of web pages by wrappers, union-free regular expressions inferred per host.

The pages of a host are read as token streams and aligned one after the other. Where
page and wrapper differ, the mismatch becomes an optional group, a repeated group or,
between texts, a slot. Wrappers of parts of a host's pages are aligned with each other in
the same way, so a host of any size is inferred in parallel, and only wrappers move.

A wrapper tells which region of the host's pages holds the article. The region's
blocks are the text, without the menus, notices, adverts and so on that lie inside. An
element that its marks make one of these stays where it holds most of the region's text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from hashlib import blake2b
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.batches import by_slice, slices
from meterflow.llm.common import packed, whole, with_row, written
from meterflow.llm.html_tree import INLINE, RAW, Element, blocks, parse

# Elements that are never part of an article, by tag and by words of class, id and role.
NOT_TEXT = frozenset(
    "nav header footer aside form button select input fieldset dialog menu template svg canvas object head".split()
)
NOT_TEXT_WORDS = frozenset(
    "ad ads adslot advert adverts advertisement advertisements advertising adv banner banners sponsor sponsored promo"
    " promos promotion sidebar sidebars rail comment comments commentlist disqus replies cookie cookies consent gdpr"
    " notice notices alert popup popups modal overlay nav navbar navigation menu menus submenu breadcrumb breadcrumbs"
    " pagination pager header masthead footer colophon share sharing social related recommended newsletter subscribe"
    " subscription signup login search toolbar widget widgets skip complementary contentinfo".split()
)
# Words that are hardly ever said of the article itself.
THREAD_WORDS = frozenset("comment comments commentlist disqus replies cookie cookies consent gdpr".split())
ABOUT_THE_PAGE = re.compile(r"(no|not|has|with|without|is)[-_]|\w+[-_](open|closed|free)$")
WHOLE_PAGE = frozenset("#page html body article main".split())
# The wrapper table goes to every executor up to so many bytes; beyond, pages are joined by host.
BROADCAST_BYTES = 4 << 20
SALTS = 16
LONGEST_PERIOD = 6
# Share of a host's text that its region holds where no tag names the article.
REGION_SHARE = 0.6
# An element with a mark of NOT_TEXT_WORDS is part of the article if it holds more than this share of
# its text and the unmarked text of the region; the second share is for THREAD_WORDS.
MARKED_SHARE, THREAD_SHARE = 0.5, 0.9


def left_out(node: Element) -> bool:
    """Whether an element is a menu, header, notice or the like."""
    return node.name in NOT_TEXT or marked(node) > 0


def marked(node: Element) -> float:
    """Share of the text that an element needs to count as article in spite of its marks; 0 without such marks."""
    if not node.marks or node.name in WHOLE_PAGE:
        return 0
    # Marks such as no-sidebar or has-comments tell about the page, not the element.
    names = [m for m in node.marks.split() if not ABOUT_THE_PAGE.match(m)]
    words = {w for m in names for w in re.split(r"[^a-z]+", m)}
    if NOT_TEXT_WORDS.isdisjoint(words) or _holds_article(node):
        return 0
    return MARKED_SHARE if THREAD_WORDS.isdisjoint(words) else THREAD_SHARE


def _holds_article(node: Element) -> bool:
    todo = list(node.children)
    while todo:
        child = todo.pop()
        if isinstance(child, Element):
            if child.name in ("article", "main"):
                return True
            todo.extend(child.children)
    return False


def key(node: Element) -> str:
    """What a token of the stream is compared by: the tag and the marks without numbers."""
    marks = sorted({m for m in re.split(r"[^a-z-]+", node.marks) if m})
    return f"{node.name}.{'.'.join(marks)}" if marks else node.name


# A wrapper is [key, how often, parts]; how often is "1", "?", "+" or "*". A text is
# ["#text", how often, hash], with the hash None for a slot. A group is ["#group", how often, parts].


def stream(node: Element) -> list:
    """Wrapper of one page: its elements and texts, with repeats folded into groups."""
    if node.name in RAW:
        return [node.name, "1", []]
    parts = []
    for child in node.children:
        if isinstance(child, Element):
            if child.name not in INLINE or child.name == "a":
                parts.append(stream(child))
            else:
                parts.extend(stream(child)[2])
        elif child.strip():
            parts.append(["#text", "1", blake2b(child.strip().encode("utf-8", "replace"), digest_size=8).hexdigest()])
    texts = groupby(parts, key=lambda p: p[0] == "#text")
    joined: list = []
    for is_text, group in texts:
        group = list(group)
        if is_text and len(group) > 1:
            group = [["#text", "1", blake2b("".join(str(g[2]) for g in group).encode(), digest_size=8).hexdigest()]]
        joined.extend(group)
    return [key(node), "1", folded(joined)]


def shape(part: list) -> str:
    """What parts have in common that repeat each other."""
    return part[0] if part[0] != "#group" else f"({' '.join(shape(p) for p in part[2])})"


def folded(parts: list) -> list:
    """Parts with runs of the same sequence of shapes made into one repeated part or group."""
    for period in range(1, LONGEST_PERIOD + 1):
        shapes = [shape(p) for p in parts]
        out, at = [], 0
        while at < len(parts):
            end = at + period
            while shapes[end : end + period] == shapes[at : at + period] and end + period <= len(parts):
                end += period
            if end > at + period:
                group = parts[at : at + period]
                for start in range(at + period, end, period):
                    group = [merged(a, b) for a, b in zip(group, parts[start : start + period])]
                if period == 1:
                    out.append([group[0][0], _often(group[0][1], "+"), group[0][2]])
                else:
                    out.append(["#group", "+", group])
                at = end
            else:
                out.append(parts[at])
                at += 1
        parts = out
    return parts


def _often(a: str, b: str) -> str:
    some, many = a in "?*" or b in "?*", a in "+*" or b in "+*"
    return "*" if some and many else "?" if some else "+" if many else "1"


def merged(a: list, b: list) -> list:
    """Alignment of two parts of the same shape."""
    often = _often(a[1], b[1])
    if a[0] == "#text":
        return ["#text", often, a[2] if a[2] == b[2] else None]
    return [a[0], often, aligned(a[2], b[2])]


def aligned(a: list, b: list) -> list:
    """Alignment of two streams: what only one of them has is optional."""
    if a == b:
        return a
    out = []
    matcher = SequenceMatcher(None, [shape(p) for p in a], [shape(p) for p in b], autojunk=False)
    for tag, a0, a1, b0, b1 in matcher.get_opcodes():
        if tag == "equal":
            out.extend(merged(x, y) for x, y in zip(a[a0:a1], b[b0:b1]))
        else:
            out.extend([p[0], _often(p[1], "?"), p[2]] for p in a[a0:a1] + b[b0:b1])
    return folded(out)


class Volumes:
    """Characters by path of elements: [outside links, inside links].

    ``marks`` has the paths of elements with marks of ``NOT_TEXT_WORDS``, and the shares that
    they need; inline elements are on a path only with such marks. ``page`` is the
    digest of the pages' stream, empty once they differ.
    """

    def __init__(
        self,
        sums: dict[str, list[int]] | None = None,
        marks: dict[str, float] | None = None,
        page: str | None = None,
    ):
        self.sums = sums or {}
        self.marks = marks or {}
        self.page = page

    def add(self, page: Element, digest: str) -> None:
        self.page = digest if self.page in (None, digest) else ""
        todo = [(page, key(page), False)]
        while todo:
            node, path, link = todo.pop()
            sums = None
            for child in node.children:
                if isinstance(child, Element):
                    if child.name in RAW or child.name in NOT_TEXT:
                        continue
                    inner, share = inside(path, child)
                    if share:
                        self.marks[inner] = max(share, self.marks.get(inner, 0))
                    todo.append((child, inner, link or child.name == "a"))
                else:
                    if sums is None:
                        sums = self.sums.setdefault(path, [0, 0])
                    sums[link] += len(child.strip())

    def merge(self, sums: dict[str, list[int]], marks: dict[str, float], page: str) -> None:
        for path, (plain, linked) in sums.items():
            own = self.sums.setdefault(path, [0, 0])
            own[0] += plain
            own[1] += linked
        for path, share in marks.items():
            self.marks[path] = max(share, self.marks.get(path, 0))
        self.page = page if self.page == page else ""

    def parts(self) -> list:
        return [self.sums, self.marks, self.page]


def inside(path: str, child: Element) -> tuple[str, float]:
    """Path of an element inside the element of a path, and the share that its marks ask for."""
    share = marked(child)
    return (path if child.name in INLINE and not share else f"{path} {key(child)}"), share


def overruled(texts: list[tuple[tuple, int]], marks: dict) -> set:
    """Marked elements that are article all the same, from (marked elements around it, characters) of texts.

    The largest come first; each has to hold its share of what it has and what is kept beside it.
    """
    held: dict = {}
    for around, n in texts:
        for mark in around:
            held[mark] = held.get(mark, 0) + n
    plain = sum(n for around, n in texts if not around)
    kept: set = set()
    for mark in sorted((m for m, n in held.items() if n > marks[m] * (plain + n)), key=lambda m: -held[m]):
        beside = sum(n for around, n in texts if mark not in around and kept.issuperset(around))
        if held[mark] > marks[mark] * (beside + held[mark]):
            kept.add(mark)
    return kept


def paths_of(wrapper: list, path: str = "", constant: bool = True) -> Iterator[tuple[str, bool]]:
    """(path, whether it has a slot or repeats) of the wrapper's elements."""
    name = path if wrapper[0] == "#group" else f"{path} {wrapper[0]}".strip()
    varies = wrapper[1] in "+*"
    for part in wrapper[2]:
        if part[0] == "#text":
            varies = varies or part[2] is None or part[1] != "1"
        else:
            yield from paths_of(part, name)
    yield name, varies


def region(wrapper: list, sums: dict[str, list[int]], marks: dict[str, float]) -> tuple[str, set[str]]:
    """Path of the elements that hold the article, and the marked paths that are article as well."""
    varying = {path for path, varies in paths_of(wrapper) if varies}
    # (prefixes of the path, characters) of varying text outside links.
    found: list[tuple[list[str], int]] = []
    for path, (plain, linked) in sums.items():
        parts = path.split(" ")
        blocks_ = " ".join(p for p in parts if p.partition(".")[0] not in INLINE)
        if linked <= plain and blocks_ in varying:
            found.append(([" ".join(parts[:n]) for n in range(1, len(parts) + 1)], plain))

    def below(kept: set[str]) -> dict[str, int]:
        out: dict[str, int] = {}
        for ups, n in found:
            if all(up not in marks or up in kept for up in ups):
                for up in ups:
                    out[up] = out.get(up, 0) + n
        return out

    def inner(path: str) -> list[tuple[tuple, int]]:
        own = path.count(" ")
        return [(tuple(u for u in ups[own:] if u in marks), n) for ups, n in found if ups[own : own + 1] == [path]]

    if not found:
        return "", set()
    unmarked = below(set())
    everything = below(set(marks)) if marks else unmarked
    named = {tag: [p for p in everything if _tag(p) == tag] for tag in ("article", "main")}
    for volumes in (unmarked, everything):
        for paths in named.values():
            if any(p in volumes for p in paths):
                chosen = {}
                for p in paths:
                    texts = inner(p)
                    kept = overruled(texts, marks)
                    chosen[p] = sum(n for around, n in texts if kept.issuperset(around)), kept
                # The outermost of the largest.
                best = max(paths, key=lambda p: (chosen[p][0], -len(p), p))
                return best, chosen[best][1]
    kept = overruled(inner(found[0][0][0]), marks)
    volumes = below(kept)
    if not volumes:
        return "", kept
    total = max(volumes.values())
    large = [p for p, n in volumes.items() if n >= REGION_SHARE * total and _tag(p) not in INLINE | {"p"}]
    if not large:
        return "", kept
    best = max(large, key=lambda p: (p.count(" "), volumes[p], p))
    return best, kept | overruled(inner(best), marks)


def _tag(path: str) -> str:
    return path.rpartition(" ")[2].partition(".")[0]


def located(page: Element, path: str) -> list[Element]:
    """Outermost elements of a page on a path, in page order."""
    if not path:
        return []
    found: list[Element] = []
    wanted = path.split(" ")
    todo = [(page, 0)]
    while todo:
        node, depth = todo.pop()
        if key(node) != wanted[depth]:
            continue
        if depth + 1 == len(wanted):
            found.append(node)
            continue
        inner: list[Element] = []
        nested = list(reversed(node.children))
        while nested:
            child = nested.pop()
            if isinstance(child, Element):
                if child.name in INLINE:
                    nested.extend(reversed(child.children))
                else:
                    inner.append(child)
        todo.extend((child, depth + 1) for child in reversed(inner))
    return found


def _by_tag(page: Element, tag: str) -> list[Element]:
    found, todo = [], [page]
    while todo:
        node = todo.pop()
        if node.name == tag:
            found.append(node)
        elif not left_out(node):
            todo.extend(c for c in reversed(node.children) if isinstance(c, Element))
    return found


def main_text(html: str, path: str, kept: str | None = None) -> str:
    """Blocks of the region, or of the article, main part or body where the page hasn't got the region.

    ``kept`` has the marked paths that are article, a line each. Without it, or where the page
    hasn't got the region, the page's own volumes tell.
    """
    page = parse(html)
    parts = located(page, path)
    if parts and kept is not None:
        paths = frozenset(kept.split("\n")) if kept else frozenset()
        stay = {i for part in parts for i in _on_paths(part, path, paths)} if paths else set()
    else:
        parts = parts or _by_tag(page, "article") or _by_tag(page, "main") or [page]
        stay = {i for part in parts for i in _by_volume(part)}
    skipped = (lambda node: left_out(node) and id(node) not in stay) if stay else left_out
    return "\n".join(b for part in parts for b in blocks(part, skipped))


def _on_paths(part: Element, path: str, paths: frozenset[str]) -> Iterator[int]:
    """Identities of the elements on given paths."""
    todo = [(part, path)]
    while todo:
        node, at = todo.pop()
        if at in paths:
            yield id(node)
        todo.extend((c, inside(at, c)[0]) for c in node.children if isinstance(c, Element))


def _by_volume(part: Element) -> set[int]:
    """Identities of the marked elements that hold most of the text outside links of a page's part."""
    texts: list[tuple[tuple, int]] = []
    marks: dict[int, float] = {}
    linked: dict[int, int] = {}
    todo: list[tuple[Element, tuple, bool]] = [(part, (), False)]
    while todo:
        node, around, link = todo.pop()
        if node.name in RAW or node.name in NOT_TEXT:
            continue
        share, link = marked(node), link or node.name == "a"
        if share:
            marks[id(node)] = share
            around = (*around, id(node))
        for child in node.children:
            if isinstance(child, Element):
                todo.append((child, around, link))
            elif link:
                for mark in around:
                    linked[mark] = linked.get(mark, 0) + len(child.strip())
            else:
                texts.append((around, len(child.strip())))
    if not marks:
        return set()
    held: dict[int, int] = {}
    for around, n in texts:
        for mark in around:
            held[mark] = held.get(mark, 0) + n
    return {m for m in overruled(texts, marks) if held[m] >= linked.get(m, 0)}


def host(url):
    """Host of a url column, in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def _infer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A wrapper for the pages of each host of a partition."""
    known: dict[str, tuple[list, Volumes, set[str]]] = {}

    def out() -> pa.RecordBatch:
        rows = [(h, json.dumps([w, *v.parts()])) for h, (w, v, _) in known.items()]
        known.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["host", "wrapper"])

    for batch in batches:
        for part in slices(batch, "html"):
            for name, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                page = parse(html)
                found = stream(page)
                wrapper, volumes, seen = known.setdefault(name, (found, Volumes(), set()))
                mark = blake2b(json.dumps(found).encode(), digest_size=8).hexdigest()
                volumes.add(page, mark)
                if mark not in seen:
                    seen.add(mark)
                    known[name] = merged(wrapper, found), volumes, seen
            if len(known) > 2000:
                yield out()
    if known:
        yield out()


def _combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host, from rows sorted by host."""
    now: tuple[str, list, Volumes] | None = None
    rows: list[tuple[str, str]] = []
    for batch in batches:
        for name, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
            wrapper, *volumes = json.loads(text)
            if now and now[0] == name:
                now[2].merge(*volumes)
                now = name, merged(now[1], wrapper), now[2]
            else:
                if now:
                    rows.append((now[0], json.dumps([now[1], *now[2].parts()])))
                now = name, wrapper, Volumes(*volumes)
    if now:
        rows.append((now[0], json.dumps([now[1], *now[2].parts()])))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["host", "wrapper"])


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, region, kept) for every host of the pages' urls; the wrapper is JSON.

    ``kept`` has the marked paths that are article, a line each; it is null where all pages are the same.
    """
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = pages.select(host(F.col("url")).alias("host"), whole(F.col("html")).alias("html"))
    parts = own.mapInArrow(_infer, "host string, wrapper string")
    # A host of very many partitions is combined in two steps.
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    salted = salted.repartition(n, "host", "salt").sortWithinPartitions("host").select("host", "wrapper")
    some = salted.mapInArrow(_combine, "host string, wrapper string")
    some = some.repartition(n, "host").sortWithinPartitions("host")
    whole_hosts = some.mapInArrow(_combine, "host string, wrapper string")

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, kept = [], []
            for text in batch.column("wrapper").to_pylist():
                wrapper, sums, marks, page = json.loads(text)
                path, paths = region(wrapper, sums, marks)
                chosen.append(path)
                # What varies is known from pages that differ.
                kept.append(None if page else "\n".join(sorted(paths)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("wrapper"), pa.array(chosen, pa.string()), pa.array(kept, pa.string())],
                names=["host", "wrapper", "region", "kept"],
            )

    return whole_hosts.mapInArrow(choose, "host string, wrapper string, region string, kept string")


def extract_text(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept columns, all by default) and ``text`` of every page.

    A null or empty html has an empty text. Pages without a host share a wrapper. A
    page without its wrapper's region gives its article, main part or body. Repeated
    rows get the same text; an empty table gives no rows. Blocks are joined by a
    line end; white space in a block is one space, character references are decoded.
    """
    regions = written(infer_wrappers(pages), "wrappers").select("host", "region", "kept")
    sizes = F.octet_length("host") + F.octet_length("region") + F.coalesce(F.octet_length("kept"), F.lit(0))
    bytes_ = regions.agg(F.sum(sizes)).first()[0] or 0
    rows = pages.select(
        packed(pages, keep),
        whole(F.col("html")).alias("html"),
        host(F.col("url")).alias("host"),
    )
    joined = rows.join(F.broadcast(regions) if bytes_ <= BROADCAST_BYTES else regions.hint("merge"), "host", "left")
    joined = joined.select("row", "html", F.coalesce("region", F.lit("")).alias("region"), "kept")

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = map(main_text, *(batch.column(c).to_pylist() for c in ("html", "region", "kept")))
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.string())], names=["row", "text"])

    return joined.mapInArrow(by_slice(extract, "html"), with_row(joined, text="string"))
