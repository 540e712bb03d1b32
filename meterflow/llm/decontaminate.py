"""Benchmark items inside documents, found by the q-gram lemma and verified by alignment.

Text is compared as letters and digits in lower case with single spaces between. An
item of m characters that occurs with at most e edits keeps m - q + 1 - q e of its
q-grams, and they lie on neighbouring diagonals: their place in the document less
their place in the item varies by e at most. So shared q-grams are counted in
overlapping bands of 2 (e + 1) diagonals, bands with fewer than the lemma's number
are dropped, and the rest is verified by an alignment within the band.

Where parts are asked for, items of fewer than 24 characters are looked for unchanged, from
word border to word border, and long items by overlapping windows as well, each
with a band of its own.

The benchmark is the stated query set. It is read in blocks of bounded size, and
each block is held against all documents.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm.batches import by_slice
from meterflow.llm.common import packed, whole, with_row, written

GRAM, EDITS = 10, 0.08
# Items of fewer characters are looked for unchanged, where parts are asked for, else not at all.
LEAST_CHARS = 24
# Windows of long items, and how far apart they begin.
WINDOW, WINDOW_STEP = 100, 50
# Code points of scripts that set no spaces between words.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xABFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
# Characters of the items that one pass over the documents looks for.
BLOCK_CHARS = 4 << 20
_HASH = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


def _letters() -> np.ndarray:
    """By code point: the letter or digit in lower case, or 0 for all else."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalnum() or unicodedata.category(char)[0] == "M":
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


_TABLE: list[np.ndarray] = []


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the compared form, and the place of each in the text."""
    if not _TABLE:
        _TABLE.append(_letters())
    codes = _TABLE[0][np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    codes = np.where(codes == 0, np.uint32(32), codes)
    blank = codes == 32
    # One space between words, none at the ends.
    kept = ~blank
    kept[1:] |= blank[1:] & ~blank[:-1]
    if len(kept) and blank[0]:
        kept[0] = False
    at = np.flatnonzero(kept)
    if len(at) and blank[at[-1]]:
        at = at[:-1]
    return codes[at], at


def edit_budget(size: int, share: float = EDITS, gram: int = GRAM) -> int:
    """Edits allowed in an item: a share of its characters, and few enough for the lemma to ask for a q-gram."""
    return max(0, min(int(size * share), (size - gram) // gram))


def grams(codes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the q-gram at each place."""
    if len(codes) < gram:
        return np.empty(0, np.uint64)
    out = np.zeros(len(codes) - gram + 1, np.uint64)
    wide = codes.astype(np.uint64)
    with np.errstate(over="ignore"):
        power, size, done = [(wide, 1)], 1, 0
        while size * 2 <= gram:
            h = power[-1][0]
            power.append((h[: len(h) - size] * np.uint64(pow(int(_HASH), size, 1 << 64)) + h[size:], size * 2))
            size *= 2
        for h, size in reversed(power):
            if done + size <= gram:
                out = out * np.uint64(pow(int(_HASH), size, 1 << 64)) + h[done : done + len(out)]
                done += size
        return out ^ (out >> np.uint64(31))


class Items:
    """The q-grams of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], gram: int, share: float, parts: bool = False):
        self.gram = gram
        self.ids, self.codes, hashes, owners, places = [], [], [], [], []
        # By item: the place among the given ones, and the characters that a window leaves out.
        self.rows, self.missing = [], []
        self.short: dict[int, dict[bytes, list[int]]] = {}
        self.given = [item_id for item_id, _ in items]
        for row, (_, text) in enumerate(items):
            codes, _ = normal(text)
            if len(codes) < LEAST_CHARS:
                if parts and len(codes):
                    self.short.setdefault(len(codes), {}).setdefault(codes.tobytes(), []).append(row)
                continue
            for piece in [codes, *(windows(codes) if parts else ())]:
                found = grams(piece, gram)
                hashes.append(found)
                owners.append(np.full(len(found), len(self.ids)))
                places.append(np.arange(len(found)))
                self.ids.append(self.given[row])
                self.codes.append(piece)
                self.rows.append(row)
                self.missing.append(len(codes) - len(piece))
        self.short_hashes = {
            n: np.unique(np.concatenate([grams(np.frombuffer(c, np.uint32), n) for c in found]))
            for n, found in self.short.items()
        }
        empty = np.empty(0, np.int64)
        hashes = np.concatenate([np.empty(0, np.uint64), *hashes])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.owners = np.concatenate([empty, *owners])[order]
        self.places = np.concatenate([empty, *places])[order]
        self.sizes = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.array([edit_budget(n, share, gram) for n in self.sizes], np.int64)
        self.need = self.sizes - gram + 1 - gram * self.edits
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.hashes >> np.uint64(20)).astype(np.int64) & ((1 << _BITS) - 1)] = True

    def regions(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, lowest diagonal) of the bands that share enough q-grams with the text."""
        found = grams(codes, self.gram)
        at = np.flatnonzero(self.seen[(found >> np.uint64(20)).astype(np.int64) & ((1 << _BITS) - 1)])
        if not len(at):
            return
        low = np.searchsorted(self.hashes, found[at], "left")
        number = np.searchsorted(self.hashes, found[at], "right") - low
        total = int(number.sum())
        if not total:
            return
        ends = np.cumsum(number)
        entry = np.arange(total) - np.repeat(ends - number - low, number)
        place = np.repeat(at, number)
        owner, inside = self.owners[entry], self.places[entry]
        # A band begins at every (e + 1)th diagonal and is twice as wide, so an
        # alignment with e edits lies wholly in one of them.
        width = self.edits[owner] + 1
        band = (place - inside + self.sizes[owner]) // width
        # An item's q-gram counts once in a band, however often the text has it.
        longest, bands = int(self.sizes.max()), int(band.max()) + 2
        key = ((owner * bands + band + 1) * longest + inside).ravel()
        key = np.unique(np.concatenate([key, key - longest])) // longest
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        shared, key = np.diff(np.append(first, len(key))), key[first]
        enough = key[shared >= self.need[key // bands]]
        for item, b in zip((enough // bands).tolist(), (enough % bands - 1).tolist()):
            yield item, b * (int(self.edits[item]) + 1) - int(self.sizes[item])

    def matches(self, codes: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """Best (edits, start, end) of each item in the text, places in the compared form."""
        best: dict[int, tuple[int, int, int]] = {}
        for item, low in self.regions(codes):
            edits = int(self.edits[item])
            if item in best and best[item][0] == 0:
                continue
            found = exact(self.codes[item], codes, low, 2 * (edits + 1)) or align(self.codes[item], codes, low, 2 * (edits + 1), edits)
            if found and (item not in best or found < best[item]):
                best[item] = found
        return best


    def leaks(self, codes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(place among the given items, edits, start, end), whole items before windows of them.

        A window's edits count the characters of the item outside of it as well.
        """
        best: dict[int, tuple[int, int, int, int]] = {}
        for item, (edits, start, end) in self.matches(codes).items():
            row, missing = self.rows[item], self.missing[item]
            match = missing, edits + missing, start, end
            if row not in best or match < best[row]:
                best[row] = match
        found = {row: match[1:] for row, match in best.items()}
        found.update(self._short_ones(codes))
        for row in sorted(found):
            yield row, *found[row]

    def _short_ones(self, codes: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """First places of the short items that stand unchanged between word borders."""
        found: dict[int, tuple[int, int, int]] = {}
        if not self.short:
            return found
        border = borders(codes)
        for size, items in self.short.items():
            if len(codes) < size:
                continue
            both = border[: len(codes) - size + 1] & border[size:]
            for at in np.flatnonzero(both & np.isin(grams(codes, size), self.short_hashes[size])).tolist():
                for row in items.get(codes[at : at + size].tobytes(), ()):
                    found.setdefault(row, (0, at, at + size))
        return found


def windows(codes: np.ndarray) -> list[np.ndarray]:
    """Overlapping windows of an item: any part of it of 150 characters or more holds one of them."""
    if len(codes) <= WINDOW:
        return []
    last = len(codes) - WINDOW
    return [codes[at : at + WINDOW] for at in sorted({*range(0, last, WINDOW_STEP), last})]


def borders(codes: np.ndarray) -> np.ndarray:
    """By place, the end included: whether a word may begin or end there."""
    loose = codes == 32
    for low, high in _UNSPACED:
        loose |= (codes >= low) & (codes <= high)
    out = np.ones(len(codes) + 1, bool)
    out[1:-1] = loose[1:] | loose[:-1]
    return out


def exact(item: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[int, int, int] | None:
    """The first place on the diagonals where the item stands unchanged."""
    begin = max(0, low)
    for at in np.flatnonzero(text[begin : max(0, low + width)] == item[0]).tolist():
        if np.array_equal(text[begin + at : begin + at + len(item)], item):
            return 0, begin + at, begin + at + len(item)
    return None


def align(item: np.ndarray, text: np.ndarray, low: int, width: int, budget: int) -> tuple[int, int, int] | None:
    """Fewest edits, start and end of the item in the text along ``width`` diagonals from ``low`` on; None above the budget.

    Cell (i, d) is the cost of the first i characters of the item against the text
    up to place i + low + d; the text before and after the match costs nothing.
    """
    far = budget + 1
    step = np.arange(width)
    end = low + step
    cost = np.where((end >= 0) & (end <= len(text)), 0, far)
    start = end.copy()
    above, start_above = np.full(width, far + 1), np.zeros(width, np.int64)
    padded = np.full(len(item) + width + 1, np.iinfo(np.uint32).max, np.uint32)
    begin, stop = max(0, low), min(len(text), low + len(item) + width)
    if stop > begin:
        padded[begin - low : stop - low] = text[begin:stop]
    for i in range(1, len(item) + 1):
        end = i + low + step
        diagonal = cost + (padded[i - 1 : i - 1 + width] != item[i - 1])
        # Leaving out a character of the item: the same place in the text, one diagonal down.
        above[:-1], start_above[:-1] = cost[1:] + 1, start[1:]
        from_above = above < diagonal
        now = np.where(from_above, above, diagonal)
        start = np.where(from_above, start_above, start)
        now = np.where((end >= 0) & (end <= len(text)), now, far)
        # A character of the text too many: the best of all cells to the left, one edit for each step.
        reached = now - step
        least = np.minimum.accumulate(reached)
        source = np.maximum.accumulate(np.where(reached == least, step, 0))
        cost, start = np.minimum(least + step, far), start[source]
        if cost.min() >= far:
            return None
    at = int(np.argmin(cost))
    return int(cost[at]), int(start[at]), int(len(item) + low + at)


_BLOCKS: dict[tuple, Items] = {}


def _blocks(benchmark: DataFrame, block_chars: int) -> tuple[DataFrame, int]:
    """(item_id, text, block) of the different items, written once, and the number of blocks.

    Items are dealt by their hash to as many blocks as make about ``block_chars`` characters each.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole(F.col("text")).alias("text"))
    items = items.distinct()
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count(F.lit(1))).first()
    count = max(1, -(-total[0] // block_chars)) if total[1] else 0
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, count))).cast("int"))
    return written(dealt, "items"), count


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    keep: list[str] | None = None,
    gram: int = GRAM,
    share: float = EDITS,
    block_chars: int = BLOCK_CHARS,
    parts: bool = False,
) -> DataFrame:
    """``row`` (the kept columns, all by default) and ``leaks`` of every document.

    ``leaks`` is an array of (item_id, edits, start, end): each item that the whole
    text holds with at most ``share`` of its characters edited, at its best place, in
    code points of the text, the end exclusive. Case, punctuation and white space
    don't count. With ``parts``, items of fewer than 24 compared characters are found
    where they stand unchanged between word borders, and items of more than 100 where
    a window of 100 of their characters, every 50th, is held with its share of edits;
    ``edits`` has the characters outside the window then, start and end are the window's.
    Without, neither is found. Null or empty items are never found; equal items are
    found each. Leaks are in the order of their items' ids. A null text is empty.
    Repeated rows get the same leaks; an empty table gives no rows, and an empty
    benchmark no leaks.
    """
    rows = documents.select(
        packed(documents, keep),
        whole(F.col("text")).alias("text"),
    )
    blocks, count = _blocks(benchmark, block_chars)
    leak = T.StructType().add("item_id", "long").add("edits", "integer").add("start", "integer").add("end", "integer")
    out = rows.withColumn("leaks", F.array().cast(T.ArrayType(leak)))
    schema = with_row(rows, text="string", leaks=T.ArrayType(leak))
    for number in range(count):
        # A block has about block_chars characters, and the whole of its longest item.
        items = [tuple(r) for r in blocks.filter(F.col("block") == number).select("item_id", "text").collect()]
        out = out.mapInArrow(
            by_slice(_finder(sorted(items, key=lambda x: (x[0] is None, x)), gram, share, parts)), schema
        )
    return out.select("row", F.sort_array("leaks").alias("leaks"))


def _finder(items: list[tuple[int, str]], gram: int, share: float, parts: bool):
    held = _sent(items)

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        block = _block(held.value, gram, share, parts)
        leaks = []
        for text, before in zip(batch.column("text").to_pylist(), batch.column("leaks").to_pylist()):
            codes, at = normal(text)
            found = [
                {
                    "item_id": block.given[row],
                    "edits": edits,
                    "start": int(at[start]) if start < len(at) else len(text),
                    "end": int(at[end - 1]) + 1 if end else 0,
                }
                for row, edits, start, end in block.leaks(codes)
            ]
            leaks.append(before + found)
        kind = pa.list_(
            pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
        )
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("text"), pa.array(leaks, kind)], names=["row", "text", "leaks"]
        )

    return find


def _sent(items: list[tuple[int, str]]):
    """The items of a block, sent to each executor once."""
    from pyspark.sql import SparkSession

    return SparkSession.active().sparkContext.broadcast(items)


def _block(items: list[tuple[int, str]], gram: int, share: float, parts: bool) -> Items:
    key = (hash(tuple(items)), len(items), gram, share, parts)
    if key not in _BLOCKS:
        if len(_BLOCKS) > 4:
            _BLOCKS.clear()
        _BLOCKS[key] = Items(items, gram, share, parts)
    return _BLOCKS[key]
