"""Token counts as the tokenizers library gives them, for documents of any length.

Huge documents are encoded in overlapping chunks with offsets. Two neighbours are
spliced at a place of their overlap that both encodings have as a token boundary
and that is proven stable: a space before a character that is surely not white
space and can't begin a special token starts a new word whatever stands around it.
Where an overlap has no such place it is widened, up to the end of the document.

Shorter documents are cut at the same proven boundaries, and the library encodes
each distinct piece once per worker.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm import vocabularies
from meterflow.llm.batches import by_slice
from meterflow.llm.common import packed, whole, with_row

VOCABULARY = "byte_bpe_50k.json"
HUGE = 32_768  # characters from which a document is encoded in overlapping chunks
CHUNK, OVERLAP = 16_384, 256
KEPT_PIECES, KEPT_CHARS = 300_000, 48


class Counter:
    """Counts tokens with a tokenizer file of the library."""

    def __init__(self, file: str, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.tokenizer = vocabularies.library(file)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        first = "".join(sorted({re.escape(t[0]) for t in added if t}))
        self.stable = re.compile(f" (?=[^{vocabularies.SPACES}{first}])")
        self.huge, self.chunk, self.overlap = huge, chunk, overlap
        self.kept: dict[str, int] = {}
        self.widened = 0

    def _sizes(self, texts: list[str]) -> list[int]:
        return list(map(len, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)))

    def count(self, texts: list[str]) -> list[int]:
        short = [t for t in texts if len(t) < self.huge]
        counts = iter(self._count_short(short))
        return [next(counts) if len(t) < self.huge else self.count_huge(t) for t in texts]

    def _count_short(self, texts: list[str]) -> list[int]:
        if len(self.kept) > KEPT_PIECES:
            self.kept.clear()
        kept = self.kept
        cut = [self.stable.split(text) for text in texts]
        heads = self._sizes([parts[0] for parts in cut])
        new = [p for p in {p for parts in cut for p in parts[1:]} if p not in kept]
        long = {}
        for piece, size in zip(new, self._sizes([" " + p for p in new])):
            (kept if len(piece) <= KEPT_CHARS else long)[piece] = size
        if long:
            get = lambda p: kept[p] if p in kept else long[p]
        else:
            get = kept.__getitem__
        return [head + sum(map(get, parts[1:])) for head, parts in zip(heads, cut)]

    def count_huge(self, text: str) -> int:
        total, start, spliced = 0, 0, 0
        starts = self._starts(text, 0, min(len(text), self.chunk + self.overlap))
        while True:
            border, overlap = start + self.chunk, self.overlap
            if border >= len(text):
                return total + sum(s >= spliced for s in starts)
            end = min(len(text), border + overlap)
            following = self._starts(text, border, min(len(text), border + self.chunk + self.overlap))
            splice = self._common(text, border, end, starts, following)
            while splice is None and end < len(text):
                overlap *= 2
                self.widened += 1
                end = min(len(text), border + overlap)
                starts = self._starts(text, start, end)
                following = self._starts(text, border, min(len(text), border + max(self.chunk, overlap) + self.overlap))
                splice = self._common(text, border, end, starts, following)
            if splice is None:
                return total + sum(s >= spliced for s in starts)
            total += sum(spliced <= s < splice for s in starts)
            start, spliced, starts = border, splice, following
            if splice >= border + self.chunk:
                # The overlap was widened beyond the next border: go on from the splice.
                start = splice
                starts = self._starts(text, start, min(len(text), start + self.chunk + self.overlap))

    def _starts(self, text: str, start: int, end: int) -> list[int]:
        """Offsets in the text at which the tokens of text[start:end] begin."""
        encoded = self.tokenizer.encode(text[start:end], add_special_tokens=False)
        return [start + a for a, _ in encoded.offsets]

    def _common(self, text: str, border: int, end: int, left: list[int], right: list[int]) -> int | None:
        """First proven boundary of the overlap that both encodings have."""
        both = set(left) & set(right)
        # The character after the space has to be in the overlap too.
        for match in self.stable.finditer(text, border + 1, end):
            if match.start() + 1 < end and match.start() in both:
                return match.start()
        return None


_COUNTERS: dict[tuple, Counter] = {}


def counter(*args) -> Counter:
    if args not in _COUNTERS:
        _COUNTERS[args] = Counter(*args)
    return _COUNTERS[args]


def count_tokens(
    documents: DataFrame,
    keep: list[str] | None = None,
    vocabulary: str | None = None,
    huge: int = HUGE,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``row`` (the kept columns, all by default), ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text.

    Special strings inside texts count as the library's default has it, and no
    special tokens are added. A null text is empty: no bytes, no tokens. Repeated
    rows get the same counts; an empty table gives no rows. ``vocabulary`` is the
    path of a tokenizer file with byte-level words.
    """
    file = vocabulary or vocabularies.path(VOCABULARY)
    rows = documents.select(packed(documents, keep), "text")
    rows = rows.select("row", whole(F.col("text")).alias("text"))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text")
        counts = counter(file, huge, chunk, overlap).count(texts.to_pylist())
        sizes = pc.cast(pc.binary_length(texts), pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), sizes, pa.array(counts, pa.int64())], names=["row", "n_bytes", "n_tokens"]
        )

    forget = lambda: counter(file, huge, chunk, overlap).kept.clear()
    return rows.mapInArrow(by_slice(count, after=forget), with_row(rows, n_bytes="long", n_tokens="long"))
