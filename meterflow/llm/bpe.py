"""Byte-level BPE by merge replay over the words of a corpus, and back to bytes.

The words of many documents are merged together: an inverted index leads from a
merge to all positions of its token pair, merges are applied in rank order, and
only the neighbours of a merged pair are looked at again. Each distinct word is
merged once per task, as long as it is kept, whatever the number of documents that hold it.

The corpus of a replay is one slice of at most ``REPLAY_BYTES`` of texts, less the
words that the task still keeps: encoding needs no shuffle, and a lost executor
costs its own partitions only.
"""

from __future__ import annotations

from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm import vocabularies
from meterflow.llm.batches import by_slice
from meterflow.llm.common import packed, whole, with_row

RANKS = "byte_bpe_50k.tiktoken"
# A task keeps the ids of so many chunks of at most so many characters; then it starts anew.
KEPT_CHUNKS, KEPT_CHARS = 250_000, 48
# Up to so many places of one merge are gone through singly.
FEW = 12
# Texts of one replay, in bytes.
REPLAY_BYTES = 3 << 20


class MergeReplay:
    """Merges of a rank file, replayed over lists of words (byte strings)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # Every pair of tokens that makes a token, sorted, with the rank of what it makes.
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.merge = pairs
        self.codes = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[c] for c in self.codes.tolist()] + [-1], np.int32)

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the tokens that the pairs make, -1 where there is none."""
        codes = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.codes, codes)
        at[at == len(self.codes)] = 0
        return np.where(self.codes[at] == codes, self.made[at], -1)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word, as little-endian unsigned 32-bit integers."""
        get = self.ranks.get
        out = [b"" if (rank := get(w)) is None else rank.to_bytes(4, "little") for w in words]
        rest = [n for n, ids in enumerate(out) if not ids and words[n]]
        if not rest:
            return out
        ids, sizes, delicate = self._replay([words[n] for n in rest])
        ids, ends = ids.astype("<u4").tobytes(), 4 * np.cumsum(sizes)
        for n, start, end in zip(rest, (ends - 4 * sizes).tolist(), ends.tolist()):
            out[n] = ids[start:end]
        for i in delicate:
            out[rest[i]] = self._one_by_one(words[rest[i]])
        return out

    def _replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, set[int]]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        total, ends = int(lengths.sum()), np.cumsum(lengths)
        word = np.repeat(np.arange(len(words)), lengths)
        # The same memory as lists for single places and as numpy arrays for many.
        lists = [array("i", bytes(4 * total)) for _ in range(4)]
        token, after, before, pair = (np.frombuffer(x, np.int32) for x in lists)
        token_of, after_of, before_of, pair_of = lists
        token[:] = self.first[np.frombuffer(b"".join(words), np.uint8)]
        after[:] = np.arange(1, total + 1)
        after[ends - 1] = -1
        before[:] = np.arange(-1, total - 1)
        before[ends - lengths] = -1
        pair[:] = -1
        inner = np.flatnonzero(after >= 0)
        pair[inner] = self._merged(token[inner], token[inner + 1])

        # The inverted index: from the rank of a merge to the places of its left tokens.
        places = inner[pair[inner] >= 0]
        places = places[np.argsort(pair[places], kind="stable")]
        found, starts = np.unique(pair[places], return_index=True)
        index = dict(zip(found.tolist(), np.split(places, starts[1:])))
        added: dict[int, list[int]] = {}
        heap, delicate, merge = found.tolist(), set(), self.merge.get
        heapify(heap)

        def note(rank: int, at: int, now: int) -> None:
            if rank < now:
                delicate.add(int(word[at]))
            if rank in added:
                added[rank].append(at)
            else:
                added[rank] = [at]
                if rank not in index:
                    heappush(heap, rank)

        while heap:
            rank = heappop(heap)
            given, later = index.pop(rank, None), added.pop(rank, None)
            if given is None and later is None:
                continue
            if (0 if given is None else len(given)) + len(later or ()) <= FEW:
                for at in sorted((given.tolist() if given is not None else []) + (later or [])):
                    if pair_of[at] != rank:
                        continue
                    nxt = after_of[at]
                    far, near = after_of[nxt], before_of[at]
                    token_of[at], token_of[nxt], pair_of[nxt], after_of[at] = rank, -1, -1, far
                    made = -1
                    if far >= 0:
                        before_of[far] = at
                        made = merge(rank << 32 | token_of[far], -1)
                        if made >= 0:
                            note(made, at, rank)
                    pair_of[at] = made
                    if near >= 0:
                        pair_of[near] = made = merge(token_of[near] << 32 | rank, -1)
                        if made >= 0:
                            note(made, near, rank)
                continue
            at = np.array(later or [], np.int64) if given is None else np.concatenate([given, later or []])
            at = np.unique(at.astype(np.int64))
            at = at[pair[at] == rank]
            if not len(at):
                continue
            chained = np.flatnonzero(after[at[:-1]] == at[1:]) + 1
            if len(chained):
                # In a chain of overlapping pairs every second one goes, from the left.
                begin = np.ones(len(at), bool)
                begin[chained] = False
                begin = np.flatnonzero(begin)
                order = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
                at = at[order % 2 == 0]
            nxt = after[at]
            far = after[nxt]
            token[at], token[nxt], pair[nxt], after[at], pair[at] = rank, -1, -1, far, -1
            some = far >= 0
            left, right = at[some], far[some]
            before[right] = left
            pair[left] = made = self._merged(np.full(len(left), rank), token[right])
            some = made >= 0
            fresh, ranks = left[some], made[some]
            near = before[at]
            some = near >= 0
            near = near[some]
            pair[near] = made = self._merged(token[near], token[at[some]])
            some = made >= 0
            fresh, ranks = np.concatenate([fresh, near[some]]), np.concatenate([ranks, made[some]])
            for made_rank, place in zip(ranks.tolist(), fresh.tolist()):
                note(made_rank, place, rank)
        alive = token >= 0
        return token[alive].copy(), np.bincount(word[alive], minlength=len(words)), delicate

    def _one_by_one(self, word: bytes) -> bytes:
        """A word in which a merge makes way for one of lower rank: lowest rank first, leftmost first."""
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        while len(ids) > 1:
            ranks = [self.merge.get(a << 32 | b, -1) for a, b in zip(ids, ids[1:])]
            lowest = min((r for r in ranks if r >= 0), default=None)
            if lowest is None:
                break
            at = ranks.index(lowest)
            ids[at : at + 2] = [lowest]
        return np.array(ids, "<u4").tobytes()


class Codec:
    """Encodes and decodes texts; keeps the ids of chunks between calls.

    A space before a character that isn't white space always starts a new match of
    the pattern, so texts are cut there and each chunk is encoded on its own.
    """

    def __init__(self, file: str):
        import re

        import public_tokenizers
        import regex

        self.replay = MergeReplay(vocabularies.ranks(file))
        # The pattern's \s is the White_Space property.
        pattern = public_tokenizers.PATTERN
        pattern = pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
        self.pattern = regex.compile(pattern)
        self.cut = re.compile(f" (?=[^{vocabularies.SPACES}])")
        self.kept: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        size = max(self.replay.bytes) + 1
        self.tokens = [self.replay.bytes.get(i, b"") for i in range(size)]

    def _words(self, chunk: str) -> list[str]:
        """Matches of the pattern; most chunks are a space and letters, perhaps with a mark after them."""
        if chunk[:1] == " ":
            if chunk[1:].isalpha():
                return [chunk]
            if chunk[-1] in ".,;:!?" and chunk[1:-1].isalpha():
                return [chunk[:-1], chunk[-1]]
        return self.pattern.findall(chunk)

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Little-endian ids of chunks; the first chunk of a text lacks the space that others have lost."""
        found = [self._words(chunk) for chunk in chunks]
        words = self.words
        if len(words) > KEPT_CHUNKS:
            words.clear()
        new = list({word for each in found for word in each if word not in words})
        for word, ids in zip(new, self.replay.replay([w.encode() for w in new])):
            words[word] = ids
        out = {chunk: b"".join([words[w] for w in each]) for chunk, each in zip(chunks, found)}
        for word in new:
            if len(word) > KEPT_CHARS:
                del words[word]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text, as little-endian unsigned 32-bit integers."""
        if len(self.kept) > KEPT_CHUNKS:
            self.kept.clear()
        kept = self.kept
        # Chunks after the first stand without their space; the first one is put in as a whole.
        cut = [self.cut.split(text) for text in texts]
        heads = [parts[0] for parts in cut]
        new = [c for c in {c for parts in cut for c in parts[1:]} if c not in kept]
        head_ids = self._learn(list(set(heads)))
        long = {}
        for chunk, ids in self._learn([" " + c for c in new]).items():
            (kept if len(chunk) <= KEPT_CHARS else long)[chunk[1:]] = ids
        if long:
            get = lambda c: kept[c] if c in kept else long[c]
        else:
            get = kept.__getitem__
        return [head_ids[parts[0]] + b"".join(map(get, parts[1:])) for parts in cut]

    def forget(self) -> None:
        """Drop what is kept: a worker that goes on to other work shouldn't hold it."""
        self.kept, self.words = {}, {}

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[str, Codec] = {}


def codec(file: str) -> Codec:
    if file not in _CODECS:
        _CODECS[file] = Codec(file)
    return _CODECS[file]


def encode_texts(documents: DataFrame, keep: list[str] | None = None, ranks: str | None = None) -> DataFrame:
    """``row`` (the kept columns, all by default), ``n_tokens``, ``ids`` and ``decoded``.

    ``ids`` are the token ids of the whole text as little-endian unsigned 32-bit
    integers, ``decoded`` the bytes that they stand for. A null text is empty and
    has no tokens. Each row is encoded by itself: repeated rows get the same ids,
    an empty table gives no rows. ``ranks`` is the path of the rank file.
    """
    file = ranks or vocabularies.path(RANKS)
    rows = documents.select(packed(documents, keep), "text")
    rows = rows.select("row", whole(F.col("text")).alias("text"))

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool = codec(file)
        ids = tool.encode(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array(ids, pa.binary()),
                pa.array([tool.decode(i) for i in ids], pa.binary()),
            ],
            names=["row", "n_tokens", "ids", "decoded"],
        )

    schema = with_row(rows, n_tokens="long", ids="binary", decoded="binary")
    return rows.mapInArrow(by_slice(encode, most=REPLAY_BYTES, after=lambda: codec(file).forget()), schema)
