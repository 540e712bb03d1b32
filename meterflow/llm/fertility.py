"""Quality rules: counts of words, symbols and repetition, and tokeniser fertility.

Public vocabularies measure each text: characters per token and the entropy of its
tokens under a byte-level vocabulary, the share of byte-fallback tokens under a
vocabulary of pieces. Bands per language, or per script where the language has
none, say which values are accepted. Words are measured as they stand after a
blank; each distinct word is encoded once per worker.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm import vocabularies
from meterflow.llm.batches import by_slice
from meterflow.llm.common import BLANKS, packed, whole, with_row

RANKS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
SYMBOLS = b"#*$%&|<>"
_ODD_BLANK = re.compile(r"\s")
WINDOW = 5
KEPT_WORDS = 200_000


@dataclass(frozen=True)
class Band:
    """Accepted values. Entropy is in bits per token, held against what so many tokens can have."""

    chars_per_token: tuple[float, float]
    fallback_share: float
    entropy_share: float


# For the four languages: 1 % below the least value that a document of good quality has, among the labelled documents of
# the sample tables (of 64 tokens or more: 531 de, 2,261 en, 543 fr, 346 es), and far above the greatest one, 2.53.
LATIN = Band((1.2, 9.0), 0.1, 0.62)
# Scripts that the vocabularies spell out in bytes have wider bands.
SPELLED_OUT = Band((0.3, 6.0), 1.0, 0.35)
BANDS = {
    "en": Band((1.965, 6.0), 0.1, 0.76),
    "de": Band((1.834, 6.0), 0.1, 0.744),
    "fr": Band((1.66, 6.0), 0.1, 0.736),
    "es": Band((1.626, 6.0), 0.1, 0.716),
    "LATIN": LATIN,
    "GREEK": Band((0.4, 6.0), 0.6, 0.4),
    "CYRILLIC": Band((0.4, 6.0), 0.6, 0.4),
    "HEBREW": SPELLED_OUT,
    "ARABIC": SPELLED_OUT,
    "DEVANAGARI": SPELLED_OUT,
    "THAI": SPELLED_OUT,
    # A character may take one token or, in bytes, three.
    "CJK": Band((0.3, 3.0), 1.0, 0.35),
    "HIRAGANA": Band((0.3, 3.0), 1.0, 0.35),
    "KATAKANA": Band((0.3, 3.0), 1.0, 0.35),
    "HANGUL": Band((0.3, 3.0), 1.0, 0.35),
    "": Band((0.2, 9.0), 1.0, 0.3),
}
# Texts with fewer tokens say too little about entropy and about characters per token.
LEAST_TOKENS = 64


def script(text: str) -> str:
    """First word of the Unicode name of the commonest kind of letter, for instance LATIN."""
    codes, counts = np.unique(np.frombuffer(text.encode("utf-32-le", "replace"), "<u4"), return_counts=True)
    found: dict[str, int] = {}
    for code, count in zip(codes.tolist(), counts.tolist()):
        if chr(code).isalpha():
            name = unicodedata.name(chr(code), "").partition(" ")[0]
            found[name] = found.get(name, 0) + count
    return max(sorted(found), key=found.get) if found else ""


class Meter:
    """Measures texts; keeps the tokens of words between calls."""

    def __init__(self, ranks: str, pieces: str):
        self.encoding, self.pieces = vocabularies.rank_encoding(ranks), vocabularies.pieces(pieces)
        tokens = vocabularies.ranks(ranks)
        self.leads = np.zeros(max(tokens.values()) + 1, bool)
        self.leads[[rank for token, rank in tokens.items() if token[:1] == b" "]] = True
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.tokens = np.empty(0, np.int32)
        self.start = self.size = self.n_pieces = self.n_bytes = np.empty(0, np.int64)

    def _learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.index]
        if not new:
            return
        # Blanks beyond ASCII may stand in a word. The vocabulary has tokens that run from them over the space before
        # the next word, so such words are encoded alone, after all others.
        new.sort(key=lambda w: _ODD_BLANK.search(w.decode("utf-8", "replace")) is not None)
        texts = [w.decode("utf-8", "replace") for w in new]
        plain = next((i for i, t in enumerate(texts) if _ODD_BLANK.search(t)), len(texts))
        # No other word has a space in it, so a token that begins with one begins a word.
        tokens = np.array(self.encoding.encode_ordinary("".join([f" {t}" for t in texts[:plain]])), np.int32)
        begins = np.flatnonzero(self.leads[tokens]) if plain else np.empty(0, np.int64)
        if len(begins) != plain:
            raise ValueError("a word has a space in it")
        alone = [self.encoding.encode_ordinary(f" {t}") for t in texts[plain:]]
        lengths = np.fromiter(map(len, alone), np.int64, len(alone))
        begins = np.append(begins, len(tokens) + np.cumsum(lengths) - lengths).astype(np.int64)
        tokens = np.append(tokens, np.fromiter(chain.from_iterable(alone), np.int32, int(lengths.sum())))
        size = np.diff(np.append(begins, len(tokens)))
        pieces = self.pieces.encode(texts, num_threads=1)
        n_pieces = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.fromiter(chain.from_iterable(pieces), np.int64, int(n_pieces.sum()))
        which = np.repeat(np.arange(len(new)), n_pieces)
        n_bytes = np.bincount(which, self.is_byte[flat], len(new)).astype(np.int64)
        start = len(self.tokens) + begins
        self.tokens = np.concatenate([self.tokens, tokens])
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])
        self.n_pieces = np.concatenate([self.n_pieces, n_pieces])
        self.n_bytes = np.concatenate([self.n_bytes, n_bytes])
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))

    def measure(self, texts: list[str]) -> list[dict]:
        raw = [t.encode("utf-8", "replace") for t in texts]
        words = [r.split() for r in raw]
        if len(self.index) > KEPT_WORDS:
            self.forget()
        self._learn({w for each in words for w in each})
        return [self._one(*x) for x in zip(texts, raw, words)]

    def _one(self, text: str, raw: bytes, words: list[bytes]) -> dict:
        ids = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        word_chars = len(text) - (len(raw) - len(raw.translate(None, BLANKS.encode())))
        size, n_tokens = self.size[ids], int(self.size[ids].sum())
        out = {
            "n_words": len(words),
            "word_chars": word_chars,
            "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)),
            "n_dup_lines": dup_lines(text),
            "n_repeat_words": repeat_words(ids),
            "n_tokens": n_tokens,
            "chars_per_token": 0.0,
            "fallback_share": 0.0,
            "token_entropy": 0.0,
        }
        if n_tokens:
            ends = np.cumsum(size)
            places = np.arange(n_tokens) + np.repeat(self.start[ids] - (ends - size), size)
            seen = np.bincount(self.tokens[places], minlength=0)
            seen = seen[seen > 0]
            out["chars_per_token"] = word_chars / n_tokens
            out["fallback_share"] = float(self.n_bytes[ids].sum() / self.n_pieces[ids].sum())
            out["token_entropy"] = float(np.log2(n_tokens) - (seen * np.log2(seen)).sum() / n_tokens)
        return out


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    seen, count = set(), 0
    for line in lines:
        if line.strip(BLANKS):
            count += line in seen
            seen.add(line)
    return count


def repeat_words(ids: np.ndarray) -> int:
    """Words inside windows of five words that the text has twice or more, the first included."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    distinct, ids = np.unique(ids, return_inverse=True)
    base = len(distinct)
    if base**WINDOW < 2**63:
        codes = np.zeros(n, np.int64)
        for i in range(WINDOW):
            codes = codes * base + ids[i : i + n]
    else:
        # Ranks of longer and longer windows, each from two shorter ones.
        codes = ids[:n]
        for i in range(1, WINDOW):
            _, codes = np.unique(codes * base + ids[i : i + n], return_inverse=True)
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    if not same.any():
        return 0
    repeated = np.zeros(n, bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    covered = np.zeros(n + WINDOW, np.int64)
    at = np.flatnonzero(repeated)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WINDOW, -1)
    return int((np.cumsum(covered) > 0).sum())


def accepted(m: dict, text: str, lang: str | None) -> bool:
    """Whether all measures lie in the band of the language, or else of the text's script."""
    band = BANDS.get(lang or "") if lang else None
    if band is None:
        band = BANDS.get(script(text), BANDS[""])
    return not failures(m, band)


def failures(m: dict, band: Band) -> list[str]:
    """The measures that lie outside a band."""
    low, high = band.chars_per_token
    n, out = m["n_tokens"], []
    if m["fallback_share"] > band.fallback_share:
        out.append("fallback_share")
    if n < LEAST_TOKENS:
        # Few tokens: only what no text of any language has.
        low, high = BANDS[""].chars_per_token
    if not low <= m["chars_per_token"] <= high:
        out.append("chars_per_token")
    if n >= LEAST_TOKENS and m["token_entropy"] < band.entropy_share * min(np.log2(n), 8.0):
        out.append("token_entropy")
    return out


MEASURES = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "n_tokens": pa.int64(),
    "chars_per_token": pa.float64(),
    "fallback_share": pa.float64(),
    "token_entropy": pa.float64(),
}
_METERS: dict[tuple, Meter] = {}


def meter(*files: str) -> Meter:
    if files not in _METERS:
        _METERS[files] = Meter(*files)
    return _METERS[files]


def rate_documents(
    documents: DataFrame, keep: list[str] | None = None, ranks: str | None = None, pieces: str | None = None
) -> DataFrame:
    """``row`` (the kept columns, all by default), the measures, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ten words, or more than a fifth of the words inside
    repeated windows of five words. ``kept`` is false then, else whether the
    measures lie in the bands. A null text is empty and fails; a null or unknown
    ``lang``, or a table without that column, is judged by script. Repeated rows get the same
    result; an empty table gives no rows. ``ranks`` and ``pieces`` are paths of
    vocabulary files.
    """
    files = ranks or vocabularies.path(RANKS), pieces or vocabularies.path(PIECES)
    lang = F.col("lang").cast("string") if "lang" in documents.columns else F.lit(None).cast("string")
    rows = documents.select(
        packed(documents, keep),
        whole(F.col("text")).alias("text"),
        lang.alias("lang"),
    )

    def rate(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        found = meter(*files).measure(texts)
        failed = [m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"] for m in found]
        kept = [
            not f and accepted(m, t, lang)
            for f, m, t, lang in zip(failed, found, texts, batch.column("lang").to_pylist())
        ]
        measures = [pa.array([m[name] for m in found], kind) for name, kind in MEASURES.items()]
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), *measures, pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_())],
            names=["row", *MEASURES, "base_failed", "kept"],
        )

    kinds = {name: "long" if kind == pa.int64() else "double" for name, kind in MEASURES.items()}
    return rows.mapInArrow(by_slice(rate, after=lambda: meter(*files).forget()), with_row(rows, **kinds, base_failed="boolean", kept="boolean"))
