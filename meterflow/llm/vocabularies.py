"""Vocabulary files of public tokenizers, read once per process. The path is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Code points that some library may take for white space, for use in a character class.
SPACES = r"\t-\r\x1c-\x20\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u2060\u3000\ufeff"


def path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# What this process has read, by kind and file.
_READ: dict[tuple[str, str], object] = {}


def _once(kind: str, file: str, read: Callable[[], object]):
    if (kind, file) not in _READ:
        _READ[kind, file] = read()
    return _READ[kind, file]


def ranks(file: str) -> dict[bytes, int]:
    def read() -> dict[bytes, int]:
        with open(file, "rb") as lines:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}

    return _once("ranks", file, read)


def rank_encoding(file: str):
    def read():
        import public_tokenizers
        import tiktoken

        return tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(file), special_tokens={}
        )

    return _once("encoding", file, read)


def pieces(file: str):
    def read():
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=file)

    return _once("pieces", file, read)


def library(file: str):
    def read():
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(file)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    return _once("library", file, read)
