"""Token ids of a public byte-level vocabulary.

The vocabulary file is read where it lies, by path, once in every Python worker.
``tiktoken`` encodes, about five times as fast as the library the file is meant for; both
give the same ids (tests compare them). Its split fails on about a million white-space characters
in a row, so a text with a run above ``SAFE`` goes to the file's own library, whole. Special tokens' strings are ordinary text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache

import tiktoken
from tokenizers import Tokenizer

# Fixed value: how byte-level vocabularies of this kind split text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SAFE = 100_000  # white-space characters in a row that are left to tiktoken; 500,000 still work there
_SPACE = re.compile(r"\s+")


def bytes_of_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in the file: itself, or for the others the signs from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    """The encoder of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    special = {t["content"] for t in given["added_tokens"]}
    signs = bytes_of_signs()
    ranks = {bytes(signs[c] for c in word): i for word, i in given["model"]["vocab"].items() if word not in special}
    return tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def library(path: str) -> Tokenizer:
    """The encoder of the library that the file is meant for."""
    known = Tokenizer.from_file(path)
    known.encode_special_tokens = True
    return known


def encoder(path: str) -> Callable[[str], list[int]]:
    """Token ids of any text."""
    quick = encoding(path).encode_ordinary

    def ids(text: str) -> list[int]:
        if len(text) > SAFE and any(m.end() - m.start() > SAFE for m in _SPACE.finditer(text)):
            return library(path).encode(text, add_special_tokens=False).ids
        return quick(text)

    return ids
