"""Public byte-level vocabularies, and the words that texts are split into before they are encoded.

A word here is a run of white space with the run of other characters after it. The split pattern of the byte-level
vocabularies never matches across the end of such a word, so the ids of a text are those of its words, in order.
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

# White space as the vocabularies' pattern means it: Python's also takes the four separators 1c to 1f.
WORD = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
RUN_WITH_BLANK = re.compile(r"\s | \s")


def words(text: str) -> list[str]:
    """The words of a text; joined again they are the text. Where blanks stand alone, splitting at them is the quicker way."""
    if RUN_WITH_BLANK.search(text):
        return WORD.findall(text)
    first, *rest = text.split(" ")
    return [*([first] if first else []), *(" " + w for w in rest)]


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file, or those that the merges of a tokenizers file amount to."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as lines:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"] for t in content["added_tokens"] if t["special"]}
    plain = byte_letters()
    return {bytes(plain[c] for c in token): number for token, number in content["model"]["vocab"].items() if token not in special}


def byte_letters() -> dict[str, int]:
    """Which byte each letter of a byte-level vocabulary stands for: printable ones for themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


def as_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def sentence_ends(path: str) -> np.ndarray:
    """By id: whether its bytes close a sentence or a line."""
    table = ranks(path)
    ends = np.zeros(max(table.values()) + 2, bool)
    for token, number in table.items():
        ends[number] = b"\n" in token or token.rstrip(b"\"')").endswith((b".", b"!", b"?"))
    return ends


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """By id: the bytes that a token stands for."""
    table = ranks(path)
    found = [b""] * (max(table.values()) + 1)
    for token, number in table.items():
        found[number] = token
    return found
