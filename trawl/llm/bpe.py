"""Byte-pair encoding of whole texts, and a bounded per-worker cache of what is known of chunks.

A text is cut into chunks before each space or newline whose left neighbour is not
white space.  The pre-tokenizer always has a boundary there, so what holds for the
chunks one by one holds for the text.  Texts with white space elsewhere do not
satisfy the condition and are taken whole.  Token ids come faster without the cache;
token counts of prefixes, which take longer, use it.
"""

from __future__ import annotations

import base64
import os
from array import array
from functools import lru_cache

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CACHE_ENTRIES = 1_000_000
CACHED_CHARS = 256
MARKS = ".,;:!?*&%#$()[]<>/+-=_|"


class _Uncut(Exception):
    """A chunk border fell inside a white-space run."""


@lru_cache(maxsize=4)
def encoding(path: str):
    """The tiktoken encoding of a rank file (two columns: base64 bytes, id)."""
    import tiktoken

    with open(path, "rb") as handle:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, handle)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class ChunkCache(dict):
    """chunk -> what `measure` gives for it; emptied whenever it holds `limit` chunks."""

    def __init__(self, measure, limit: int):
        super().__init__()
        self.measure, self.limit = measure, limit
        self.tails: dict[str, object] = {}

    def __missing__(self, chunk):
        if not chunk or chunk[-1].isspace():
            raise _Uncut
        if len(self) >= self.limit:
            self.clear()
        stem = chunk.rstrip(MARKS)
        if stem != chunk and stem.isalpha():
            # Marks behind letters are a piece of their own.
            tail = chunk[len(stem) :]
            if tail not in self.tails:
                if len(self.tails) >= self.limit:
                    self.tails.clear()
                self.tails[tail] = self.measure(tail)
            value = self[stem] + self.tails[tail]
        else:
            value = self.measure(chunk if chunk[0] == "\n" else " " + chunk)
        if len(chunk) <= CACHED_CHARS:
            self[chunk] = value
        return value


class TokenEncoder:
    """texts -> little-endian token ids, two bytes each (four when the vocabulary needs it)."""

    def __init__(self, path: str = DEFAULT_VOCABULARY):
        self.encoding = encoding(path)
        self.code = "H" if self.encoding.max_token_value < 65535 else "I"
        self.width = array(self.code).itemsize
        self.end_id = self.encoding.max_token_value + 1

    def encode(self, text: str) -> bytes:
        return array(self.code, self.encoding.encode_ordinary(text)).tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return list(map(self.encode, texts))


@lru_cache(maxsize=2)
def encoder(path: str = DEFAULT_VOCABULARY) -> TokenEncoder:
    """One encoder per Python worker."""
    return TokenEncoder(path)
