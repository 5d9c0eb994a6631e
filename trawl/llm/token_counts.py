"""Operator 8: exact token counts of every prefix, by dynamic programming.

``count[k] = count[k - len(t)] + 1`` where ``t`` is the one vocabulary entry that
ends the first k bytes of a piece and may follow the last token of what precedes
it (two tokens may be neighbours when encoding their joined bytes gives them
back).  One pass over a text so answers every truncation and budget question.

A text's counts are kept as the differences between successive characters:
``count_at(deltas, i)`` is the token count of ``text[:i]``.
A run of white space that ends a prefix is one piece, so the prefixes of a run are
counted by one pass over it however long it is.
Null text: null results.  Empty text: no differences, zero tokens.  An empty table
gives no rows.  `doc_id` is a whole number or null.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.bpe import CACHE_ENTRIES, DEFAULT_VOCABULARY, PATTERN, ChunkCache, _Uncut, encoding
from trawl.llm.common import c, spread

HEAD = 5
#: White space as the pre-tokenizer has it; `str.isspace` knows four characters more.
WHITE = regex.compile(r"\s+").match
BUDGETS = (512, 2048, 8192)
SCHEMA = "doc_id long, n_chars long, n_tokens long, delta_bytes int, prefix_deltas binary, budget_cuts array<long>"


class PrefixCounter:
    """text -> differences of the token counts of its successive prefixes."""

    def __init__(self, path: str = DEFAULT_VOCABULARY, cache_entries: int = CACHE_ENTRIES):
        self.encoding = encoding(path)
        self.ranks = self.encoding._mergeable_ranks
        self.bytes_of = {rank: word for word, rank in self.ranks.items()}
        self._piece = self.encoding._core_bpe.encode_single_piece
        self._split = regex.compile(PATTERN).finditer
        self.neighbours: dict[tuple[int, int], bool] = {}
        self.beginnings = {word[:k] for word in self.ranks for k in range(1, len(word) + 1)}
        self.heads: dict[bytes, tuple[list[int], list[int], int]] = {}
        self.cache = ChunkCache(self._measured, cache_entries // 2)

    def _measured(self, chunk: str) -> bytes:
        if chunk[0] == " " and chunk[1:].isalpha():
            # One piece, whose first prefix is the space.
            own = self.piece_counts(chunk)
            return array("b", [own[0], *map(int.__sub__, own[1:], own)]).tobytes()
        return array("b", self.differences(chunk)).tobytes()

    def _may_follow(self, left: int, right: int) -> bool:
        known = self.neighbours.get((left, right))
        if known is None:
            if len(self.neighbours) > CACHE_ENTRIES:
                self.neighbours.clear()
            known = self._piece(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self.neighbours[left, right] = known
        return known

    def piece_counts(self, piece: str) -> list[int]:
        """Token counts of piece[:1], piece[:2], ... for a piece whose prefixes are pieces too."""
        data = piece.encode()
        n = len(data)
        if n > HEAD:
            # Pieces that begin alike share the table up to there.
            head = data[:HEAD]
            known = self.heads.get(head)
            if known is None:
                if len(self.heads) > CACHE_ENTRIES // 4:
                    self.heads.clear()
                known = self.heads[head] = self._extended(head, [-1], [0], 0, 1)
            last, count, _ = self._extended(data, known[0][:], known[1][:], known[2], HEAD + 1)
        else:
            last, count, _ = self._extended(data, [-1], [0], 0, 1)
        if n == len(piece):
            return count[1:]
        return [count[k] for k in range(1, n + 1) if k == n or data[k] & 0xC0 != 0x80]

    def _extended(self, data: bytes, last: list[int], count: list[int], begin: int, k: int) -> tuple[list[int], list[int], int]:
        """The last tokens and counts of all prefixes, from those of the first k - 1 bytes.

        `begin` is where the longest run of bytes that begins a vocabulary entry starts: no token reaches further back.
        """
        ranks, beginnings, may_follow, neighbours = self.ranks.get, self.beginnings, self._may_follow, self.neighbours.get
        for k in range(k, len(data) + 1):
            while data[begin:k] not in beginnings:
                begin += 1
            for start in range(begin, k):
                token = ranks(data[start:k])
                if token is None:
                    continue
                if start:
                    fits = neighbours((last[start], token))
                    if fits is None:
                        fits = may_follow(last[start], token)
                else:
                    fits = self._piece(data[:k]) == [token]
                if fits:
                    last.append(token)
                    count.append(count[start] + 1)
                    break
            else:
                raise AssertionError("no token ends here")
        return last, count, begin

    def differences(self, text: str) -> list[int]:
        out, base, shown = [], 0, 0
        run = -1
        for match in self._split(text):
            piece = match.group()
            white = WHITE(piece)
            if white:
                if run < 0:
                    # Cut inside white space, the whole run up to the cut is one piece.
                    run, run_base = match.start(), base
                    inside = self.piece_counts(WHITE(text, run).group())
                head, skipped = white.end(), match.start() - run
                counts = [run_base + n for n in inside[skipped : skipped + head]]
                if skipped or head < len(piece):
                    own = self.piece_counts(piece)
                    counts += [base + n for n in own[head:]]
                    base += own[-1]
                else:
                    base = counts[-1]
                if head < len(piece):
                    run = -1
            else:
                run = -1
                # A cut contraction is not a contraction.
                cut = piece[0] == "'" and len(piece) == 3 and piece[1].isalpha()
                own = [self._tokens(piece[:k]) for k in range(1, 4)] if cut else self.piece_counts(piece)
                counts = [base + n for n in own]
                base = counts[-1]
            for n in counts:
                out.append(n - shown)
                shown = n
        return out

    def _tokens(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))

    def encode(self, text: str) -> tuple[int, bytes]:
        """Bytes per difference (1 or 4) and the differences."""
        try:
            first, *rest = text.replace("\n", " \n").split(" ")
            if not rest or not first or first[-1].isspace():
                raise _Uncut
            return 1, array("b", self.differences(first)).tobytes() + b"".join(map(self.cache.__getitem__, rest))
        except _Uncut:
            found = self.differences(text)
        except OverflowError:
            found = self.differences(text)
        try:
            return 1, array("b", found).tobytes()
        except OverflowError:
            return 4, array("i", found).tobytes()


@lru_cache(maxsize=2)
def counter(path: str = DEFAULT_VOCABULARY) -> PrefixCounter:
    return PrefixCounter(path)


def counts(deltas: bytes, delta_bytes: int = 1) -> np.ndarray:
    """Token counts of the prefixes of one character, two characters, and so on."""
    return np.cumsum(np.frombuffer(deltas, dtype=np.int8 if delta_bytes == 1 else np.int32), dtype=np.int64)


def count_at(deltas: bytes, n_chars: int, delta_bytes: int = 1) -> int:
    """The token count of the first n_chars characters."""
    return int(counts(deltas, delta_bytes)[n_chars - 1]) if n_chars else 0


def longest_prefix(deltas: bytes, budget: int, delta_bytes: int = 1) -> int:
    """Characters of the longest prefix of at most `budget` tokens."""
    fits = np.flatnonzero(counts(deltas, delta_bytes) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def token_counts(docs: DataFrame, budgets: Sequence[int] = BUDGETS, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """For each document its token count, the counts of all prefixes, and the cut for each budget.

    Other columns are ignored.  Repeated rows give repeated rows.
    """
    budgets = [int(b) for b in budgets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if text is None:
                        rows.append((doc_id, None, None, None, None, None))
                        continue
                    width, deltas = own.encode(text)
                    n = counts(deltas, width)
                    most = int(n.max()) if len(n) else 0
                    cuts = []
                    for budget in budgets:
                        fits = np.flatnonzero(n <= budget) if most > budget else None
                        cuts.append(len(n) if fits is None else int(fits[-1]) + 1 if len(fits) else 0)
                    rows.append((doc_id, len(n), int(n[-1]) if len(n) else 0, width, deltas, cuts))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
                names = ("doc_id", "n_chars", "n_tokens", "delta_bytes", "prefix_deltas", "budget_cuts")
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)

    return spread(docs.select(c("doc_id").cast("long").alias("doc_id"), c("text").alias("text"))).mapInArrow(run, SCHEMA)
