"""Byte-level BPE encoding by backtracking, and decoding.

The UTF-8 bytes of a piece are mapped to Latin-1, so that an Aho-Corasick automaton over the
vocabulary (pyahocorasick) finds the longest token from any byte. A sequence of tokens is what
the merges make of a piece exactly if each two neighbours are: encoding the two tokens' bytes by
the merges gives back the two. So the longest token is taken as long as it is compatible with
the one before, else the next shorter one; where none is left the last token is taken back and
its end is marked, so that no end is tried twice and the work is linear in the piece. Most pieces
are done by the automaton's own longest matches. The compatibility of two tokens is memoised,
and so are whole pieces, both within bounds.

Defined cases: a null text is empty and has no tokens; special tokens' strings are ordinary
text; ids may be null or repeat (each row gives a row); pieces of any length work; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Most pieces and most token pairs that a Python worker remembers.
MEMO_PIECES = 300_000
MEMO_PAIRS = 200_000
#: Rows handled at once.
ROWS = 256


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    """The definition: merge the neighbours of least rank, leftmost first, until none is left."""
    rank, none = ranks.get, 1 << 60
    parts = [piece[i : i + 1] for i in range(len(piece))]
    costs = [rank(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while costs and (least := min(costs)) < none:
        at = costs.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del costs[at]
        if at:
            costs[at - 1] = rank(parts[at - 1] + parts[at], none)
        if at < len(costs):
            costs[at] = rank(parts[at] + parts[at + 1], none)
    return [ranks[p] for p in parts]


class Encoder(dict):
    """Remembers pieces (str) with their ids as little-endian int32 bytes; unknown ones are encoded."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        super().__init__()
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.tokens[rank] = token
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.sizes = [len(t) for t in self.tokens]
        self.shorter = [self._shorter(t) for t in self.tokens]
        self.pairs: dict[int, bool] = {}

    def _shorter(self, token: bytes) -> int | None:
        """The longest token that is a proper prefix of this one."""
        return next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks), None)

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = merge(self.ranks, self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def backtrack(self, piece: str) -> list[int]:
        """``piece`` is Latin-1: a character for each byte."""
        longest, sizes, shorter, compatible = self.automaton.iter_long, self.sizes, self.shorter, self.compatible
        out: list[int] = []
        closed: set[int] = set()
        at, end = 0, len(piece)
        token: int | None = next(longest(piece))[1]
        while at < end:
            while token is not None and (at + sizes[token] in closed or (out and not compatible(out[-1], token))):
                token = shorter[token]
            if token is None:
                closed.add(at)
                token = out.pop()
                at -= sizes[token]
            else:
                out.append(token)
                at += sizes[token]
                token = next(longest(piece, at))[1] if at < end else None
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        latin = piece.decode("latin-1")
        greedy = [token for _, token in self.automaton.iter_long(latin)]
        compatible = self.compatible
        for left, right in zip(greedy, greedy[1:], strict=False):
            if not compatible(left, right):
                return self.backtrack(latin)
        return greedy

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO_PIECES:
            self.clear()
        code = np.array(self.encode_piece(piece.encode()), "<i4").tobytes()
        if len(piece) < 64:
            self[piece] = code
        return code

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, self.find(text))), "<i4")


@cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


@cache
def _vocabulary(path: str) -> pa.Array:
    ranks = read_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return pa.array(tokens, pa.large_binary())


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32), pa.int32()))


def decode_lists(path: str, ids: pa.ListArray) -> pa.Array:
    """The bytes of each list of ids; a null list is empty."""
    taken = _vocabulary(path).take(ids.flatten())
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    cuts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    _, offsets, data = taken.buffers()
    ends = np.frombuffer(offsets, np.int64)[taken.offset : taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends[cuts].copy()), data if data is not None else pa.py_buffer(b"")])


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids``, a row for each row of ``docs``. ``path`` is a file of ranks on the executors."""
    kind = docs.schema[id_col].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                parts = [coder.encode(t or "") for t in batch.column(1).to_pylist()]
                yield pa.record_batch([batch.column(0).cast(schema.field(0).type), _lists(parts)], schema=schema)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind.simpleString()}, ids array<int>")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and ``bytes``, a row for each row of ``tokens``."""
    kind = tokens.schema[id_col].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("bytes", pa.large_binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                yield pa.record_batch([part.column(0).cast(schema.field(0).type), decode_lists(path, part.column(1))], schema=schema)

    return tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"doc_id {kind.simpleString()}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` and the ``bytes`` that these decode to, by one Python worker for each task."""
    kind = docs.schema[id_col].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("ids", pa.list_(pa.int32())), ("bytes", pa.large_binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                ids = _lists([coder.encode(t or "") for t in batch.column(1).to_pylist()])
                yield pa.record_batch([batch.column(0).cast(schema.field(0).type), ids, decode_lists(path, ids)], schema=schema)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind.simpleString()}, ids array<int>, bytes binary")
