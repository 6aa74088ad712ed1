"""Byte-level BPE with rank files: encoding in padded matrices, and decoding."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm.arrow import released, small

#: Pieces that a worker remembers; beyond that it starts anew.
REMEMBERED = 400_000
#: Longer pieces would make wide matrices with a round for each byte.
WIDEST = 256
_NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


class PairRanks:
    """Rank of the token that two adjacent tokens make: an open-addressing table in numpy."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
        ]
        left, right, made = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 3
        self.bits = max(4, (4 * len(pairs)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.made = np.full(size, _NONE, np.int32)
        keys = left << 32 | right
        todo, slot, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(todo):
            self.probes += 1
            free = self.keys[slot[todo]] == -1
            claim = todo[free]
            self.keys[slot[claim]] = keys[claim]  # of several that claim a slot the last one stays
            settled = self.keys[slot[todo]] == keys[todo]
            self.made[slot[todo[settled]]] = made[todo[settled]]
            todo = todo[~settled]
            slot[todo] = (slot[todo] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        slot = self._slot(keys)
        found = np.where(self.keys[slot] == keys, self.made[slot], _NONE)
        for _ in range(self.probes - 1):
            slot = (slot + 1) & (len(self.keys) - 1)
            found = np.where(self.keys[slot] == keys, self.made[slot], found)
        return found


class Bpe:
    """Encoder and decoder for one rank file and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.pairs = PairRanks(ranks)
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.known: dict[str, bytes] = {}

    def _matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids of pieces of at most ``width`` bytes. A round merges in every row its leftmost pair of least rank."""
        n = len(pieces)
        sizes = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        ids = np.where(np.arange(width) < sizes[:, None], self.first[raw], np.int32(-1))
        rank = self.pairs(ids[:, :-1], ids[:, 1:])
        rows, out = np.arange(n), [b""] * n
        while len(rows):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), np.int64)
            least = rank[np.arange(len(rows)), at] if rank.shape[1] else np.full(len(rows), _NONE)
            for i in np.flatnonzero(least == _NONE):
                out[rows[i]] = ids[i][ids[i] >= 0].astype("<u4").tobytes()
            going = least != _NONE
            rows, ids, rank, at, least = rows[going], ids[going], rank[going], at[going], least[going]
            if not len(rows):
                break
            each, columns = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
            moved = columns + (columns > at[:, None])
            ids = np.take_along_axis(ids, moved, axis=1)
            ids[each, at] = least
            rank = np.take_along_axis(rank, moved[:, :-1] + (columns[:-1] == at[:, None]), axis=1)
            before, after = at > 0, at + 1 < ids.shape[1]
            if before.any():
                rank[each[before], at[before] - 1] = self.pairs(ids[each[before], at[before] - 1], least[before])
            if after.any():
                rank[each[after], at[after]] = self.pairs(least[after], ids[each[after], at[after] + 1])
        return out

    def _long(self, piece: bytes) -> bytes:
        """The same merges for one long piece: a heap of (rank, place) over linked tokens."""
        ids = [int(i) for i in self.first[np.frombuffer(piece, np.uint8)]]
        text = [bytes([b]) for b in piece]
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        rank_of = lambda i: self.ranks.get(text[i] + text[after[i]]) if after[i] < len(ids) else None
        heap = [(r, i) for i in range(len(ids)) if (r := rank_of(i)) is not None]
        heapq.heapify(heap)
        alive = [True] * len(ids)
        while heap:
            rank, i = heapq.heappop(heap)
            if not alive[i] or rank_of(i) != rank:
                continue
            j = after[i]
            text[i], ids[i], alive[j], after[i] = text[i] + text[j], rank, False, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (r := rank_of(k)) is not None:
                    heapq.heappush(heap, (r, k))
        return np.array([x for x, on in zip(ids, alive, strict=True) if on], "<u4").tobytes()

    def _learn(self, pieces: set[str]) -> None:
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                self.known[piece] = whole.to_bytes(4, "little")
            elif len(raw) > WIDEST:
                self.known[piece] = self._long(raw)
            else:
                by_width.setdefault(-(-len(raw) // 4) * 4 if len(raw) <= 32 else 1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
        for width, found in by_width.items():
            step = max(1, (1 << 18) // width)
            for i in range(0, len(found), step):
                part = found[i : i + step]
                for (piece, _), ids in zip(part, self._matrix([raw for _, raw in part], width), strict=True):
                    self.known[piece] = ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        cut = [self.split(t) for t in texts]
        unknown = set().union(*cut).difference(self.known)
        if unknown:
            if len(self.known) + len(unknown) > REMEMBERED:
                self.known, unknown = {}, set().union(*cut)
            self._learn(unknown)
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@cache
def _bpe(ranks_path: str, pattern: str) -> Bpe:
    """One for each worker process, so that tasks share what they have learnt."""
    return Bpe(read_ranks(ranks_path), pattern)


def _with(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    keep = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), values], names=[*(batch.schema.names[i] for i in keep), name])


def _added(df: DataFrame, name: str, kind: str):
    return df.drop(name).withColumn(name, F.lit(None).cast(kind)).schema


def bpe_encode(df: DataFrame, text_col: str, ranks_path: str, pattern: str, out: str = "ids") -> DataFrame:
    """Add ``out``: array<int> of the ids of the whole text, each match of ``pattern`` encoded by itself.

    Special tokens have no meaning: their strings are ordinary text. The distinct matches
    of a slice of about 2 MB stand as rows of matrices padded to like lengths; a round
    merges in each row the leftmost pair of least rank, found in a hashed table of pairs,
    and rows without one leave. Matches over 256 bytes take the same merges off a heap.
    Null text counts as empty and gives no ids. A column named ``out`` is replaced; all
    others and repeated rows pass unchanged. An empty table gives an empty one.
    ``ranks_path`` must be readable by every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(ranks_path, pattern)
        for large in batches:
            for batch in small(large, text_col):
                found = bpe.encode([t or "" for t in batch[text_col].to_pylist()])
                ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(found), "<i4"))
                yield _with(batch, out, pa.ListArray.from_arrays(pa.array(ends), flat))

    return df.mapInArrow(released(run), _added(df, out, "array<int>"))


def bpe_decode(df: DataFrame, ids_col: str, ranks_path: str, out: str = "decoded") -> DataFrame:
    """Add ``out``: binary, the bytes that the ids stand for. Null ids give null, an unknown id is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in read_ranks(ranks_path).items()}
        for large in batches:
            for first in range(0, large.num_rows, 500):
                batch = large.slice(first, 500)
                ids = batch[ids_col]
                values = [None if x is None else b"".join(map(tokens.__getitem__, x.values.to_numpy().tolist())) for x in _lists(ids)]
                yield _with(batch, out, pa.array(values, pa.binary()))

    return df.mapInArrow(released(run), _added(df, out, "binary"))


def _lists(column: pa.Array) -> Iterator:
    for x in column:
        yield x if x.is_valid else None
