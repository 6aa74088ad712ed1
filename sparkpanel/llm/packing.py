"""Packing of tokenised documents into sequences of one length."""

from __future__ import annotations

import unicodedata
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm.arrow import batched, released, small
from sparkpanel.llm.staging import staged
from sparkpanel.llm.units import DIGIT, SPACE, characters, class_of, lowered, mix, run_hashes

#: Parts of text whose ids a worker remembers. The first to be seen are mostly the frequent ones.
REMEMBERED = 400_000
PARTITIONS_MERGED = 64
_SEQUENCES = 1 << 33
_MERGED = 1 << 62
PIECE_SCHEMA = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, task long, closed boolean"


class PartTable:
    """Numbers of parts by their hash, in slots; a hash that finds no slot within eight steps isn't remembered."""

    BITS, STEPS = 20, 8

    def __init__(self):
        self.key = np.zeros(1 << self.BITS, np.uint64)
        self.number = np.full(1 << self.BITS, -1, np.int64)

    def _slots(self, h: np.ndarray, step: int) -> np.ndarray:
        return ((h >> np.uint64(64 - self.BITS)).astype(np.int64) + step) & ((1 << self.BITS) - 1)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where it's unknown."""
        out = np.full(len(h), -1, np.int64)
        open_ = np.arange(len(h))
        for step in range(self.STEPS):
            slot = self._slots(h[open_], step)
            number = self.number[slot]
            hit = (self.key[slot] == h[open_]) & (number >= 0)
            out[open_[hit]] = number[hit]
            open_ = open_[~hit & (number >= 0)]
            if not len(open_):
                break
        return out

    def add(self, h: np.ndarray, number: np.ndarray) -> None:
        """Remember distinct hashes that are not known yet."""
        for step in range(self.STEPS):
            slot = self._slots(h, step)
            free = np.flatnonzero(self.number[slot] < 0)
            at, first = np.unique(slot[free], return_index=True)
            chosen = free[first]
            self.key[at], self.number[at] = h[chosen], number[chosen]
            left = np.ones(len(h), bool)
            left[chosen] = False
            h, number = h[left], number[left]
            if not len(h):
                return


class Growing:
    """An array that is added to at the end, and cut."""

    def __init__(self, kind):
        self.held, self.n = np.zeros(1 << 16, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.held):
            self.held = np.concatenate([self.held[: self.n], np.zeros(self.n + len(more), self.held.dtype)])
        self.held[self.n : self.n + len(more)] = more
        self.n += len(more)


class WordIds:
    """Ids of a text by a tokenizer that drops white space, as little-endian unsigned 32-bit numbers.

    Such a tokenizer gives each run of letters, each digit and each run of symbols ids of
    its own that end with a word's end. The parts of a slice of texts are looked up by hash
    and compared with the part that was learnt; only unknown ones are cut out and go to the
    tokenizer, many at once. The first ``REMEMBERED`` stay known in the worker. Texts in
    which the parts or their lower case depend on more than the character, or which hold
    the string of an added token, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [str(t.content).lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.table = PartTable()
        # Of each part learnt where its ids and its characters begin, and how many they are.
        self.begin, self.size, self.code_begin, self.code_size = (Growing(np.int64) for _ in range(4))
        self.ids, self.codes = Growing("<u4"), Growing(np.uint32)

    def _learn(self, parts: list[str]) -> None:
        groups = [parts[i : i + 200] for i in range(0, len(parts), 200)]
        ids = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)]
        flat = np.concatenate(ids)
        ends = np.flatnonzero(self.ends[flat]) + 1
        sizes = np.diff(ends, prepend=0)
        self.begin.add(self.ids.n + ends - sizes)
        self.size.add(sizes)
        self.ids.add(flat)

    def _slice(self, texts: list[str]) -> list[bytes | None]:
        """Ids of each text; None where a hash stood for another part as well."""
        joined = "\n".join([*texts, ""])
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        classes, hashes = characters()
        bounded = np.minimum(code, 65535)
        kind, h, low = classes[bounded], hashes[bounded], lowered()[bounded]
        for i in np.flatnonzero(code > 65535):
            kind[i], h[i], low[i] = class_of(joined[i]), mix(np.array([code[i]], np.uint64))[0], code[i]
        change = kind[1:] != kind[:-1]
        digit = kind == DIGIT
        starts = np.flatnonzero((kind != SPACE) & np.append(True, change | digit[1:]))
        stops = np.flatnonzero((kind != SPACE) & np.append(change | digit[:-1], True)) + 1
        part = run_hashes(h, starts, stops)
        number = self.table.find(part)
        known, length = self.begin.n, stops - starts
        if len(unknown := np.flatnonzero(number < 0)):
            new, first, which = np.unique(part[unknown], return_index=True, return_inverse=True)
            at = unknown[first]
            self._learn([joined[a:b].lower() for a, b in zip(starts[at].tolist(), stops[at].tolist(), strict=True)])
            number[unknown] = known + which
            ends = np.cumsum(length[at])
            self.code_begin.add(self.codes.n + ends - length[at])
            self.code_size.add(length[at])
            self.codes.add(low[np.repeat(starts[at] - ends + length[at], length[at]) + np.arange(ends[-1])])
            if self.begin.n <= REMEMBERED:
                self.table.add(new, known + np.arange(len(new)))
        # Equal hashes must stand for equal parts.
        ends = np.cumsum(length)
        inner = np.arange(ends[-1] if len(ends) else 0)
        alike = self.code_size.held[number] == length
        theirs = np.repeat(np.where(alike, self.code_begin.held[number], 0) - ends + length, length) + inner
        if not alike.all():
            theirs %= self.codes.n
        differ = low[kind != SPACE] != self.codes.held[theirs]
        wrong = ~alike | (np.add.reduceat(differ, ends - length) > 0 if len(ends) else False)
        sizes = self.size.held[number]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.ids.held[np.repeat(self.begin.held[number] - ends[:-1], sizes) + np.arange(ends[-1])]
        edges = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
        at = ends[edges].tolist()
        out = [flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        for i in np.unique(np.searchsorted(edges, np.flatnonzero(wrong), "right") - 1).tolist():
            out[i] = None
        if self.begin.n > REMEMBERED:
            # What this slice taught is forgotten.
            self.ids.n, self.codes.n = (int(x.held[known]) for x in (self.begin, self.code_begin))
            for x in (self.begin, self.size, self.code_begin, self.code_size):
                x.n = known
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [i for i, t in enumerate(texts) if self._plain(t)]
        out = dict(zip(plain, self._slice([texts[i] for i in plain]) if plain else [], strict=True))
        for i, text in enumerate(texts):
            if out.get(i) is None:
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return [out[i] for i in range(len(texts))]

    def _plain(self, text: str) -> bool:
        if any(c in text for c in "'\x1c\x1d\x1e\x1f") or ("<" in text and any(a in text.lower() for a in self.added)):
            return False
        return text.isascii() or not ("\u03a3" in text or "\u0130" in text) and unicodedata.is_normalized("NFC", text)


@cache
def word_ids(path: str) -> WordIds:
    """One for each worker process, so that tasks share what they have learnt."""
    return WordIds(path)


class OpenWindows:
    """A fixed number of open sequences; a piece goes where it leaves the least space.

    Pieces are (doc, start, ids, doc_tokens) with four bytes for each id. Where nothing
    fits, the fullest sequence takes the head of the piece that fills it and is emitted,
    so no emitted sequence needs padding.
    """

    def __init__(self, length: int, windows: int):
        self.length, self.windows = length, windows
        self.spaces: list[tuple[int, int]] = []
        self.content: dict[int, list[tuple]] = {}
        self.made = 0

    def _put(self, space: int, window: int, piece: tuple) -> Iterator[list[tuple]]:
        self.content[window].append(piece)
        space -= len(piece[2]) // 4
        if space:
            insort(self.spaces, (space, window))
        else:
            yield self.content.pop(window)

    def add(self, piece: tuple) -> Iterator[list[tuple]]:
        """Sequences that became full."""
        doc, start, ids, total = piece
        while ids:
            n = len(ids) // 4
            if n >= self.length:
                yield [(doc, start, ids[: 4 * self.length], total)]
                start, ids = start + self.length, ids[4 * self.length :]
                continue
            i = bisect_left(self.spaces, (n, -1))
            if i < len(self.spaces):
                yield from self._put(*self.spaces.pop(i), (doc, start, ids, total))
                return
            if len(self.spaces) < self.windows:
                self.made += 1
                self.content[self.made] = []
                yield from self._put(self.length, self.made, (doc, start, ids, total))
                return
            space, window = self.spaces.pop(0)
            yield from self._put(space, window, (doc, start, ids[: 4 * space], total))
            start, ids = start + space, ids[4 * space :]

    def rest(self) -> list[tuple]:
        """Pieces of the sequences that are still open."""
        return [p for _, w in self.spaces for p in self.content[w]]


def _rows(sequence: list[tuple], number: int, task: int, closed: bool = True) -> Iterator[tuple]:
    at = 0
    for doc, start, ids, total in sequence:
        yield (doc, start, len(ids) // 4, ids, total, number, at, task, closed)
        at += len(ids) // 4


def _schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("doc_id", id_type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("task", pa.int64()), ("closed", pa.bool_()),
    ])


def _pack_task(tokenizer: str, end_id: int, length: int, windows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer, task = word_ids(tokenizer), OpenWindows(length, windows), TaskContext.get().partitionId()
        end = end_id.to_bytes(4, "little")
        schema = None

        def rows(batch):
            nonlocal made
            encoded = words.encode([t or "" for t in batch["text"].to_pylist()])
            for doc, ids in zip(batch["doc"].to_pylist(), encoded, strict=True):
                ids += end
                for sequence in packer.add((doc, 0, ids, len(ids) // 4)):
                    yield from _rows(sequence, task * _SEQUENCES + made, task)
                    made += 1

        made = 0
        for large in batches:
            schema = _schema(large.schema.field("doc").type)
            for batch in small(large, "text", 1 << 19):
                yield from batched(rows(batch), schema)
        if schema:
            yield from batched(_rows(packer.rest(), -1, task, closed=False), schema)

    return run


def _merge_task(length: int, windows: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        packer, made, out = OpenWindows(length, windows), 0, []

        def emit(sequence):
            nonlocal made
            out.extend(_rows(sequence, _MERGED + group * _SEQUENCES + made, 0))
            made += 1

        pieces = [tuple(r[c] for c in ("doc_id", "start", "ids", "doc_tokens")) for r in table.sort_by([("task", "ascending"), ("offset", "ascending")]).to_pylist()]
        for piece in sorted(pieces, key=lambda p: -len(p[2])):
            for sequence in packer.add(piece):
                emit(sequence)
        # What is left becomes full sequences, then sequences of falling powers of two.
        rest = packer.rest()
        total = sum(len(p[2]) for p in rest) // 4
        while rest:
            want = length if total >= length else 1 << (total.bit_length() - 1)
            total -= want
            sequence = []
            while want:
                doc, start, ids, doc_tokens = rest.pop(0)
                n = min(want, len(ids) // 4)
                sequence.append((doc, start, ids[: 4 * n], doc_tokens))
                if 4 * n < len(ids):
                    rest.insert(0, (doc, start + n, ids[4 * n :], doc_tokens))
                want -= n
            emit(sequence)
        schema = _schema(table.schema.field("doc_id").type)
        return pa.Table.from_batches(batched(out, schema, 1 << 62), schema)

    return run


def pack(df: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, length: int = 4096, windows: int = 32) -> DataFrame:
    """Tokenise whole texts and pack them into sequences of ``length`` ids.

    A row for each piece: doc_id, start (ids of its document before it), length, ids
    (binary, little-endian unsigned 32-bit), doc_tokens (all ids of the document, with
    ``end_id``), sequence_id, offset (place in the sequence).

    Each task keeps ``windows`` open sequences. A document, less the full sequences cut
    from it, goes into the open sequence where it leaves the least space; where none has
    room the fullest takes what fills it and is emitted. The sequences left open by up to
    64 tasks (at most 64 x windows x length ids) are merged by one further task, and its
    remainder is cut into sequences whose lengths are powers of two, so nothing is padded.
    ``length`` must be a power of two.

    Null and empty texts give the end id alone. Rows that repeat an id are packed one by
    one. Only the two columns are read, so others may have any name. An empty table gives
    an empty one. ``tokenizer`` is the path of a file that every executor can read.
    """
    rows = df.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    out = PIECE_SCHEMA.format(id=rows.schema["doc"].dataType.simpleString())
    packed = staged(rows.mapInArrow(released(_pack_task(tokenizer, end_id, length, windows)), out), "packed")
    merged = (
        packed.filter("not closed").withColumn("group", F.floor(F.col("task") / PARTITIONS_MERGED)).groupBy("group")
        .applyInArrow(_merge_task(length, windows), out)
    )
    return packed.filter("closed").unionByName(merged).drop("task", "closed")
