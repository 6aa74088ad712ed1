"""Removal of byte strings that occur again, by suffixes sorted with a difference cover."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm.arrow import released, small
from sparkpanel.llm.repeats import merged, repeated_ranges, with_ranges
from sparkpanel.llm.units import Bytes, stretches

PERIOD = 64
_ROOT = 8
GRAM = 32


@cache
def cover() -> tuple[np.ndarray, np.ndarray]:
    """Which residues are sampled, and for two residues the least shift that brings both into the sample.

    0 to 7 and the multiples of 8 form a difference cover of 64: each d is 8 a - b.
    """
    sampled = np.zeros(PERIOD, bool)
    sampled[:_ROOT] = True
    sampled[::_ROOT] = True
    shift = np.arange(PERIOD)
    both = sampled[(np.arange(PERIOD)[:, None] + shift) % PERIOD]
    return sampled, (both[:, None, :] & both[None, :, :]).argmax(axis=2)


def _named(*keys: np.ndarray) -> np.ndarray:
    """Ranks of the rows that the key columns form, equal rows alike; the first key counts most."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def equal_windows(text: bytes, windows: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """A class for each window of ``length`` bytes that begins at ``windows``; equal windows have equal classes.

    Windows are sorted by ``bucket``, their first eight bytes, and a hash of the whole
    window, which puts equal ones side by side however many others begin alike. Equality
    itself is decided by bytes: each is compared with the first of its hash that has no
    class yet, 64 bytes at the front and what ends the window directly, the rest by the rank
    of the cover sample that both reach with the same shift. Memory is a constant times the text.
    """
    depth = (length - PERIOD) // PERIOD * PERIOD  # of the sample ranks; with both ends it covers the window
    n = len(text)
    padded = np.frombuffer(text + bytes(length + 2 * PERIOD), np.uint8)
    word = np.zeros(len(padded) - 8, np.uint64)
    for i in range(8):
        word = word << np.uint64(8) | padded[i : i + len(word)]
    sampled, shift = cover()

    # Ranks of the samples by their first 64 bytes, then by twice as many in each step.
    at = np.flatnonzero(np.tile(sampled, n // PERIOD + 1)[:n])
    index = np.full(len(padded) + length, len(at), np.int64)
    index[at] = np.arange(len(at))
    rank = _named(*[word[np.minimum(at + 8 * k, len(word) - 1)] for k in range(PERIOD // 8)])
    powers, span = {PERIOD: rank}, PERIOD
    follow = lambda ranks, step: np.append(ranks, -1)[index[at + step]]
    while 2 * span <= depth:
        rank = _named(rank, follow(rank, span))
        span *= 2
        powers[span] = rank
    for size in sorted(powers, reverse=True):
        while span + size <= depth:
            rank = _named(rank, follow(powers[size], span))
            span += size

    front, back = range(0, PERIOD, 8), [*range(span, length - 7, 8), length - 8]
    whole = stretches(Bytes([text]).h, length)[windows]
    order = np.lexsort((whole, word[windows], bucket))
    keys = bucket[order], word[windows[order]], whole[order]
    group = np.cumsum(np.append(False, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])))
    classes = np.full(len(windows), -1, np.int64)
    todo = np.arange(len(order))
    while len(todo):
        g = group[todo]
        first = np.append(True, g[1:] != g[:-1])
        pivot = todo[np.flatnonzero(first)[np.cumsum(first) - 1]]
        a, b = windows[order[todo]], windows[order[pivot]]
        d = shift[a % PERIOD, b % PERIOD]
        same = rank[index[a + d]] == rank[index[b + d]]
        for offset in (*front, *back):
            some = np.flatnonzero(same)
            same[some] = word[a[some] + offset] == word[b[some] + offset]
        classes[order[todo[same]]] = order[pivot[same]]
        todo = todo[~same]
    return classes


def _suffix_bucket(length: int):
    def bucket(rows: list[tuple]) -> Iterator[tuple]:
        # Where each string of a minimiser occurs more than once, all of them are repeated whole.
        once = {mini for mini, *_, times in rows if times < 2}
        for mini, packed, docs, starts, _ in rows:
            if mini not in once:
                for doc, start in zip(docs, starts, strict=True):
                    yield (doc, start, start + len(packed))
        rows = [row for row in rows if row[0] in once]
        if rows:
            yield from sort(rows)

    def sort(rows: list[tuple]) -> Iterator[tuple]:
        text = b"".join(packed for _, packed, *_ in rows)
        sizes = np.array([len(packed) for _, packed, *_ in rows])
        counts = sizes - length + 1
        ends = np.cumsum(counts)
        base = np.cumsum(sizes) - sizes
        windows = np.arange(ends[-1]) + np.repeat(base - (ends - counts), counts)
        minis = np.repeat(np.array([mini for mini, *_ in rows], np.int64), counts)
        times = np.repeat(np.array([n for *_, n in rows]), counts)
        classes = equal_windows(text, windows, minis, length)
        again = np.bincount(classes, weights=times, minlength=len(windows))[classes] > 1
        for (_, _, docs, starts, _), first, count in zip(rows, (ends - counts).tolist(), counts.tolist(), strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate([[False], again[first : first + count], [False]])))
            for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True):
                for doc, start in zip(docs, starts, strict=True):
                    yield (doc, start + a, start + b + length - 1)

    return bucket


def _inward(text: bytes, a: int, b: int) -> tuple[int, int]:
    """The range without the rest of a character at its start and the beginning of one at its end."""
    while a < b and text[a] & 0xC0 == 0x80:
        a += 1
    while a < b < len(text) and text[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def drop_repeated_bytes(
    df: DataFrame, id_col: str, text_col: str, length: int = 400, whole_characters: bool = False, least_words: int = 0, least_bytes: int = 0
) -> DataFrame:
    """Remove each byte that lies in a string of ``length`` bytes which also starts anywhere else.

    Adds n_bytes, n_removed, spans (maximal removed runs as structs from, to) and kept
    (binary: the remaining bytes) to all rows. Matches never cross documents, may overlap
    and may lie in one document; all are judged on the input. Only strings whose
    minimiser occurs again are brought together; there suffixes are sorted bucket by
    bucket and long ties resolved by ranks of a difference cover. With
    ``whole_characters`` a UTF-8 character goes only if all its bytes are covered. A
    maximal run that has fewer than ``least_words`` words, parts of words included, and
    fewer than ``least_bytes`` bytes stays; repeated strings that overlap or touch form one run.

    ``length`` is at least 160. Ids are of an integer type. Null text counts as empty; a
    row of null id keeps all its bytes and takes no part. Rows that repeat an id and a
    text are copies of each other; where the texts differ each loses the ranges found for
    any of them. Columns named like an added one are replaced; ``_ranges`` and ``_doc``
    are reserved.
    """
    if length < 160:
        raise ValueError("length must be at least 160 bytes")
    ranges = repeated_ranges(df, id_col, text_col, Bytes, length, GRAM, _suffix_bucket(length), False, 1 << 19)
    added = {"n_bytes": "long", "n_removed": "long", "spans": "array<struct<from:long,to:long>>", "kept": "binary"}
    source = with_ranges(df.drop(*added), id_col, ranges)
    schema = source.drop("_ranges").withColumns({k: F.lit(None).cast(v) for k, v in added.items()}).schema
    span_type = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for batch in small(large, text_col):
                sizes, removed, spans, kept = [], [], [], []
                for text, found in zip(batch[text_col].cast(pa.binary()).to_pylist(), batch["_ranges"].to_pylist(), strict=True):
                    text = text or b""
                    out = merged(found, len(text))
                    if whole_characters:
                        out = [(a, b) for a, b in (_inward(text, a, b) for a, b in out) if a < b]
                    out = [(a, b) for a, b in out if b - a >= least_bytes or len(text[a:b].split()) >= least_words]
                    edges = [0, *(x for r in out for x in r), len(text)]
                    rest = b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2], strict=True))
                    sizes.append(len(text))
                    removed.append(len(text) - len(rest))
                    spans.append([{"from": a, "to": b} for a, b in out])
                    kept.append(rest)
                names = [n for n in batch.schema.names if n != "_ranges"]
                yield pa.RecordBatch.from_arrays([
                    *(batch[n] for n in names), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span_type), pa.array(kept, pa.binary()),
                ], names=[*names, *added])

    return source.mapInArrow(released(run), schema)
