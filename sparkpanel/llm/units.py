"""Texts of a slice as one array of hashed units, either words or bytes."""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

#: Bytes that separate words: space and the control characters from tab to carriage return.
SEPARATORS = b" \t\n\x0b\x0c\r"
_BASE = 0x9E3779B97F4A7C15
_SECOND = 0xC2B2AE3D27D4EB4F


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64 bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def _byte_hash() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


SPACE, LETTER, DIGIT, SYMBOL = range(4)


def class_of(c: str) -> int:
    kind = unicodedata.category(c)[0]
    return SPACE if c.isspace() else LETTER if kind == "L" else DIGIT if kind == "N" else SYMBOL


@cache
def lowered() -> np.ndarray:
    """The first 65,536 characters in lower case, where that is one character."""
    return np.array([ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(map(chr, range(65536)))], np.uint32)


@cache
def characters() -> tuple[np.ndarray, np.ndarray]:
    """For the first 65,536 characters their class, and a hash that is alike for both cases."""
    return np.array([class_of(chr(i)) for i in range(65536)], np.uint8), mix(lowered().astype(np.uint64) + np.uint64(1))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64: ``size`` of them at least, kept for the next slice."""
    def powers(b):
        out = np.full(size, b, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    if base not in _POWERS or len(_POWERS[base][0]) < size:
        _POWERS[base] = powers(base), powers(pow(base, -1, 1 << 64))
    return _POWERS[base]


def sums(h: np.ndarray, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which ``grams`` takes the hash of a short run of units.

    A polynomial modulo 2^64: runs from about a thousand units on can collide by their
    pattern alone. ``run_hashes`` has no such runs.
    """
    power, inverse = _powers(base, len(h) + len(h) // 8 + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * power[: len(h)], out=total[1:])
    return total, inverse


def grams(prefix: tuple[np.ndarray, np.ndarray], starts: np.ndarray | slice, stops: np.ndarray | slice) -> np.ndarray:
    """Hash of each run of units from start up to stop."""
    total, inverse = prefix
    at = inverse[: len(total)][starts] if isinstance(starts, slice) else inverse[starts]
    return mix((total[stops] - total[starts]) * at)


#: Runs are hashed by stretches of so many units.
STRETCH = 32


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order. Not linear, so that no pattern of units cancels out."""
    x = b * np.uint64(_SECOND)
    x += a
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def stretches(h: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of each ``size`` consecutive units, by doubling; two overlapping halves where that is no power of two."""
    if len(h) < size:
        return h[:0]
    t, span = h ^ mix(np.array([seed], np.uint64))[0], 1
    while 2 * span <= size:
        t = _joined(t[:-span], t[span:])
        span *= 2
    return t if span == size else _joined(t[: len(h) - size + 1], t[size - span :])


def long_runs(t: np.ndarray, starts: np.ndarray, stops: np.ndarray, size: int) -> np.ndarray:
    """Hash of runs of ``size`` units or more, from the hashes ``t`` of their stretches.

    The stretches follow each other and the last one ends the run, so every unit is in one;
    each is mixed with its place and they are added up.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    count = -(-(stops - starts) // size)
    end = np.cumsum(count)
    place = np.arange(end[-1]) - np.repeat(end - count, count)
    at = np.minimum(np.repeat(starts, count) + place * size, np.repeat(stops - size, count))
    parts = mix(t[at] + place.astype(np.uint64) * np.uint64(_BASE))
    return mix(np.add.reduceat(parts, end - count) + (stops - starts).astype(np.uint64))


def run_hashes(h: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each run of one or more units from start up to stop, alike wherever the run stands."""
    size = stops - starts
    out = np.zeros(len(starts), np.uint64)
    t, span = h ^ mix(np.array([seed], np.uint64))[0], 1
    longest = int(size.max()) if len(size) else 0
    while span <= longest:
        # Two windows of the largest power of two that fits cover the run.
        some = np.flatnonzero((size >= span) & ((size < 2 * span) if span < STRETCH else (size < 2 * STRETCH)))
        out[some] = mix(_joined(t[starts[some]], t[stops[some] - span]) + size[some].astype(np.uint64))
        if span == STRETCH:
            some = np.flatnonzero(size >= 2 * STRETCH)
            out[some] = long_runs(t, starts[some], stops[some], STRETCH)
            break
        if 2 * span > longest:
            break
        t = _joined(t[:-span], t[span:])
        span *= 2
    return out


class Words:
    """Maximal runs of bytes that are no separator. ``first`` has each text's first word, and the end."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        is_sep = np.zeros(256, bool)
        is_sep[list(SEPARATORS)] = True
        sep = np.ones(len(raw) + 2, bool)
        sep[1:-1] = is_sep[raw]
        edges = np.flatnonzero(sep[1:] != sep[:-1])
        starts, stops = edges[0::2], edges[1::2]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.first = np.searchsorted(starts, begins)
        self.h = run_hashes(_byte_hash()[raw], starts, stops)
        # The words with one space after each.
        keep = ~sep[1:-1]
        keep[stops] = True
        self.text = np.where(sep[1:-1], np.uint8(32), raw)[keep].tobytes()
        self.at = np.concatenate([[0], np.cumsum(stops - starts + 1)])

    def packed(self, a: int, b: int) -> bytes:
        return self.text[self.at[a] : self.at[b] - 1]


class Bytes:
    """Single bytes."""

    def __init__(self, texts: list[bytes]):
        self.text = b"".join(texts)
        self.first = np.cumsum([0, *map(len, texts)])
        self.h = _byte_hash()[np.frombuffer(self.text, np.uint8)]

    def packed(self, a: int, b: int) -> bytes:
        return self.text[a:b]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    rows = -(-len(x) // width)
    block = np.full(rows * width, np.iinfo(x.dtype).max, x.dtype)
    block[: len(x)] = x
    block = block.reshape(rows, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


class Runs:
    """Maximal runs of consecutive windows of one text that share their minimiser.

    ``start`` (unit), ``count`` (windows), ``text`` (index), ``mini`` (int64), ``whole`` (hash
    of the run's units) and ``tied`` (whether the least gram stands at more than one place).
    """

    def __init__(self, units, window: int, gram: int):
        low = np.uint64((1 << 24) - 1)
        self.gram = gram
        self.stretches = stretches(units.h, gram)
        n = len(self.stretches)
        g = mix(self.stretches) & ~low
        place = np.arange(n, dtype=np.uint64) & low
        left = sliding_min(g | place, window - gram + 1)
        right = low - (sliding_min(g | (low - place), window - gram + 1) & low)
        size = np.diff(units.first)
        has = np.flatnonzero(size >= window)
        counts = size[has] - window + 1
        # Windows that lie in one text.
        offset = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(offset[-1]) + np.repeat(units.first[:-1][has] - offset[:-1], counts)
        value = left[at] & ~low
        new = np.ones(len(at), bool)
        new[1:] = value[1:] != value[:-1]
        new[offset[:-1]] = True
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(at))
        self.start, self.count = at[begin], end - begin
        self.text = has[np.searchsorted(offset, begin, "right") - 1] if len(begin) else begin
        self.mini = mix(value[begin]).view(np.int64)
        self.whole = long_runs(self.stretches, self.start, self.start + self.count + window - 1, gram).view(np.int64)
        self.tied = (left[at[begin]] & low) != right[at[end - 1]] if len(begin) else np.zeros(0, bool)

    def window_hashes(self, units, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes, of different seeds from the units on, of the windows that begin at ``starts``."""
        second = stretches(units.h, self.gram, 1)
        return tuple(long_runs(t, starts, starts + window, self.gram).view(np.int64) for t in (self.stretches, second))
