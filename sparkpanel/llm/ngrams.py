"""Hashed character n-grams of whole texts, their document frequencies, and TF-IDF rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm.arrow import batched, released, small
from sparkpanel.llm.units import LETTER, characters, grams, sums

DIMS = 1 << 15
ORDERS = (1, 2, 3)


def rows(texts: list[str], lower: bool, dims: int = DIMS) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """For each text the n-gram numbers that occur, how often, and whether it has a letter.

    With ``lower`` only letters count, in lower case; whatever stands between them is one
    and the same character.
    """
    code = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)
    classes, folded = characters()
    bounded = np.minimum(code, 65535)
    h = folded[bounded] if lower else code.astype(np.uint64) + np.uint64(1)
    far = code > 65535
    if lower:
        h = np.where(far, code.astype(np.uint64), np.where(classes[bounded] == LETTER, h, np.uint64(0)))
    prefix = sums(h)
    n = len(code)
    numbers = {k: (grams(prefix, slice(0, max(0, n - k + 1)), slice(k, max(k, n + 1))) & np.uint64(dims - 1)).astype(np.int32) for k in ORDERS}
    letters = np.concatenate([[0], np.cumsum((classes[bounded] == LETTER) & ~far)])
    at = 0
    for text in texts:
        end = at + len(text)
        count = np.bincount(np.concatenate([numbers[k][at : max(at, end - k + 1)] for k in ORDERS]), minlength=dims)
        some = np.flatnonzero(count)
        letter = letters[end] > letters[at] or any(c.isalpha() for c in (text if far[at:end].any() else ""))
        yield some, count[some], bool(letter)
        at = end + 1


def tfidf(texts: list[str], idf: np.ndarray, lower: bool) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """For each text its n-gram numbers, their TF-IDF at unit length (1 + log of the count), and whether it has a letter."""
    for some, count, letter in rows(texts, lower):
        x = (1 + np.log(count)) * idf[some]
        yield some, x / max(np.sqrt(x @ x), 1e-12), letter


def texts_of(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of about half a megabyte with their texts, null as empty."""
    for large in batches:
        for batch in small(large, column, 1 << 19):
            yield batch, [t or "" for t in batch[column].to_pylist()]


def inverse_frequencies(docs: DataFrame, lower: bool) -> np.ndarray:
    """IDF of each n-gram number over all rows of ``docs`` (column text). A task sends one row of counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(DIMS, np.int64), 0
        for _, texts in texts_of(batches):
            for some, _, _ in rows(texts, lower):
                counts[some] += 1
                n += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(counts[some], n))], names=["gram", "n"])

    total = docs.select("text").mapInArrow(released(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()  # DIMS rows at most
    counts = np.zeros(DIMS)
    documents = 0
    for r in total:
        if r["gram"] < 0:
            documents = r["n"]
        else:
            counts[r["gram"]] = r["n"]
    return np.log((1 + documents) / (1 + counts)) + 1


def vectors(docs: DataFrame, label: str, featurise) -> list[tuple[object, np.ndarray, np.ndarray]]:
    """(label, numbers, values) of every row of a bounded table, on the driver: four bytes for each number.

    ``featurise``: from a list of texts to an iterator of (numbers, values, has a letter).
    """
    kind = docs.schema[label].dataType.simpleString()
    schema = pa.schema([("label", pa.string()), ("at", pa.binary()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for batch, texts in texts_of(batches):
                for y, (some, x, _) in zip(batch["label"].to_pylist(), featurise(texts), strict=True):
                    yield (y, some.astype(np.uint16).tobytes(), x.astype(np.float16).tobytes())

        return batched(made(), schema)

    found = docs.select(F.col(label).cast("string").alias("label"), "text").mapInArrow(released(run), "label string, at binary, x binary").collect()
    change = int if kind in ("int", "bigint") else str
    # An order that depends on the rows alone.
    found.sort(key=lambda r: (r["label"], zlib.crc32(r["at"]), zlib.crc32(r["x"])))
    return [(change(r["label"]), np.frombuffer(r["at"], np.uint16), np.frombuffer(r["x"], np.float16)) for r in found]
