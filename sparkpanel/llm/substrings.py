"""Removal of runs of words that stand in an earlier document."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm.arrow import released, small
from sparkpanel.llm.repeats import merged, repeated_ranges, with_ranges
from sparkpanel.llm.units import Words

GRAM = 8


def _sorted_windows(window: int):
    """For each string the windows that also start in a document of smaller id, by sorting all windows."""
    def bucket(rows: list[tuple]) -> Iterator[tuple]:
        # Windows of a string that has its minimiser to itself stand in the documents of that string alone.
        strings = Counter(mini for mini, *_ in rows)
        for mini, packed, docs, starts, _ in rows:
            if strings[mini] == 1:
                lowest, length = min(docs), packed.count(b" ") + 1
                yield from ((doc, start, start + length) for doc, start in zip(docs, starts, strict=True) if doc > lowest)
        rows = [row for row in rows if strings[row[0]] > 1]
        entries, sizes = [], []
        for i, (mini, packed, docs, _, _) in enumerate(rows):
            edges = [-1]
            edge = packed.find(b" ")
            while edge >= 0:
                edges.append(edge)
                edge = packed.find(b" ", edge + 1)
            edges.append(len(packed))
            lowest = min(docs)
            n = len(edges) - window
            sizes.append(n)
            entries += [(mini, packed[edges[j] + 1 : edges[j + window]], lowest, i, j) for j in range(n)]
        entries.sort()
        least = [[0] * n for n in sizes]
        before, lowest = (None, None), 0
        for mini, content, doc, i, j in entries:
            if (mini, content) != before:
                before, lowest = (mini, content), doc
            least[i][j] = lowest
        for (_, _, docs, starts, _), low in zip(rows, least, strict=True):
            bounds = [(a, b, x) for a, b, x in _level_runs(low)]
            for doc, start in zip(docs, starts, strict=True):
                for a, b, x in bounds:
                    if x < doc:
                        yield (doc, start + a, start + b + window - 1)

    return bucket


def _level_runs(values: list[int]) -> Iterator[tuple[int, int, int]]:
    a = 0
    for b in range(1, len(values) + 1):
        if b == len(values) or values[b] != values[a]:
            yield a, b, values[a]
            a = b


def drop_repeated_words(df: DataFrame, id_col: str, text_col: str, window: int = 50) -> DataFrame:
    """Remove each word that lies in a window of ``window`` words which also starts in a document of smaller id.

    Adds n_words, n_removed and kept_text (remaining words joined by one space) to all
    rows. Words are maximal runs of bytes other than space and tab to carriage return.
    Windows are judged on the input. Super-k-mers bring equal windows together, where
    sorting the windows themselves finds the smallest id for each.

    Ids are of an integer type. Null text has no words; a row of null id keeps all its
    words and takes no part. Rows that repeat an id count as one document: they remove
    nothing from each other, and each loses the ranges found for any of them. Columns
    named like an added one are replaced; ``_ranges`` and ``_doc`` are reserved. A text
    is held whole in one task, at about forty times its size.
    """
    ranges = repeated_ranges(df, id_col, text_col, Words, window, min(GRAM, window), _sorted_windows(window), True, 1 << 18)
    added = ["n_words", "n_removed", "kept_text"]
    source = with_ranges(df.drop(*added), id_col, ranges)
    empty = F.lit(None)
    schema = source.drop("_ranges").withColumns({"n_words": empty.cast("long"), "n_removed": empty.cast("long"), "kept_text": empty.cast("string")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for batch in small(large, text_col):
                sizes, removed, kept = [], [], []
                for text, found in zip(batch[text_col].cast(pa.binary()).to_pylist(), batch["_ranges"].to_pylist(), strict=True):
                    words = (text or b"").split()
                    sizes.append(len(words))
                    out = merged(found, len(words))
                    for a, b in reversed(out):
                        del words[a:b]
                    removed.append(sizes[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                names = [n for n in batch.schema.names if n != "_ranges"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch[n] for n in names), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    names=[*names, *added],
                )

    return source.mapInArrow(released(run), schema)
