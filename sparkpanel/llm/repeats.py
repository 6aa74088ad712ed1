"""Windows that occur more than once, found by super-k-mers.

A window's minimiser is the least hash of the grams inside it, so equal windows have
equal minimisers. Consecutive windows that share one form a run, which can travel to
the minimiser's bucket as one string.

First each run's minimiser and string are counted. Only runs whose minimiser occurs
again can hold repeated windows; they are recognised in a second read by a Bloom filter
of bounded size (a larger corpus fills it, and more runs travel than need to).

Two kinds of frequent minimisers are kept out of the buckets. Where one string makes up
most runs, its copies are judged where they are read, against a broadcast list of at
most ``LISTED`` strings; only its copy in the smallest document travels. Where there are
more than ``HOT`` different strings, told by a second filter, their windows go one by
one, as hashes that are aggregated in each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkpanel.llm import bloom
from sparkpanel.llm.arrow import batched, released, small
from sparkpanel.llm.staging import staged
from sparkpanel.llm.units import Runs

#: Different strings of one minimiser that may meet in a bucket.
HOT = 5000
#: Copies of a string that may travel, unless more than ``LISTED`` strings have more.
COPIES = 200
LISTED = 200_000
SLICE = 1 << 19
SENT = pa.schema([
    ("mini", pa.int64()), ("packed", pa.binary()), ("docs", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("times", pa.int64()),
    ("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()),
])
SENT_DDL = "mini long, packed binary, docs array<long>, starts array<long>, times long, h1 long, h2 long, doc long, start long, stop long"
RANGES = pa.schema([("doc", pa.int64()), ("from", pa.int64()), ("to", pa.int64())])
RANGES_DDL = "doc long, from long, to long"
#: Longer texts of bytes are cut into overlapping segments.
SEGMENT = 1 << 23


def _slices(batches: Iterator[pa.RecordBatch], kind, window: int) -> Iterator[tuple]:
    """Units, ids and the place in its text of each segment of a slice."""
    from sparkpanel.llm.units import Bytes

    for large in batches:
        for batch in small(large, "text", SLICE):
            docs, bases, texts = [], [], []
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist(), strict=True):
                step = SEGMENT if kind is Bytes else max(1, len(text))
                for base in range(0, max(1, len(text) - window + 1), step):
                    docs.append(doc)
                    bases.append(base)
                    texts.append(text[base : base + step + window - 1])
            yield kind(texts), np.array(docs, np.int64), np.array(bases, np.int64)


def _count_task(kind, window: int, gram: int):
    schema = pa.schema([("mini", pa.int64()), ("whole", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for units, docs, _ in _slices(batches, kind, window):
            runs = Runs(units, window, gram)
            if not len(runs.mini):
                continue
            order = np.lexsort((runs.whole, runs.mini))
            mini, whole, doc, weight = runs.mini[order], runs.whole[order], docs[runs.text[order]], 1 + runs.tied[order].astype(np.int64)
            at = np.flatnonzero(np.append(True, (mini[1:] != mini[:-1]) | (whole[1:] != whole[:-1])))
            yield pa.RecordBatch.from_arrays([
                pa.array(mini[at]), pa.array(whole[at]), pa.array(np.minimum.reduceat(doc, at)), pa.array(np.maximum.reduceat(doc, at)),
                pa.array(np.add.reduceat(weight, at)),
            ], schema=schema)

    return run


class _Listed:
    """The frequent strings: minimiser, hash, smallest document and copies, sorted by minimiser."""

    def __init__(self, rows: list):
        rows = sorted((r["mini"], r["top"]["whole"], r["top"]["lo"], r["top"]["n"]) for r in rows)
        self.mini, self.whole, self.lo, self.n = (np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else [[]] * 4))

    def copies(self, mini: np.ndarray, whole: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Copies of the run's string (1 if it is not listed), and whether it is one in a larger document than the first."""
        if not len(self.mini):
            return np.ones(len(mini), np.int64), np.zeros(len(mini), bool)
        at = np.minimum(np.searchsorted(self.mini, mini), len(self.mini) - 1)
        listed = (self.mini[at] == mini) & (self.whole[at] == whole)
        return np.where(listed, self.n[at], 1), listed & (doc > self.lo[at])


def _send_task(kind, window: int, gram: int, shared, hot, frequent):
    def columns(n: int, **given: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(given[f.name]) if f.name in given else pa.nulls(n, f.type) for f in SENT], schema=SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for units, docs, bases in _slices(batches, kind, window):
            runs = Runs(units, window, gram)
            wanted = np.flatnonzero(shared.value.might_hold(runs.mini))
            doc = docs[runs.text]
            place = runs.start - units.first[runs.text] + bases[runs.text]
            times, copy = frequent.value.copies(runs.mini[wanted], runs.whole[wanted], doc[wanted])
            some = wanted[copy]
            if len(some):
                yield columns(len(some), doc=doc[some], start=place[some], stop=place[some] + runs.count[some] + window - 1)
            wanted, times = wanted[~copy], times[~copy]
            single = hot.value.might_hold(runs.mini[wanted])
            some = wanted[single]
            if len(some):
                count = runs.count[some]
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                h1, h2 = runs.window_hashes(units, np.repeat(runs.start[some], count) + step, window)
                yield columns(len(step), h1=h1, h2=h2, doc=np.repeat(doc[some], count), start=np.repeat(place[some], count) + step)
                # What is listed counts for its copies that were judged above.
                many = times[single] > 1
                if many.any():
                    again = np.repeat(many, count)
                    yield columns(int(again.sum()), h1=h1[again], h2=h2[again], doc=np.repeat(doc[some], count)[again])
            some, times = wanted[~single], times[~single]
            met: dict[tuple[int, bytes], tuple[list[int], list[int], list[int]]] = {}
            for mini, a, b, i, start, n in zip(
                runs.mini[some].tolist(), runs.start[some].tolist(), (runs.start[some] + runs.count[some] + window - 1).tolist(),
                doc[some].tolist(), place[some].tolist(), times.tolist(), strict=True,
            ):
                ids, starts, counts = met.setdefault((mini, units.packed(a, b)), ([], [], []))
                ids.append(i)
                starts.append(start)
                counts.append(n)
            yield from batched(
                ((mini, packed, ids, starts, max(len(ids), *counts), *[None] * 5) for (mini, packed), (ids, starts, counts) in met.items()), SENT
            )

    return run


def _buckets(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple]]:
    """Distinct strings (mini, packed, docs, starts, times) of some whole minimisers, about ``most`` bytes at once."""
    held: dict[tuple[int, bytes], list] = {}
    size, last = 0, None
    for batch in batches:
        for mini, packed, docs, starts, times in zip(*(batch[c].to_pylist() for c in ("mini", "packed", "docs", "starts", "times")), strict=True):
            if mini != last and size >= most:
                yield [(*k, *v) for k, v in held.items()]
                held, size = {}, 0
            last = mini
            found = held.get((mini, packed))
            if found:
                found[0] += docs
                found[1] += starts
                found[2] += times
            else:
                held[mini, packed] = [docs, starts, times]
                size += len(packed)
    if held:
        yield [(*k, *v) for k, v in held.items()]


def repeated_ranges(
    df: DataFrame, id_col: str, text_col: str, kind, window: int, gram: int, bucket: Callable[[list[tuple]], Iterator[tuple]],
    other_document: bool, bucket_bytes: int,
) -> DataFrame:
    """Ranges (doc, from, to) of units that repeated windows cover.

    ``other_document``: a window counts if it also starts in a document of smaller id;
    otherwise if it starts anywhere else. ``bucket`` gets the strings of some whole
    minimisers and yields the ranges by the same rule.
    """
    sc = df.sparkSession.sparkContext
    rows = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).filter("doc is not null and text is not null")
    counted = rows.mapInArrow(released(_count_task(kind, window, gram)), "mini long, whole long, lo long, hi long, n long")
    strings = counted.groupBy("mini", "whole").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))
    minis = strings.groupBy("mini").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("strings"),
        F.max(F.struct("n", "whole", "lo")).alias("top"),
    )
    shared = staged(minis.filter("lo < hi" if other_document else "n > 1").select("mini", "n", "strings", "top"), "minimisers")
    size = shared.agg(F.count(F.lit(1)).alias("minis"), F.sum("n").alias("n")).first()
    blocks = bloom.block_count(size["minis"])
    filters = [
        sc.broadcast(bloom.LocalFilter(bloom.filter_of(x, "mini", blocks), blocks)) for x in (shared, shared.filter(F.col("strings") > HOT))
    ]
    # At most LISTED strings have this many copies.
    least = max(COPIES, (size["n"] or 0) // LISTED)
    frequent = sc.broadcast(_Listed(shared.filter(F.col("top.n") > least).select("mini", "top").collect()))
    sent = staged(rows.mapInArrow(released(_send_task(kind, window, gram, *filters, frequent)), SENT_DDL), "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _buckets(batches, bucket_bytes):
            yield from batched(bucket(held), RANGES)

    met = sent.filter("packed is not null").select("mini", "packed", "docs", "starts", "times").repartition("mini").sortWithinPartitions("mini")
    single = sent.filter("h1 is not null").select("h1", "h2", "doc", "start")
    windows = single.groupBy("h1", "h2").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count(F.lit(1)).alias("n"))
    again = staged(windows.filter("lo < hi" if other_document else "n > 1").select("h1", "h2", "lo"), "windows")
    found = single.filter("start is not null").join(again, ["h1", "h2"])
    if other_document:
        found = found.filter("doc > lo")
    # Neighbouring windows become one range. Rows that repeat an id give a start more than once, which has one rank.
    mark = F.col("start") - F.dense_rank().over(Window.partitionBy("doc").orderBy("start"))
    ranges = found.select("doc", "start").withColumn("g", mark).groupBy("doc", "g").agg(
        F.min("start").alias("from"), (F.max("start") + window).alias("to")
    ).drop("g")
    copies = sent.filter("stop is not null").select("doc", F.col("start").alias("from"), F.col("stop").alias("to"))
    return met.mapInArrow(released(run), RANGES_DDL).unionByName(ranges).unionByName(copies)


def with_ranges(df: DataFrame, id_col: str, ranges: DataFrame, name: str = "_ranges") -> DataFrame:
    """Add the ranges of each document, at most one for each of its units, as an array."""
    each = ranges.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias(name))
    return df.join(each.withColumnRenamed("doc", "_doc"), F.col(id_col).cast("long") == F.col("_doc"), "left").drop("_doc")


def merged(ranges: list[dict] | None, size: int) -> list[tuple[int, int]]:
    """Sorted ranges as maximal separate ones inside 0 to ``size``."""
    out: list[tuple[int, int]] = []
    for r in ranges or []:
        a, b = r["from"], min(r["to"], size)
        if a >= b:
            continue
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out
