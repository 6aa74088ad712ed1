"""Near-duplicate texts: SuperMinHash signatures, banding, verification on full sets, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm import bloom
from sparkpanel.llm.arrow import released, small
from sparkpanel.llm.components import components
from sparkpanel.llm.staging import staged
from sparkpanel.llm.units import Words, mix, run_hashes

BANDS, ROWS = 32, 5
SIZE = BANDS * ROWS
#: Members of a bucket that are compared with each other in one task.
BLOCK = 1000
#: Rounds in which every bucket compares its members with one of them.
ROUNDS = 2
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of each text, sorted by text and hash, and the text of each.

    A-Z are lower-cased. A text of fewer words is one shingle, one without words has none.
    """
    units = Words([t.translate(_LOWER) for t in texts])
    size = np.diff(units.first)
    count = np.where(size >= words, size - words + 1, (size > 0).astype(np.int64))
    text = np.repeat(np.arange(len(texts)), count)
    start = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + units.first[text]
    stop = np.minimum(start + words, units.first[text + 1])
    h = run_hashes(units.h, start, stop)
    h[size[text] < words] += np.uint64(1)  # a short text equals no shingle of a longer one
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], text[new]


def superminhash(h: np.ndarray, text: np.ndarray, texts: int, size: int = SIZE) -> np.ndarray:
    """Signature rows of the sets that ``h`` and ``text`` list; infinite for an empty set.

    Every element shuffles the signature's places one by one, and in step j offers j plus
    a random fraction to the place it draws. Elements of a set stop once all of its places
    hold less than what further steps could offer.
    """
    signature = np.full(texts * size, np.inf)
    places = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.int32), (len(h), 1))
    active = np.arange(len(h))
    for j in range(size):
        draw = mix(h[active] + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        other = j + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(size - j) >> np.uint64(32)).astype(np.int64)
        place = places[active, other]
        places[active, other] = places[active, j]
        offer = (draw >> np.uint64(32)).astype(np.float64) / 2.0**32 + j
        np.minimum.at(signature, text[active] * size + place, offer)
        worst = signature.reshape(texts, size).max(axis=1)
        active = active[worst[text[active]] > j + 1]
        if not len(active):
            break
    return signature.reshape(texts, size)


_SIGNED = pa.schema([
    ("id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64())),
])


def _sign_task(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for batch in small(large, "text", 1 << 19):
                texts = [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]
                h, text = shingles(texts, words)
                signature = superminhash(h, text, len(texts))
                bits = mix(signature.view(np.uint64).reshape(signature.shape))
                band = bits.reshape(len(texts), BANDS, ROWS)
                key = np.repeat(np.arange(BANDS, dtype=np.uint64)[None, :], len(texts), axis=0)
                for r in range(ROWS):
                    key = mix(key * np.uint64(31) + band[:, :, r])
                n = np.bincount(text, minlength=len(texts))
                digests = []
                for salt in (1, 2):
                    total = np.zeros(len(texts) + 1, np.uint64)
                    part = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + np.uint64(salt)))])
                    ends = np.cumsum(n)
                    total = part[ends] - part[ends - n]
                    digests.append(total.view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    batch["id"], pa.array(n.astype(np.int64)), *map(pa.array, digests),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, len(texts) * BANDS + 1, BANDS, dtype=np.int32)), pa.array(key.ravel().view(np.int64))),
                ], schema=_SIGNED)

    return run


def _verify_task(words: int, percent: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for first in range(0, large.num_rows, 200):
                batch = large.slice(first, 200)
                u, v = batch["u"].to_pylist(), batch["v"].to_pylist()
                texts = {}
                for ids, column in ((u, "text_u"), (v, "text_v")):
                    for i, t in zip(ids, batch[column].cast(pa.binary()), strict=True):
                        if i not in texts:
                            texts[i] = t.as_py()
                ids = list(texts)
                h, text = shingles(list(texts.values()), words)
                edge = np.searchsorted(text, np.arange(len(ids) + 1))
                sets = {i: h[edge[k] : edge[k + 1]] for k, i in enumerate(ids)}
                found = []
                for a, b in zip(u, v, strict=True):
                    both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) > 0:
                        found.append((a, b))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=schema)

    return run


def _sets_task(words: int):
    """The shingles of each text as sorted numbers."""
    schema = pa.schema([("rep", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for batch in small(large, "text", 1 << 20):
                h, text = shingles([t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()], words)
                edge = np.searchsorted(text, np.arange(batch.num_rows + 1))
                sets = [h[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array(sets, pa.binary())], schema=schema)

    return run


def _block_task(percent: int):
    """Links between different components of two blocks: enough of them to join what they join, never all pairs.

    Intersections come from the list of members that each shingle has, for one member
    of the first block with all of the second at a time.
    """
    def run(table: pa.Table) -> pa.Table:
        rep, component, n, block = (table[c].to_numpy() for c in ("rep", "component", "n", "block"))
        left, right = np.flatnonzero(block == table["low"][0].as_py()), np.flatnonzero(block == table["high"][0].as_py())
        sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
        found = []
        if len(left) and len(right):
            every = np.concatenate([sets[i] for i in right])
            owner = np.repeat(np.arange(len(right)), [len(sets[i]) for i in right])
            order = np.argsort(every, kind="stable")
            every, owner = every[order], owner[order]
            labels = dict(zip(component.tolist(), component.tolist(), strict=True))

            def root(x):
                while labels[x] != x:
                    labels[x] = labels[labels[x]]
                    x = labels[x]
                return x

            size = n[right]
            for a in left:
                first, last = np.searchsorted(every, sets[a], "left"), np.searchsorted(every, sets[a], "right")
                count = last - first
                at = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
                both = np.bincount(owner[at], minlength=len(right))
                near = np.flatnonzero((100 * both >= percent * (n[a] + size - both)) & (component[right] != component[a]))
                for b in near[np.unique(component[right[near]], return_index=True)[1]] if len(near) else []:
                    x, y = root(component[a].item()), root(component[right[b]].item())
                    if x != y:
                        labels[max(x, y)] = min(x, y)
                        found.append(sorted((rep[a].item(), rep[right[b]].item())))
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    return run


def near_duplicates(df: DataFrame, id_col: str, text_col: str, words: int = 5, percent: int = 80) -> DataFrame:
    """Group texts whose sets of ``words``-word shingles have a Jaccard similarity of at least ``percent`` in 100.

    Adds n_shingles, component_id (smallest id that links reach, itself included) and
    kept (the row's id is component_id) to all rows.

    Texts with equal sets form a class, and each class is compared by its smallest id.
    Its SuperMinHash signature of 160 values gives 32 band keys; two sets of similarity
    0.8 share none with a probability of 3 in a million. Links are confirmed on the full
    sets. Each bucket first compares its members with one of them, in two rounds with
    another one each. In buckets that still hold several components the members outside
    the largest one then meet all others, in blocks of 1,000, which give links that join
    components and never all pairs. So a group of copies costs links in proportion to its
    members, and no link between two components is left out.

    Ids are of an integer type. Null and empty texts have no shingles and link with
    nothing; so does a row of null id. Rows that repeat an id are one document: what
    links one of them links all. Columns named like an added one are replaced; names that
    start with an underscore are reserved.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    signed = staged(rows.mapInArrow(released(_sign_task(words)), "id long, n_shingles long, d1 long, d2 long, bands array<long>"), "signatures")
    classes = staged(
        signed.filter("n_shingles > 0").groupBy("n_shingles", "d1", "d2")
        .agg(F.min("id").alias("rep"), F.first("bands").alias("bands")), "classes"
    )
    keyed = classes.select(F.explode("bands").alias("key"), "rep", F.col("n_shingles").alias("n"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = staged(keyed.join(shared.select("key"), "key"), "buckets")

    # Texts of the classes that share a bucket; others are held back by a filter of bounded size.
    wanted = staged(buckets.select(F.col("rep").alias("id")).distinct().withColumn("_h", F.xxhash64("id")), "wanted")
    blocks = bloom.block_count(wanted.count())
    held = staged(bloom.filter_of(wanted, "_h", blocks), "filter")
    some = bloom.might_hold(rows.withColumn("_h", F.xxhash64("id")), "_h", held, blocks, "_maybe").filter("_maybe")
    texts = staged(some.select("id", "text").join(wanted.select("id"), "id", "left_semi"), "texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("text_u")), "u")
        both = both.join(texts.select(F.col("id").alias("v"), F.col("text").alias("text_v")), "v").select("u", "v", "text_u", "text_v")
        return staged(both.mapInArrow(released(_verify_task(words, percent)), "u long, v long").distinct(), "confirmed")

    links, tested, labels = None, None, None
    ratio = 100 * F.least("n", "c.n") >= percent * F.greatest("n", "c.n")

    def labelled() -> DataFrame:
        if labels is None:
            return buckets.withColumn("component", F.col("rep"))
        known = labels.select(F.col("id").alias("rep"), "component")
        return buckets.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    for round_number in range(ROUNDS):
        now = staged(labelled(), "labelled")
        first = F.col("rep") if round_number == 0 else F.xxhash64("rep", F.lit(round_number))
        centre = now.groupBy("key").agg(
            F.min_by(F.struct("rep", "component", "n"), first).alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi")
        ).filter("lo < hi").select("key", "c")
        # Written, so that the join has both sides shuffled for itself and a frequent key can be split.
        centre = staged(centre, "centres")
        pairs = now.join(centre, "key").filter(ratio & (F.col("component") != F.col("c.component"))).select(
            F.least("rep", "c.rep").alias("u"), F.greatest("rep", "c.rep").alias("v")
        ).distinct()
        pairs = staged(pairs if tested is None else pairs.join(tested, ["u", "v"], "left_anti"), "pairs")
        tested = pairs
        new = confirmed(pairs)
        links = new if links is None else links.unionByName(new)
        if round_number == 0 or not new.isEmpty():
            labels = components(links)

    # What is left of mixed buckets: the members outside the largest component, in blocks, meet all others.
    now = staged(labelled(), "labelled")
    sizes = now.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    mixed = sizes.groupBy("key").agg(
        F.max(F.struct("size", "component")).alias("most"), F.sum("size").alias("total"), F.count(F.lit(1)).alias("parts")
    ).filter("parts > 1").select(
        "key", F.col("most.component").alias("major"), F.ceil((F.col("total") - F.col("most.size")) / BLOCK).cast("int").alias("minor_blocks"),
        F.ceil(F.col("most.size") / BLOCK).cast("int").alias("major_blocks"),
    )
    is_major, spread = F.col("component") == F.col("major"), F.xxhash64("rep")
    block = F.when(is_major, F.col("minor_blocks") + F.pmod(spread, F.col("major_blocks"))).otherwise(F.pmod(spread, F.col("minor_blocks")))
    others = F.col("minor_blocks") + F.when(is_major, 0).otherwise(F.col("major_blocks")) - 1
    sets = texts.mapInArrow(released(_sets_task(words)), "rep long, shingles binary")
    members = now.join(mixed, "key").select("key", "rep", "component", "n", block.cast("int").alias("block"), F.explode(F.sequence(F.lit(0), others)).alias("other"))
    met = members.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other").join(sets, "rep")
    pairs = staged(met.groupBy("key", "low", "high").applyInArrow(_block_task(percent), "u long, v long").distinct(), "pairs")
    new = confirmed(pairs)
    if not new.isEmpty():
        links = links.unionByName(new)
        labels = components(links)

    known = classes.select("n_shingles", "d1", "d2", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "n_shingles", "d1", "d2", F.coalesce("component", "rep").alias("_component")
    )
    # Every row finds its class by the shingles of its text; equal ids have been signed alike or apart, by text.
    ids = signed.select("id", "n_shingles", "d1", "d2").join(known, ["n_shingles", "d1", "d2"], "left")
    each = ids.groupBy("id").agg(F.max("n_shingles").alias("_n"), F.min(F.coalesce("_component", "id")).alias("_component"))
    source = df.drop("n_shingles", "component_id", "kept")
    return source.join(each.withColumnRenamed("id", "_id"), F.col(id_col).cast("long") == F.col("_id"), "left").withColumns({
        "n_shingles": F.coalesce("_n", F.lit(0).cast("long")), "component_id": F.coalesce("_component", F.col(id_col).cast("long")),
    }).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))).drop("_id", "_n", "_component")
