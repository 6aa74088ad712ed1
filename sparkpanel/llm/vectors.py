"""Near-duplicate vectors: collisions counted over one-dimensional projections, then exact cosines."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm.arrow import batched
from sparkpanel.llm.components import components
from sparkpanel.llm.staging import staged

PROJECTIONS = 32
RECALL = 0.9999
BLOCK = 4096
SEED = 20_24
#: Projections lie within +-SPAN for almost all unit vectors; a step of the 256 codes:
SPAN = 4.0
STEP = 2 * SPAN / 255


def calibrated(cosine: float, projections: int = PROJECTIONS, recall: float = RECALL) -> tuple[float, int]:
    """Half-width of a window and the collisions that a pair of this cosine reaches with probability ``recall``.

    Two unit vectors at distance d differ by a normal variable of deviation d in each
    projection. The window catches 90 in 100 such pairs.
    """
    half = 1.645 * math.sqrt(2 - 2 * cosine)
    p = math.erf(1.645 / math.sqrt(2))
    tail, need = 0.0, projections + 1
    while need > 0 and tail < recall:
        need -= 1
        tail += math.comb(projections, need) * p**need * (1 - p) ** (projections - need)
    return half, need


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vector, projections and a key of equal vectors; null where the vector can't be compared."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.binary()), ("dim", pa.int32()), ("unit", pa.binary()), ("place", pa.float64()), ("codes", pa.binary())])
    planes: dict[int, np.ndarray] = {}

    def rows():
        for batch in batches:
            for i, vector in zip(batch["id"].to_pylist(), batch["vector"].to_pylist(), strict=True):
                x = None if i is None or not vector or None in vector else np.array(vector, np.float64)
                if x is not None:
                    with np.errstate(over="ignore", invalid="ignore"):
                        top = np.abs(x).max()
                        ok = bool(np.isfinite(top) and top > 0)
                if x is None or not ok:
                    yield (i, None, None, None, None, None)
                    continue
                unit = x / top  # large and tiny components stay in range
                unit /= np.sqrt(unit @ unit)
                d = len(unit)
                if d not in planes:
                    planes[d] = np.random.default_rng([SEED, d]).standard_normal((PROJECTIONS + 1, d))
                p = planes[d] @ unit
                codes = np.clip(np.rint((p[1:] + SPAN) / STEP), 0, 255).astype(np.uint8)
                yield (i, hashlib.blake2b(x.tobytes(), digest_size=16).digest(), d, unit.tobytes(), float(p[0]), codes.tobytes())

    return batched(rows(), schema)


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking a with b. A label is the index of its set's root."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        np.minimum.at(labels, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(further := labels[labels], labels):
            labels = further


def _count_task(cosine: float):
    half, need = calibrated(cosine)
    width = int(math.ceil(half / STEP)) + 1

    def run(table: pa.Table) -> pa.Table:
        ids, sizes, block, low = (table[c].to_numpy() for c in ("rep", "size", "block", "low"))
        unit = np.stack([np.frombuffer(u, np.float64) for u in table["unit"].to_pylist()])
        codes = np.stack([np.frombuffer(c, np.uint8) for c in table["codes"].to_pylist()]).T
        left = np.flatnonzero(block == low)
        inside = table["high"][0].as_py() == low[0]
        right = left if inside else np.flatnonzero(block != low)
        links, labels = np.zeros(len(ids), np.int64), np.arange(len(ids))
        theirs = [np.ascontiguousarray(c[right]) for c in codes]
        for part in np.array_split(left, -(-len(left) // 128)) if len(left) and len(right) else []:
            hits = np.zeros((len(part), len(right)), np.uint8)
            for mine, other in zip(codes, theirs, strict=True):
                # Codes wrap, so one comparison tells whether the other lies in the window around mine.
                hits += (other[None, :] - (mine[part] - np.uint8(width))[:, None]) <= 2 * width
            a, b = np.nonzero(hits >= need)
            a, b = part[a], right[b]
            for first in range(0, len(a), 1 << 16):
                s, t = a[first : first + (1 << 16)], b[first : first + (1 << 16)]
                near = (np.einsum("ij,ij->i", unit[s], unit[t]) >= cosine) & (s != t)
                s, t = s[near], t[near]
                np.add.at(links, s, sizes[t])
                if not inside:
                    np.add.at(links, t, sizes[s])
                labels = _merge(labels, s, t)
        some = links > 0
        return pa.table({"u": ids[some], "v": ids[labels[some]], "links": links[some]})

    return run


def near_vectors(df: DataFrame, id_col: str, vector_col: str, cosine: float = 0.9) -> DataFrame:
    """Link vectors whose cosine, in double precision, is at least ``cosine``.

    Adds n_links (other vectors linked directly), component_id (smallest id that links
    reach, itself included) and kept (the row's id is component_id) to all rows.

    Equal vectors form a class that is compared once. Classes are sorted along one random
    projection into blocks of about 4,096. A block meets those blocks that the window
    around one of its members can reach; there the collisions of each pair in the windows
    of 32 further projections are counted, and pairs with a count that a pair at
    ``cosine`` reaches in 9,999 of 10,000 cases are verified. A meeting gives the number
    of links and one link to a root for each member, never the pairs themselves. Its
    work grows with the square of the classes that a window reaches, as one-dimensional
    windows over unrelated vectors do.

    Ids are of an integer type. A vector that is null, empty, zero or holds null or
    non-finite components links with nothing, nor does a row of null id; vectors of
    different length never link. Rows that repeat an id count as vectors of their own
    and share a component. Columns named like an added one are replaced; names that
    start with an underscore are reserved. An empty table gives an empty one.
    """
    prepared = staged(
        df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
        .mapInArrow(_prepare, "id long, key binary, dim int, unit binary, place double, codes binary"), "vectors"
    )
    classes = staged(
        prepared.filter("key is not null").groupBy("key", "dim").agg(
            F.min("id").alias("rep"), F.count(F.lit(1)).alias("size"), *[F.first(c).alias(c) for c in ("unit", "place", "codes")]
        ), "classes"
    )
    reach = 4.5 * math.sqrt(2 - 2 * cosine)
    n = classes.count()
    count = max(1, -(-n // BLOCK))
    # One cut for each 4,096 classes, about two thousandths of a vector's size.
    cuts = classes.agg(F.percentile_approx("place", [i / count for i in range(1, count)], 100 * count)).first()[0] if count > 1 else []
    cuts = sorted(set(cuts or []))
    edges = F.array(*[F.lit(float(c)) for c in cuts]) if cuts else F.array().cast("array<double>")
    block_of = lambda c: F.size(F.filter(edges, lambda e: e < c))
    placed = classes.withColumn("block", block_of(F.col("place")))
    # What the windows of the block's members can reach, from the ends of the block.
    lows = F.array(F.lit(-math.inf), *[F.lit(float(c)) for c in cuts])
    highs = F.array(*[F.lit(float(c)) for c in cuts], F.lit(math.inf))
    others = F.filter(
        F.sequence(F.lit(0), F.lit(len(cuts))),
        lambda j: (F.element_at(lows, j + 1) <= F.col("place") + reach) & (F.element_at(highs, j + 1) >= F.col("place") - reach),
    )
    met = placed.withColumn("other", F.explode(others)).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    found = staged(met.drop("key", "place").groupBy("dim", "low", "high").applyInArrow(_count_task(cosine), "u long, v long, links long"), "links")
    totals = found.groupBy("u").agg(F.sum("links").alias("_links"))
    labels = components(found.select("u", "v"))
    known = classes.select("key", "dim", "rep", "size").join(totals.withColumnRenamed("u", "rep"), "rep", "left").join(
        labels.withColumnRenamed("id", "rep"), "rep", "left"
    ).select("key", "dim", F.coalesce("component", "rep").alias("_component"), (F.col("size") - 1 + F.coalesce("_links", F.lit(0))).alias("_links"))
    each = prepared.select("id", "key", "dim").join(known, ["key", "dim"], "left").groupBy("id").agg(
        F.max("_links").alias("_links"), F.min(F.coalesce("_component", "id")).alias("_component")
    ).filter("id is not null")
    source = df.drop("n_links", "component_id", "kept")
    return source.join(each.withColumnRenamed("id", "_id"), F.col(id_col).cast("long") == F.col("_id"), "left").withColumns({
        "n_links": F.coalesce("_links", F.lit(0).cast("long")), "component_id": F.coalesce("_component", F.col(id_col).cast("long")),
    }).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))).drop("_id", "_links", "_component")
