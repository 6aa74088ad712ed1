"""Hard negatives of anchors: scores bounded along a spanning tree of the anchors, rescored where the bounds leave doubt."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkpanel.llm.arrow import batched
from sparkpanel.llm.staging import staged

#: Anchors of a tree, anchors and candidates that meet in a task: about so many.
TREE, SHARD, BLOCK = 256, 4096, 2048
SEED = 20_26
#: Sums of products below this are exact in double precision, in any order.
EXACT = 2.0**52
_TOP = (1 << 63) - 1
_ROW = "id long, label long, anchor boolean, dim int, vec binary, norm double, row long, code int"


def _prepare(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("anchor", pa.bool_()), ("dim", pa.int32()), ("vec", pa.binary()), ("norm", pa.float64()), ("row", pa.int64()), ("code", pa.int32())])
        planes: dict[int, np.ndarray] = {}

        def rows():
            number = TaskContext.get().partitionId() << 33
            for batch in batches:
                for i, label, anchor, vector in zip(*(batch[c].to_pylist() for c in ("id", "label", "anchor", "vector")), strict=True):
                    if i is None or label is None or vector is None or None in vector:
                        continue
                    with np.errstate(over="ignore", invalid="ignore"):
                        x = np.floor(scale * np.array(vector, np.float64))
                        norm = float(np.sqrt(x @ x))
                    if not np.isfinite(x).all():
                        continue
                    d = len(x)
                    if d not in planes:
                        planes[d] = np.random.default_rng([SEED, d]).standard_normal((16, d))
                    unit = x / max(np.abs(x).max(), 1) if d else x
                    code = int(((planes[d] @ unit) > 0) @ (1 << np.arange(16)))
                    yield (i, label, bool(anchor), d, x.tobytes(), norm, number, code)
                    number += 1

        return batched(rows(), schema)

    return run


def _vectors(table: pa.Table) -> np.ndarray:
    d = table["dim"][0].as_py() if len(table) else 0
    return np.frombuffer(b"".join(table["vec"].to_pylist()), np.float64).reshape(len(table), d)


def _tree(table: pa.Table) -> pa.Table:
    """Minimum spanning tree by Prim's method from the anchor next to the mean: place, parent's place, level, edge length."""
    x = _vectors(table)
    n = len(x)
    with np.errstate(over="ignore", invalid="ignore"):
        away = lambda i: np.nan_to_num(np.linalg.norm(x - x[i], axis=1), nan=np.inf)
        root = int(np.argmin(np.nan_to_num(np.linalg.norm(x - x.mean(axis=0), axis=1), nan=np.inf)))
        place, parent, level, edge = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
        near, via, left = away(root), np.full(n, root), np.ones(n, bool)
        left[root] = False
        for k in range(1, n):
            j = int(np.argmin(np.where(left, near, np.inf))) if np.isfinite(near[left]).any() else int(np.flatnonzero(left)[0])
            left[j] = False
            place[j], parent[j], edge[j], level[j] = k, place[via[j]], near[j], level[via[j]] + 1
            d = away(j)
            closer = left & (d < near)
            near[closer], via[closer] = d[closer], j
    for name, values in (("place", place), ("parent", parent), ("level", level), ("edge", edge)):
        table = table.append_column(name, pa.array(values))
    return table


def _scores(a: np.ndarray, x: np.ndarray, norm_a: np.ndarray, norm_x: np.ndarray) -> np.ndarray:
    """Integer inner products of row pairs; beyond 64 bits the nearest limit."""
    with np.errstate(over="ignore", invalid="ignore"):
        safe = norm_a * norm_x < EXACT
        out = np.where(safe, np.einsum("ij,ij->i", a, x), 0).astype(np.int64)
    for i in np.flatnonzero(~safe):
        out[i] = max(-_TOP - 1, min(_TOP, sum(int(p) * int(q) for p, q in zip(a[i], x[i], strict=True))))
    return out


class Tree:
    """Anchors of one tree in the order of their places, with the candidates of a block."""

    def __init__(self, anchors: pa.Table, candidates: dict[str, np.ndarray]):
        anchors = anchors.sort_by("place")
        self.vec = _vectors(anchors)
        self.c = candidates
        self.id, self.label, self.row, self.norm, self.parent, self.level, self.edge = (
            anchors[c].to_numpy() for c in ("id", "label", "row", "norm", "parent", "level", "edge")
        )

    def walk(self, wanted: Callable) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Level by level: (places, exact scores, where they are exact).

        The root's scores are exact. A child's score differs from its parent's by the
        inner product of the candidate with their difference, so by the edge's length
        times the candidate's norm at most. ``wanted`` (places, low, high) tells which
        pairs those bounds leave open; they alone are rescored. One is added for rounding.
        """
        n, m = len(self.vec), len(self.c["id"])
        low, high = np.empty((n, m)), np.empty((n, m))
        for level in range(int(self.level.max()) + 1):
            at = np.flatnonzero(self.level == level)
            if level == 0:
                mask = np.ones((1, m), bool)
            else:
                with np.errstate(over="ignore", invalid="ignore"):
                    slack = np.nan_to_num(self.edge[at][:, None] * self.c["norm"][None, :] * (1 + 1e-9) + 1, nan=np.inf)
                    base = self.parent[at]
                    # A bound near 2^63 has an error of its own there.
                    low[at] = (low[base] - slack) - np.abs(low[base]) * 1e-15
                    high[at] = (high[base] + slack) + np.abs(high[base]) * 1e-15
                mask = wanted(at, low[at], high[at])
            i, j = np.nonzero(mask)
            exact = np.zeros((len(at), m), np.int64)
            for first in range(0, len(i), 1 << 15):
                s, t = i[first : first + (1 << 15)], j[first : first + (1 << 15)]
                exact[s, t] = _scores(self.vec[at[s]], self.c["vec"][t], self.norm[at[s]], self.c["norm"][t])
            low[at[i], j] = high[at[i], j] = exact[i, j]
            yield at, exact, mask


def _first(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    # The complement of a score falls as the score rises, and can't overflow.
    return np.lexsort((ids, ~scores))[:most]


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, minus infinity where there are fewer."""
    return np.partition(values, values.shape[1] - k, axis=1)[:, -k] if values.shape[1] >= k else np.full(len(values), -np.inf)


def _blocks(anchors: pa.Table, rows: pa.Table) -> Iterator[Tree]:
    """The trees of a shard with those candidates of a block that have their dimension."""
    keys = anchors.group_by(["dim", "code", "salt"]).aggregate([]).to_pylist() if len(anchors) and len(rows) else []
    made: dict[int, dict] = {}
    for key in keys:
        d = key["dim"]
        if d not in made:
            some = rows.filter(pc.equal(rows["dim"], d))
            made[d] = {c: some[c].to_numpy() for c in ("id", "label", "norm")} | {"vec": _vectors(some)}
        if len(made[d]["id"]):
            same = [pc.equal(anchors[c], v) for c, v in key.items()]
            yield Tree(anchors.filter(pc.and_(pc.and_(*same[:2]), same[2])), made[d])


_POSITIVE = pa.schema([("row", pa.int64()), ("positive", pa.int64()), ("score", pa.int64())])
_NEGATIVE = pa.schema([("row", pa.int64()), ("anchor", pa.int64()), ("number", pa.int64()), ("positive", pa.int64()), ("positive_score", pa.int64()), ("negative", pa.int64()), ("score", pa.int64())])


def _positives_task(most: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        for tree in _blocks(anchors, rows):
            fits = (tree.label[:, None] == tree.c["label"][None, :]) & (tree.id[:, None] != tree.c["id"][None, :])

            def wanted(at, low, high, fits=fits):
                least = _kth(np.where(fits[at], low, -np.inf), most)
                return fits[at] & (high >= least[:, None])

            for at, exact, mask in tree.walk(wanted):
                for k, place in enumerate(at):
                    j = np.flatnonzero(mask[k] & fits[place])
                    for x in j[_first(exact[k, j], tree.c["id"][j], most)]:
                        out.append((int(tree.row[place]), int(tree.c["id"][x]), int(exact[k, x])))
        return pa.Table.from_batches(batched(out, _POSITIVE, 1 << 62), _POSITIVE)

    return run


def _window(score: int, least: int, greatest: int) -> tuple[int, int]:
    """The whole scores from ``least`` to ``greatest`` hundredths of ``score``."""
    return -(-least * score // 100), greatest * score // 100


def _negatives_task(most: int, least: int, greatest: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        found = {r["row"]: r["positives"] for r in anchors.select(["row", "positives"]).to_pylist()}
        for tree in _blocks(anchors, rows):
            fits = tree.label[:, None] != tree.c["label"][None, :]
            lists = [found[r] for r in tree.row.tolist()]
            width = max(map(len, lists))
            low_of, high_of = np.full((len(lists), width), np.inf), np.full((len(lists), width), -np.inf)
            limits = [[_window(p["score"], least, greatest) for p in some] for some in lists]
            for i, some in enumerate(limits):
                for k, (a, b) in enumerate(some):
                    low_of[i, k], high_of[i, k] = a, b

            def wanted(at, low, high, fits=fits, low_of=low_of, high_of=high_of, width=width):
                mask = np.zeros(low.shape, bool)
                for k in range(width):
                    a, b = low_of[at, k][:, None], high_of[at, k][:, None]
                    # Those surely inside the window hold out all below the last of the first.
                    sure = _kth(np.where(fits[at] & (low >= a) & (high <= b), low, -np.inf), most)[:, None]
                    mask |= (high >= np.maximum(a, sure)) & (low <= b)
                return mask & fits[at]

            for at, exact, mask in tree.walk(wanted):
                for k, place in enumerate(at):
                    j = np.flatnonzero(mask[k] & fits[place])
                    scores = exact[k, j]
                    for number, (p, (a, b)) in enumerate(zip(lists[place], limits[place], strict=True)):
                        if a > b:
                            continue
                        inside = j[(scores >= a) & (scores <= b)]
                        for x in inside[_first(exact[k, inside], tree.c["id"][inside], most)]:
                            out.append((int(tree.row[place]), int(tree.id[place]), number, p["positive"], p["score"], int(tree.c["id"][x]), int(exact[k, x])))
        return pa.Table.from_batches(batched(out, _NEGATIVE, 1 << 62), _NEGATIVE)

    return run


def _best(df: DataFrame, by: list[str], other: str, most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), other)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(
    df: DataFrame, id_col: str, vector_col: str, label_col: str, is_anchor: Column, scale: float = 1.0,
    positives: int = 5, negatives: int = 3, least: int = 50, greatest: int = 95,
) -> DataFrame:
    """For each anchor's nearest rows of its label, the nearest rows of other labels in a window of scores.

    A component x counts as floor(scale * x), a score is the integer inner product; higher
    scores come first, ties by smaller id. An anchor's positives are its first
    ``positives`` rows of the same label and another id. For each one, the first
    ``negatives`` rows of other labels whose score lies from ``least`` to ``greatest``
    hundredths of the positive's: anchor_id, positive_id, rank (int), negative_id,
    positive_score, negative_score.

    Anchors of like direction form trees of about 256, and trees shards of about 4,096; all
    rows lie in blocks of about 2,048, and each shard meets each block. There the scores at
    a tree's root are computed, and those at a child are bounded by the parent's plus or
    minus the edge's length times the candidate's norm; only pairs whose bounds overlap what
    is still open are rescored. A meeting hands on the first few of an anchor, so nothing
    depends on how rows are dealt. The work grows with anchors times rows. Two rounds: the
    positives must be known over all rows before their windows are.

    Rows with a null id, label, vector or component, or with a component that isn't finite
    before or after scaling, take no part; nor does an anchor condition that is null make an
    anchor. Vectors of different lengths don't meet; empty ones score 0. Rows that repeat an
    id count one by one, but never as a positive of that id. Scores beyond 64 bits count as
    the limit. Only the named columns are read, and an empty table gives an empty one.
    """
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"), is_anchor.alias("anchor"))
    rows = staged(source.mapInArrow(_prepare(scale), _ROW), "vectors")
    anchors = rows.filter("anchor")
    n, m = rows.count(), anchors.count()
    bits = min(16, max(0, math.ceil(math.log2(max(1, m) / (TREE / 2)))))
    coded = anchors.withColumn("code", F.expr(f"code & {(1 << bits) - 1}"))
    sizes = coded.groupBy("dim", "code").agg(F.ceil(F.count(F.lit(1)) / TREE).alias("parts"))
    salted = coded.join(sizes, ["dim", "code"]).withColumn("salt", F.expr("pmod(row, parts)")).drop("parts")
    tree_schema = "id long, label long, dim int, vec binary, norm double, row long, code int, salt long, place long, parent long, level long, edge double"
    wide = salted.select("id", "label", "dim", "vec", "norm", "row", "code", "salt")
    trees = staged(wide.groupBy("dim", "code", "salt").applyInArrow(_tree, tree_schema), "trees")
    shards, blocks = max(1, math.ceil(m / SHARD)), max(1, math.ceil(n / BLOCK))
    shard = F.pmod(F.xxhash64("dim", "code", "salt"), F.lit(shards))
    dealt = rows.drop("code", "anchor").withColumn("block", F.pmod(F.col("row") + F.shiftright("row", 33) * 7919, F.lit(blocks))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    )

    def meet(tree: DataFrame, task, schema: str) -> DataFrame:
        every = tree.withColumn("shard", shard).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        return every.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block")).applyInArrow(task, schema)

    near = _best(meet(trees, _positives_task(positives), "row long, positive long, score long"), ["row"], "positive", positives)
    lists = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "positive", "score"))).alias("positives"))
    known = staged(trees.join(lists, "row", "left").withColumn("positives", F.coalesce("positives", F.array().cast("array<struct<rank:int,positive:long,score:long>>"))), "positives")
    found = meet(known, _negatives_task(negatives, least, greatest), "row long, anchor long, number long, positive long, positive_score long, negative long, score long")
    return _best(found, ["row", "number"], "negative", negatives).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
