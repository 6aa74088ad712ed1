"""Hard negatives against a plain search."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkpanel.llm import negatives

SCHEMA = "id long, vec array<double>, label int, score string, row int, rank string"


def plain(rows, scale, is_anchor):
    ok = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x * scale) for x in v):
            continue
        ok.append((i, [math.floor(x * scale) for x in v], label))
    out = []
    for a, va, la in ok:
        if not is_anchor(a):
            continue
        scored = [(max(-(1 << 63), min((1 << 63) - 1, sum(p * q for p, q in zip(va, v)))), i, label) for i, v, label in ok if len(v) == len(va)]
        scored.sort(key=lambda x: (-x[0], x[1]))
        for p, i, _ in [x for x in scored if x[2] == la and x[1] != a][:5]:
            near = [x for x in scored if x[2] != la and 50 * p <= 100 * x[0] <= 95 * p][:3]
            out += [(a, i, k, x[1], p, x[0]) for k, x in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows, scale=16.0):
    df = spark.createDataFrame([(*r, "s", 1, "r") for r in rows], SCHEMA).repartition(3)
    got = negatives.hard_negatives(df, "id", "vec", "label", F.col("id") % 4 == 0, scale)
    return sorted(tuple(r) for r in got.collect())


@pytest.fixture
def small(monkeypatch):
    for name, value in (("TREE", 8), ("SHARD", 16), ("BLOCK", 25)):
        monkeypatch.setattr(negatives, name, value)


def test_clusters_ties_repeats_nulls_and_odd_vectors(spark, small):
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(90):
        c = rng.randrange(4)
        rows.append((i, [x + rng.gauss(0, 0.4) for x in centres[c]], rng.choice([c, c, 7])))
    rows += [(100 + i, rows[5][1], rows[5][2] if i % 2 else 9) for i in range(12)]
    rows += [rows[8], rows[9], (200, None, 1), (204, [1.0] * 6, None), (208, [1.0, None] + [0.0] * 4, 2), (212, [float("nan")] * 6, 2), (216, [float("inf")] * 6, 2)]
    rows += [(220, [], 1), (221, [], 1), (222, [], 2), (224, [0.0] * 6, 3), (225, [1.0, 2.0], 1), (228, [2.0, 2.0], 1), (229, [1.0, 1.0], 2), (None, [1.0] * 6, 1)]
    want = plain(rows, 16.0, lambda i: i % 4 == 0)
    assert mined(spark, rows) == want and len(want) > 50


def test_scores_beyond_double_precision_and_64_bits(spark, small):
    rng = random.Random(6)
    rows = [(i, [rng.choice([1, 2**29 + i, 2**40 + 3 * i, 2**58]) * rng.choice([1.0, 1.0, -1.0]) for _ in range(3)], i % 3) for i in range(40)]
    assert mined(spark, rows, 1.0) == plain(rows, 1.0, lambda i: i % 4 == 0)
    assert mined(spark, []) == []


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(0)
    x = np.floor(rng.standard_normal((40, 16)) * 20 + 200)
    table = pa.table({"id": range(40), "label": [0] * 40, "dim": pa.array([16] * 40, pa.int32()), "vec": [v.tobytes() for v in x], "norm": np.linalg.norm(x, axis=1), "row": range(40)})
    c = np.floor(rng.standard_normal((300, 16)) * 20 + 200)
    tree = negatives.Tree(negatives._tree(table), {"id": np.arange(300), "label": np.zeros(300, np.int64), "vec": c, "norm": np.linalg.norm(c, axis=1)})
    truth = (tree.vec @ c.T).astype(np.int64)
    asked = 0

    def wanted(at, low, high):
        nonlocal asked
        assert (low <= truth[at]).all() and (truth[at] <= high).all()
        mask = high >= np.sort(low, axis=1)[:, -5][:, None]
        asked += mask.sum()
        return mask

    for at, exact, mask in tree.walk(wanted):
        assert (exact[mask] == truth[at][mask]).all()
        for k in range(len(at)):
            assert set(np.argsort(-truth[at[k]], kind="stable")[:5]) <= set(np.flatnonzero(mask[k]))
    assert asked < 40 * 300
