"""Fits with several factors of many levels, connected parts, bounds on levels."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkpanel.operators.graph import connected_parts
from sparkpanel.operators.reshape import TooManyLevels, dummies, levels
from sparkpanel.plans import models as md


def dummy_fit(rows, k):
    """Estimates, errors and R2 with a column for each level, aliased ones dropped by the pseudo-inverse."""
    y = np.array([r[0] for r in rows])
    x = np.array([r[1 : 1 + k] for r in rows], float)
    d = [np.array([r[j] == v for r in rows], float) for j in range(1 + k, len(rows[0])) for v in sorted({r[j] for r in rows})]
    z = np.column_stack([x, *d])
    inv = np.linalg.pinv(z.T @ z)
    b = inv @ z.T @ y
    rank = np.linalg.matrix_rank(z)
    sse = ((y - z @ b) ** 2).sum()
    return b[:k], np.sqrt(np.diag(inv)[:k] * sse / (len(y) - rank)), rank - k, 1 - sse / ((y - y.mean()) ** 2).sum()


def made(n, parts, seed=0):
    """Rows of two factors whose levels fall into separate parts."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        p = rng.randrange(parts)
        a, b = f"{p}-{rng.randrange(5)}", p * 10 + rng.randrange(4)
        x1, x2 = rng.gauss(0, 1) + b, rng.gauss(5, 2)
        rows.append((1e4 + 2 * x1 - x2 + hash(a) % 7 + b + rng.gauss(0, 1), x1, x2, a, b))
    return rows


def test_equal_to_dummies_with_errors(spark):
    rows = made(300, 3)
    df = spark.createDataFrame([*rows, (None, 1.0, 1.0, "0-0", 0), (1.0, float("nan"), 1.0, "0-0", 0), (1.0, 1.0, 1.0, None, 0)], "y double, x1 double, x2 double, a string, b int")
    fit = md.absorbed_ols(df, "y", ["x1", "x2"], ["a", "b"])
    b, se, rank, r2 = dummy_fit(rows, 2)
    assert fit.n == 300 and fit.absorbed == rank
    assert [fit.coef["x1"], fit.coef["x2"]] == pytest.approx(b, rel=1e-7)
    assert [fit.se["x1"], fit.se["x2"]] == pytest.approx(se, rel=1e-7)
    assert fit.overall_r2 == pytest.approx(r2, abs=1e-9)


def test_a_regressor_that_the_levels_determine_is_dropped(spark):
    rows = [(r[0], r[1], float(r[4]), r[3], r[4]) for r in made(120, 1)]
    df = spark.createDataFrame(rows, "y double, x1 double, x2 double, a string, b int")
    fit = md.absorbed_ols(df, "y", ["x1", "x2"], ["a", "b"])
    assert fit.dropped == ["x2"] and list(fit.coef) == ["x1"]


def test_many_levels_of_both_factors(spark):
    n = 9000
    df = spark.range(n).select(
        (F.col("id") % 1500).alias("a"), (F.xxhash64("id") % 1000).alias("b"), F.randn(1).alias("x"), F.randn(2).alias("e"), "id"
    ).withColumn("y", 3 * F.col("x") + F.sin("a") * 5 + F.cos("b") * 4 + F.col("e") / 100)
    fit = md.absorbed_ols(df, "y", ["x"], ["a", "b"], tol=1e-3)
    assert fit.coef["x"] == pytest.approx(3, abs=1e-2) and fit.absorbed > 3000


def test_connected_parts_of_a_path_a_star_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 40)]
    df = spark.createDataFrame(path + star + [(900, 900), (None, 5), (6, None)], "a long, b long").repartition(5)
    got = {r["node"]: r["part"] for r in connected_parts(df, "a", "b").collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 40)} | {900: 900}


def test_levels_are_bounded(spark):
    df = spark.createDataFrame([(i,) for i in range(20)] + [(None,)], "f int")
    assert levels(df, "f", 20) == list(range(20))
    with pytest.raises(TooManyLevels, match="f has more"):
        levels(df, "f", 19)
    assert len(dummies(df, "f").columns) == 21
