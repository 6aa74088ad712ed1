"""Zones of several parts with holes, and fills that go on in rounds, against plain versions."""

import datetime as dt
import statistics

import numpy as np
import pandas as pd
import pytest

from sparkpanel.operators.nearest import neighbours
from sparkpanel.operators.polygons import area_mean, parts_area, point_in_parts
from sparkpanel.plans.prices import spatial_fill

RING = "zone string, part int, ring array<struct<x: double, y: double>>"


def star(n, radius, at=(0.0, 0.0), seed=0):
    rng = np.random.default_rng(seed)
    angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
    r = radius * rng.uniform(0.7, 1.0, n)
    return list(zip((at[0] + r * np.cos(angle)).tolist(), (at[1] + r * np.sin(angle)).tolist()))


def crossings(points, ring):
    n = np.zeros(len(points), int)
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if ay != by:
            n += ((ay > points[:, 1]) != (by > points[:, 1])) & (points[:, 0] < ax + (points[:, 1] - ay) * (bx - ax) / (by - ay))
    return n


def plain(points, rings):
    found = set()
    for zone, part in {(z, p) for z, p, _ in rings}:
        n = sum(crossings(points, r) for z, p, r in rings if (z, p) == (zone, part))
        found |= {(int(i), zone) for i in np.flatnonzero(n % 2 == 1)}
    return found


def test_parts_holes_and_overlaps(spark):
    square = [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0)]
    rings = [
        ("a", 1, star(400, 3.0)), ("a", 1, star(50, 1.0, seed=1)), ("a", 2, star(30, 2.0, (2.5, 0.0), 2)),  # the parts overlap
        ("b", None, square), ("b", None, [(-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5)]), ("c", 1, square),
    ]
    rng = np.random.default_rng(3)
    xy = np.concatenate([rng.uniform(-5, 5, (600, 2)), [[0.0, 0.0], [0.75, 0.75], [1.0, 1.0], [-1.0, -1.0], [0.0, -1.0]]])
    xy = np.concatenate([xy, xy[:50]])  # repeated positions
    rows = [(i, float(x), float(y), "clash") for i, (x, y) in enumerate(xy)] + [(9000, None, 0.0, "n"), (9001, 0.0, None, "n")]
    points = spark.createDataFrame(rows, "id int, lon double, lat double, zone string")
    odd = [(None, 1, square), ("d", 1, None), ("e", 1, []), ("f", 1, [(0.0, 0.0), (1.0, 0.0)])]
    got = point_in_parts(points, spark.createDataFrame(rings + odd, RING), "zone", "part")
    assert got.columns == ["id", "lon", "lat", "zone"]
    found = [(r["id"], r["zone"]) for r in got.collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain(xy, rings)


def test_ring_of_many_vertices(spark):
    ring = star(100_000, 10.0, seed=4)
    xy = np.random.default_rng(5).uniform(-11, 11, (40, 2))
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "id int, lon double, lat double")
    xs, ys = (np.array(c) for c in zip(*ring))
    pdf = pd.DataFrame({"part": 1, "i": np.arange(len(ring)), "x": xs, "y": ys})
    rings = spark.createDataFrame(pdf).selectExpr("part", "struct(i, x, y) AS p").groupBy("part").agg({"p": "collect_list"})
    rings = rings.selectExpr("'z' AS zone", "part", "transform(array_sort(`collect_list(p)`), p -> struct(p.x AS x, p.y AS y)) AS ring")
    bx, by = np.roll(xs, -1), np.roll(ys, -1)
    want = {
        (i, "z") for i, (x, y) in enumerate(xy)
        if (((ys > y) != (by > y)) & (x < xs + (y - ys) * (bx - xs) / np.where(by == ys, 1, by - ys))).sum() % 2
    }
    got = {(r["id"], r["zone"]) for r in point_in_parts(points, rings, "zone", "part").collect()}
    assert got == want and 0 < len(got) < 40


def test_no_points_or_rings(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "id int, lon double, lat double")
    none = spark.createDataFrame([], RING)
    some = spark.createDataFrame([("a", 1, star(9, 1.0))], RING)
    assert point_in_parts(points, none, "zone", "part").count() == 0
    assert point_in_parts(points.filter("id < 0"), some, "zone", "part").count() == 0


def test_area_and_mean_of_parts(spark):
    square = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    rings = spark.createDataFrame([("a", 1, square(0.0, 4.0)), ("a", 1, square(1.0, 3.0)), ("a", 2, square(10.0, 11.0))], RING)
    assert [tuple(r) for r in parts_area(rings, "zone", "part").collect()] == [("a", 13.0)]
    px = spark.createDataFrame([(0.5, 0.5, 1, 2.0), (2.0, 2.0, 1, 100.0), (10.5, 10.5, 1, 4.0)], "lon double, lat double, day int, v double")
    assert [tuple(r) for r in area_mean(px, rings, "zone", "v", ["day"], part="part").collect()] == [("a", 1, 3.0, 2.0, 4.0, 2)]


def rounds(prices, ranks, markets, growing):
    """Round by round over all cells."""
    now = dict(prices)
    for k in range(1, markets):
        before = dict(now)
        for (m, c, t), p in before.items():
            if p is None:
                picked = [n for n, r in ranks[m] if (r <= k if growing else r == k)]
                held = [before[(n, c, t)] for n in picked if before.get((n, c, t)) is not None]
                if held:
                    now[(m, c, t)] = statistics.median(held)
    return now


@pytest.mark.parametrize("growing", [False, True])
@pytest.mark.parametrize("known", [0.04, 0.3])
def test_fill_in_rounds_equals_plain_rounds(spark, growing, known):
    rng = np.random.default_rng(int(known * 100) + growing)
    size = 24
    coords = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(rng.uniform(-20, 20, (size, 2)))], "market int, lat double, lon double")
    ranks = {m: [] for m in range(size)}
    for r in neighbours(coords, "market", size - 1).collect():
        ranks[r["market"]].append((r["neighbour"], r["rank"]))
    days = [dt.date(2010, m, 1) for m in range(1, 7)]
    prices = {(m, c, d): float(rng.integers(1, 99)) if rng.random() < known else None for m in range(size) for c in ("maize", "rice") for d in days}
    for m in range(size):
        prices[(m, "rice", days[0])] = None  # no market can give
    dense = spark.createDataFrame([(*k, v) for k, v in prices.items()], "market int, commodity string, month date, price double")
    got = spatial_fill(dense, coords, "growing" if growing else "cascade", 3)
    assert {(r["market"], r["commodity"], r["month"]): r["price"] for r in got.collect()} == rounds(prices, ranks, size, growing)
