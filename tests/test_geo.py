import numpy as np
import pandas as pd
import pytest

from sparkpanel.functions.geodesy import albers_xy, geodesic_km, haversine_km
from sparkpanel.operators.nearest import nearest_join, neighbours
from sparkpanel.operators.polygons import point_in_polygon, ring_area


def brute(l, r, k, skip_self, grouped):
    out = []
    for i, la, lo, g in l[["id", "lat", "lon", "g"]].itertuples(index=False):
        a1, o1, a2, o2 = map(np.radians, (la, lo, r.lat.to_numpy(), r.lon.to_numpy()))
        s = np.sin((a2 - a1) / 2) ** 2 + np.cos(a1) * np.cos(a2) * np.sin((o2 - o1) / 2) ** 2
        d = np.round(2 * 6371.0088 * np.arcsin(np.minimum(1, np.sqrt(s))), 6)
        keep = np.ones(len(r), bool)
        if skip_self:
            keep &= r.id.to_numpy() != i
        if grouped:
            keep &= r.g.to_numpy() == g
        ids, d = r.id.to_numpy()[keep], d[keep]
        out += [(i, ids[j], rank + 1) for rank, j in enumerate(np.lexsort((ids, d))[:k])]
    return sorted(out)


def clouds():
    rng = np.random.default_rng(5)
    l = pd.DataFrame({"id": range(80), "lat": rng.uniform(-80, 80, 80), "lon": rng.uniform(-180, 180, 80)})
    r = pd.DataFrame({"id": range(900), "lat": rng.uniform(-80, 80, 900), "lon": rng.uniform(-180, 180, 900)})
    # A third of the points in one town, a hundred at one spot.
    r.loc[:300, "lat"], r.loc[:300, "lon"] = 10 + rng.normal(0, 1e-3, 301), 20 + rng.normal(0, 1e-3, 301)
    r.loc[301:400, "lat"], r.loc[301:400, "lon"] = 5.0, 6.0
    l.loc[:20, "lat"], l.loc[:20, "lon"] = 10 + rng.normal(0, 1e-2, 21), 20.0
    l["g"], r["g"] = l.id % 3, r.id % 3
    return l, r


@pytest.mark.parametrize("k,grouped", [(1, False), (3, True)])
def test_nearest_equals_brute_force(spark, k, grouped):
    l, r = clouds()
    got = nearest_join(spark.createDataFrame(l), spark.createDataFrame(r), "id", "id", k=k, by=["g"] if grouped else None)
    assert sorted((x["id"], x["near_id"], x["rank"]) for x in got.collect()) == brute(l, r, k, False, grouped)


def test_neighbours_skip_self(spark):
    _, r = clouds()
    r = r[r.id > 250]
    got = neighbours(spark.createDataFrame(r), "id", 2)
    assert sorted((x["id"], x["neighbour"], x["rank"]) for x in got.collect()) == brute(r, r, 2, True, False)


def test_nearest_without_candidates(spark):
    l, r = clouds()
    empty = spark.createDataFrame(r).filter("id < 0")
    got = nearest_join(spark.createDataFrame(l), empty, "id", "id")
    assert got.count() == len(l) == got.filter("near_id IS NULL AND rank IS NULL").count()


def test_left_rows_stay_without_coordinates_or_candidates(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0, "a"), (2, None, 1.0, "a"), (3, 0.0, 0.0, "b"), (4, 0.0, 0.0, None)], "id int, lat double, lon double, g string")
    right = spark.createDataFrame([(9, 0.0, 1.0, "a")], "id int, lat double, lon double, g string")
    got = {r["id"]: r["near_id"] for r in nearest_join(left, right, "id", "id", by=["g"]).collect()}
    assert got == {1: 9, 2: None, 3: None, 4: None}
    alone = {r["id"]: r["neighbour"] for r in neighbours(left.filter("id < 3"), "id", 1).collect()}
    assert alone == {1: None, 2: None}


def test_geodesic_known_value(spark):
    df = spark.createDataFrame([(-37.95103341, 144.42486789, -37.65282114, 143.92649553), (0.0, 0.0, 0.0, 0.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geodesic_km("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(54.972271, abs=1e-6) and got[1] == 0.0
    hav = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert hav[0] == pytest.approx(54.97, rel=0.006)


def test_albers_keeps_area(spark):
    # A small square in degrees keeps its area on the ellipsoid.
    half = 0.05
    pts = [(-13 + s * half, 34 + t * half) for s, t in ((-1, -1), (-1, 1), (1, 1), (1, -1))]
    x, y = albers_xy("lat", "lon")
    xy = [tuple(r) for r in spark.createDataFrame(pts, "lat double, lon double").select(x, y).collect()]
    ring = spark.createDataFrame([([{"x": a, "y": b} for a, b in xy],)], "ring array<struct<x double, y double>>")
    area = ring.select(ring_area("ring")).first()[0]
    lat = np.radians(-13)
    e2 = 0.00669437999014
    m = 6378137 * (1 - e2) / (1 - e2 * np.sin(lat) ** 2) ** 1.5
    n = 6378137 / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    want = m * np.radians(0.1) * n * np.cos(lat) * np.radians(0.1)
    assert area == pytest.approx(want, rel=1e-4)


def test_point_in_concave_polygon(spark):
    ring = [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)]
    polys = spark.createDataFrame([("u", [{"x": float(a), "y": float(b)} for a, b in ring])], "z string, ring array<struct<x double, y double>>")
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 3.0), (3, 3.8, 3.0), (4, 9.0, 9.0)], "id int, lon double, lat double")
    assert {r["id"] for r in point_in_polygon(pts, polys).collect()} == {1, 3}
    assert polys.select(ring_area("ring")).first()[0] == pytest.approx(10.0)


def test_one_wide_polygon_among_small_ones(spark):
    box = lambda x, y, s: [{"x": x, "y": y}, {"x": x + s, "y": y}, {"x": x + s, "y": y + s}, {"x": x, "y": y + s}]
    rows = [(i, box(i % 40 * 0.5, i // 40 * 0.5, 0.02)) for i in range(2000)] + [(9999, box(0.0, 0.0, 20.0))]
    polys = spark.createDataFrame(rows, "z int, ring array<struct<x double, y double>>")
    pts = spark.createDataFrame([(i, i % 40 * 0.5 + 0.01, i // 40 * 0.5 + 0.01) for i in range(0, 2000, 7)], "id int, lon double, lat double")
    joined = point_in_polygon(pts, polys)
    got = {}
    for r in joined.collect():
        got.setdefault(r["id"], set()).add(r["z"])
    assert got == {i: {i} | ({9999} if i // 40 * 0.5 < 20 else set()) for i in range(0, 2000, 7)}


@pytest.mark.parametrize("points", [9, 400])
def test_nearest_plan_has_no_cross_join(spark, points):
    _, r = clouds()
    r = r.head(points)
    plan = nearest_join(spark.createDataFrame(r), spark.createDataFrame(r), "id", "id")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
