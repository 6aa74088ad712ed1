"""Nearest and growing fills against plain loops, with few and with many prices."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from sparkpanel.plans import prices as pr

SPOTS = {m: (float(m * m % 7), float(m * 5 % 11)) for m in range(9)}


def frames(spark, keep):
    cells = [(m, c, t, (m * 10 + t * 3 + len(c) * 1.5) if keep(m, c, t) else None) for m in SPOTS for c in ("a", "bb") for t in (1, 2, 3)]
    dense = spark.createDataFrame(cells, "market long, commodity string, month int, price double")
    coords = spark.createDataFrame([(m, *xy) for m, xy in SPOTS.items()], "market long, lat double, lon double")
    ranks: dict = {}
    for r in pr.neighbours(coords, "market", len(SPOTS)).filter("neighbour is not null").orderBy("market", "rank").collect():
        ranks.setdefault(r.market, []).append(r.neighbour)
    return cells, dense, coords, ranks


KEEPS = {"few": lambda m, c, t: (m + t) % 4 == 0, "many": lambda m, c, t: (m + t) % 4 > 0, "none": lambda m, c, t: t != 2 and m == 3}


@pytest.mark.parametrize("keep", KEEPS)
@pytest.mark.parametrize("shortlist", (1, 3))
def test_nearest_fill(spark, keep, shortlist):
    cells, dense, coords, ranks = frames(spark, KEEPS[keep])
    price = {(m, c, t): p for m, c, t, p in cells}
    for r in pr.spatial_fill(dense, coords, k_max=shortlist).collect():
        key = (r.market, r.commodity, r.month)
        donor = None if price[key] is not None else next((n for n in ranks[r.market] if price[n, r.commodity, r.month] is not None), None)
        assert r.donor == donor and (r.dist_km is None) == (donor is None)
        assert r.price == (price[key] if donor is None else price[donor, r.commodity, r.month])


@pytest.mark.parametrize("keep", KEEPS)
def test_growing_fill_makes_no_links_beyond_the_round(spark, keep, monkeypatch):
    cells, dense, coords, ranks = frames(spark, KEEPS[keep])
    made = []
    stage = pr.cut_lineage
    monkeypatch.setattr(pr, "cut_lineage", lambda df: made.append(stage(df)) or made[-1])
    got = {(r.market, r.commodity, r.month): r.price for r in pr.spatial_fill(dense, coords, "growing", 8).collect()}
    state = {(m, c, t): p for m, c, t, p in cells}
    for k in range(1, len(SPOTS)):
        before = dict(state)
        for (m, c, t), p in before.items():
            known = [before[n, c, t] for n in ranks[m][:k] if before[n, c, t] is not None]
            if p is None and known:
                state[m, c, t] = median(known)
    assert got == state
    price = {(m, c, t): p for m, c, t, p in cells}
    open_cells = [(m, c, t) for (m, c, t), p in price.items() if p is None and any(price[n, c, t] is not None for n in SPOTS)]
    first = {(m, c, t): 1 + next(i for i, n in enumerate(ranks[m]) if price[n, c, t] is not None) for m, c, t in open_cells}
    links = [df for df in made if {"rank", "neighbour", "price"} <= set(df.columns)]
    assert not any("array" in t for df in made for _, t in df.dtypes)
    assert not open_cells or links[0].count() == sum(first.values())
    assert dense.filter(F.col("price").isNull()).count() == len([p for p in price.values() if p is None])


def test_rounds_move_only_cells_that_can_take_an_earlier_one(spark, monkeypatch):
    cells, dense, coords, ranks = frames(spark, KEEPS["many"])
    made = []
    stage = pr.cut_lineage
    monkeypatch.setattr(pr, "cut_lineage", lambda df: made.append(stage(df)) or made[-1])
    filled = pr.spatial_fill(dense, coords, "growing", 8)
    assert filled.filter(F.col("price").isNull()).count() == 0 and filled.count() == len(cells)
    price = {(m, c, t): p for m, c, t, p in cells}
    first = [next(i for i, n in enumerate(ranks[m], 1) if price[n, c, t] is not None) for (m, c, t), p in price.items() if p is None]
    states = [df.count() for df in made if set(df.columns) == {*pr.CELL, "round"}]
    assert states and max(states) == len([r for r in first if r > 2]) < len(first)
