import math
import random

import numpy as np
import pytest

from sparkpanel.operators import state_space
from sparkpanel.operators.state_space import fill_local_level, local_level_fit
from sparkpanel.plans.prices import point_price, station_price


def smoothed(y, signal):
    """Levels that minimise weighted squares of noise and of moves, as one linear system."""
    n, known = len(y), [v is not None for v in y]
    a, b = np.zeros((n, n)), np.zeros(n)
    for i in range(n):
        if known[i]:
            a[i, i] += 1 / (1 - signal)
            b[i] += y[i] / (1 - signal)
        if i:
            a[np.ix_([i - 1, i], [i - 1, i])] += np.array([[1, -1], [-1, 1]]) / signal
    return np.linalg.solve(a, b)


def deviance(y, signal):
    """Of the differences between neighbouring known values, which have one covariance whatever the start."""
    at = [i for i, v in enumerate(y) if v is not None]
    d = np.diff([y[i] for i in at])
    cov = np.diag(np.diff(at) * signal + 2 * (1 - signal))
    for i in range(len(d) - 1):
        cov[i, i + 1] = cov[i + 1, i] = -(1 - signal)
    return len(d) * math.log(d @ np.linalg.solve(cov, d)) + np.linalg.slogdet(cov)[1]


def walks(seed, count):
    rng, out = random.Random(seed), {}
    for k in range(count):
        level, moves, noise = 5.0, rng.choice([0.0, 0.1, 1.0]), rng.choice([0.1, 1.0])
        y = []
        for _ in range(rng.randint(6, 40)):
            level += rng.gauss(0, moves)
            y.append(None if rng.random() < 0.3 else level + rng.gauss(0, noise))
        out[f"w{k}"] = y
    return out


def frame(spark, series):
    rows = [(e, t, v) for e, y in series.items() for t, v in enumerate(y)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "e string, t int, v double").repartition(3)


def filled(df, **options):
    out = {}
    for r in fill_local_level(df, ["e"], "t", "v", **options).orderBy("t").collect():
        out.setdefault(r.e, []).append(r.filled)
    return out


def test_levels_at_a_given_signal(spark):
    series = walks(2, 12)
    for signal in (0.05, 0.6):
        got = filled(frame(spark, series), signal=signal)
        for e, y in series.items():
            level = smoothed(y, signal)
            assert got[e] == pytest.approx([level[i] if v is None else v for i, v in enumerate(y)])


def test_signal_is_the_likeliest(spark, monkeypatch):
    series = walks(3, 25)
    monkeypatch.setattr(state_space, "CELLS", 200)
    for r in local_level_fit(frame(spark, series), ["e"], "t", "v").collect():
        y = series[r.e]
        assert [s.value for s in r.steps] == y and r.n_known == sum(v is not None for v in y)
        if r.n_known > 2:
            best = min(deviance(y, math.sin(a) ** 2) for a in np.linspace(0, math.pi / 2, 2001))
            assert deviance(y, r.signal) <= best + 1e-6


def test_bounds_of_the_signal(spark):
    trend = [float(i * i) for i in range(9)]
    got = {r.e: r.signal for r in local_level_fit(frame(spark, {"walk": trend, "swing": [1.0, -1.0] * 6}), ["e"], "t", "v").collect()}
    assert got == {"walk": pytest.approx(1.0), "swing": pytest.approx(0.0, abs=1e-9)}
    assert filled(frame(spark, {"flat": [2.0, None] * 6}))["flat"] == [2.0] * 12
    kept = filled(frame(spark, {"a": [None, 1.0, None, 4.0]}), signal=1.0)["a"]
    assert kept == pytest.approx([1, 1, 2.5, 4])
    with pytest.raises(ValueError, match="outside"):
        local_level_fit(frame(spark, {"a": [1.0]}), ["e"], "t", "v", signal=1.5)


def test_short_empty_and_null_series(spark):
    df = frame(spark, {"none": [None, None], "one": [None, 3.0, None], "two": [1.0, None, 2.0], "nan": [1.0, float("nan"), 3.0]})
    extra = spark.createDataFrame([(None, 0, 7.0), (None, 1, None)], "e string, t int, v double")
    got = filled(df.unionByName(extra))
    assert got == {"none": [None, None], "one": [3.0] * 3, "two": [1.0, 1.5, 2.0], "nan": [1.0, 2.0, 3.0], None: [7.0, 7.0]}
    assert filled(df.limit(0)) == {}


def test_prices_of_asked_months_alone(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0), (3, 0.1, 0.0)], "p int, lat double, lon double")
    coords = spark.createDataFrame([("x", 0.0, 0.0), ("y", 1.0, 1.0)], "market string, lat double, lon double")
    prices = spark.createDataFrame([("x", "m", "2020-01", 1.0), ("x", "m", "2020-02", 2.0), ("y", "m", "2020-02", 5.0)], "market string, commodity string, month string, price double")
    asked = spark.createDataFrame([(1, "2020-02"), (1, "2020-02"), (2, "2020-01"), (9, "2020-01")], "p int, month string")
    got = sorted((r.p, r.market, r.month, r.commodity, r.price) for r in point_price(points, coords, prices, "p", asked).collect())
    assert got == [(1, "x", "2020-02", "m", 2.0), (2, "y", "2020-01", None, None)]
    whole = point_price(points, coords, prices, "p").groupBy("p").count().collect()
    assert {r.p: r["count"] for r in whole} == {1: 2, 2: 1, 3: 2}


def test_station_price_of_asked_months(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "p int, lat double, lon double")
    coords = spark.createDataFrame([("x", 0.0, 0.0)], "market string, lat double, lon double")
    rows = [("x", "m", "2020-01-01", 1.0), ("x", "m", "2020-02-01", None), ("x", "m", "2020-03-01", 3.0), ("all", "m", "2020-02-01", 9.0), ("x", "n", "2020-02-01", 9.0)]
    stations = spark.createDataFrame(rows, "market string, commodity string, month string, price double").withColumn("month", state_space.F.to_date("month"))
    asked = spark.createDataFrame([(1, "2020-02-01"), (1, "2020-05-01")], "p int, month string").withColumn("month", state_space.F.to_date("month"))
    got = station_price(stations, coords, points, "p", "m", "all", asked, signal=1.0).orderBy("month").collect()
    assert [(str(r.month), r.price, r.price_lag) for r in got] == [("2020-02-01", 2.0, 1.0), ("2020-05-01", None, None)]


def test_the_fit_is_planned_once(spark):
    from sparkpanel.operators.state_space import fill_local_level

    plan = fill_local_level(frame(spark, walks(2, 12)), ["e"], "t", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
