"""Scans over cut groups give what plain windows give."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sparkpanel.operators import joins, segments, windows


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(3)
    start = dt.date(2010, 1, 1)
    rows = [("hot", start + dt.timedelta(days=i), rng.choice([None, 0.0, float(rng.randint(1, 9))])) for i in range(3000)]
    rows += [(e, start + dt.timedelta(days=i), rng.choice([None, 0.0, 2.0])) for e in ("a", "b", None) for i in range(40)]
    rows.append(("hot", None, 5.0))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "e string, t date, v double").repartition(6)


def same(a, b):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def test_a_hot_group_is_cut_and_spread(series):
    frame, size = segments.segment_cuts(series, ["e"], "t", 200)
    assert [r["e"] for r in frame.collect()] == ["hot"] and size >= 15
    tagged = segments.segmented(series, ["e"], "t", (frame, size))
    sizes = {(r["e"], r["_seg"]): r["count"] for r in tagged.groupBy("e", "_seg").count().collect()}
    assert max(sizes.values()) < 400 and sum(e == "hot" for e, _ in sizes) >= 12
    assert segments.segment_cuts(series, ["e"], "t") is None


@pytest.mark.parametrize("down", [False, True])
def test_scan_equals_the_plain_window(series, down):
    steps = {fn: (fn, F.col("v")) for fn in ("sum", "count", "min", "max", "last")}
    assert same(segments.scan(series, ["e"], "t", steps, down, most=150), segments.scan(series, ["e"], "t", steps, down))


def test_panel_operators_on_a_cut_series(series):
    df = series.filter("t is not null")
    dry = F.col("v") == 0
    for run in (
        lambda m: windows.fill_group(df, ["e"], "t", "v", most=m),
        lambda m: windows.running(df, ["e"], "t", "v", "max", most=m),
        lambda m: windows.longest_run(df, ["e"], "t", dry, most=m),
        lambda m: windows.first_index(df, ["e"], "t", F.col("v") > 8, most=m),
        lambda m: windows.interp_linear(df, ["e"], "t", "v", most=m),
    ):
        assert same(run(170), run(segments.MOST))


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof_on_a_hot_group(spark, series, direction):
    left = series.filter("t is not null and e is not null").select("e", "t")
    snaps = left.filter("dayofmonth(t) in (3, 17)").withColumn("p", F.dayofyear("t"))
    run = lambda m: joins.asof_join(left, snaps, "t", ["e"], ["p"], direction, most=m)
    assert same(run(300), run(segments.MOST))
    known = {(r["e"], r["t"]): r["p"] for r in snaps.collect()}
    for r in run(300).collect():
        times = [t for e, t in known if e == r["e"] and (t <= r["t"] if direction == "backward" else t >= r["t"])]
        assert r["p"] == (known[r["e"], (max if direction == "backward" else min)(times)] if times else None)


def test_numbers_ties_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, None, "a"), (1, 2.0, "z"), (1, 2.0, "y"), (1, 1.0, "q")] + [(1, 5.0, f"{i:03}") for i in range(50)], "k int, t double, s string")
    got = {(r["t"], r["s"]): r["n"] for r in segments.numbered(df, ["k"], "t", "n", ("s",), most=4).collect()}
    order = sorted(got, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert [got[k] for k in order] == list(range(1, 56))
    assert segments.numbered(df.limit(0), ["k"], "t", "n", most=4).count() == 0
    with pytest.raises(TypeError):
        segments.numbered(df, ["k"], "s", "n", most=4).count()


def test_positional_merge_of_a_hot_key(spark):
    rng = random.Random(8)
    left = [("hot", i) for i in range(500)] + [("a", 1), ("b", 2), (None, 3)]
    right = [("hot", 1000 + i) for i in range(340)] + [("a", 5), ("a", 6), ("d", 7), (None, 8)]
    rng.shuffle(left)
    l, r = spark.createDataFrame(left, "k string, x int").repartition(4), spark.createDataFrame(right, "k string, y int").repartition(3)
    want = [("hot", i, 1000 + min(i, 339)) for i in range(500)] + [("a", 1, 5), ("a", 1, 6), ("b", 2, None), ("d", None, 7), (None, 3, 8)]
    for most in (60, segments.MOST):
        got = [tuple(t) for t in joins.merge_mm(l, r, ["k"], ["x"], ["y"], most).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_quantiles_of_ties_hot_groups_nan_and_odd_key_names(spark):
    import numpy as np

    from sparkpanel.operators.skew import group_quantiles

    rng = random.Random(9)
    hot = [rng.choice([0.0, 0.0, rng.gauss(0, 1), float(rng.randrange(5))]) for _ in range(30_000)]
    rows = [("hot", v) for v in hot] + [("few", 1.0), ("few", float("nan")), ("few", 3.0), ("none", None), ("none", float("nan"))]
    df = spark.createDataFrame(rows, "_n string, _v double").repartition(5)
    got = {r["_n"]: r for r in group_quantiles(df, ["_n"], "_v", {"low": 0.0, "q": 0.25, "m": 0.5, "t": 0.999, "high": 1.0}).collect()}
    assert set(got) == {"hot", "few", "none"} and got["few"]["m"] == 2.0 and got["none"]["m"] is None
    assert [got["hot"][c] for c in ("low", "q", "m", "t", "high")] == pytest.approx(np.quantile(hot, [0, 0.25, 0.5, 0.999, 1]).tolist())


def test_density_of_groups_without_spread(spark):
    from sparkpanel.plans.evaluate import kde

    df = spark.createDataFrame([("one", 4.0), ("zero", 0.0), ("zero", 0.0), ("same", -2.0), ("same", -2.0), ("wide", 1.0), ("wide", 2.0)], "g string, v double")
    out = kde(df, "v", ["g"], 64).groupBy("g").agg(F.max("density").alias("d"), F.max("scaled").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert {r["g"] for r in out} == {"one", "zero", "same", "wide"} and all(r["n"] == 64 and r["s"] == 1 and r["d"] > 0 for r in out)
