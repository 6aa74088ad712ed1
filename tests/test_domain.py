import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkpanel.functions.calendar import excel_date, month_from_abbrev, quarter_flags, season_day
from sparkpanel.functions.strings import dotted_date, normalise_name
from sparkpanel.plans import panel, prices, scores, seasons


def daily(spark, start, values, e="a"):
    return spark.createDataFrame([(e, start + dt.timedelta(days=i), v) for i, v in enumerate(values)], "e string, day date, rain double")


def test_season_statistics(spark):
    # Days 3 to 7 wet, so the five-day median first passes 2.2 on day 1: onset 1 + 2.
    rain = [0.0, 0.0, 3.0, 3.0, 3.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    cal = seasons.unimodal_seasons(spark, 2009, 2010)
    tagged = seasons.season_join(daily(spark, dt.date(2009, 10, 1), rain), "day", cal)
    got = seasons.season_stats(tagged, ["e"], "day", "rain").first()
    assert (got["cropyear"], got["raincytot"], got["day1rain"], got["maxdaysnorain"], got["rainmax"]) == (2009, 10.0, 3, 4, 3.0)
    never = seasons.season_stats(seasons.season_join(daily(spark, dt.date(2009, 10, 1), [0.0] * 9), "day", cal), ["e"], "day", "rain").first()
    assert never["day1rain"] is None and never["maxdaysnorain"] == 9
    gap = seasons.season_total(seasons.season_join(daily(spark, dt.date(2009, 10, 1), [1.0, None]), "day", cal), ["e"], "rain").first()
    assert gap["raincytot"] is None


def test_overlapping_seasons_give_two_rows(spark):
    cal = seasons.bimodal_seasons(spark, 2008, 2012)
    ends = {r["cropyear"]: r["end"].year for r in cal.collect()}
    assert ends == {2008: 2008, 2009: 2009, 2010: 2011, 2011: 2012, 2012: 2013}
    tagged = seasons.season_join(daily(spark, dt.date(2011, 5, 1), [1.0]), "day", cal)
    assert {r["cropyear"] for r in tagged.collect()} == {2010, 2011}


def test_temperature_bounds_are_strict(spark):
    df = spark.createDataFrame([("z", 2009, t) for t in (8.0, 8.1, 29.9, 30.0, 31.0)], "z string, cropyear int, tmean double")
    got = seasons.temp_stats(df, ["z"]).first()
    assert (got["gdd"], got["heatdays"]) == (2, 2)


def test_calendar_functions(spark):
    d = spark.createDataFrame([(dt.date(2010, 2, 1),), (dt.date(2010, 4, 15),), (dt.date(2010, 10, 3),)], "d date")
    assert [r[0] for r in d.select(season_day("d")).collect()] == [124, None, 3]
    assert [r[0] for r in d.select(season_day("d", legacy=True)).collect()] == [121, None, 3]
    q = d.select(quarter_flags(F.month("d"))["quarter2"], quarter_flags(F.month("d"), True)["quarter2"]).collect()
    assert [tuple(r) for r in q] == [(0, 0), (1, 0), (0, 0)]
    one = spark.range(1).select(
        excel_date(F.lit(40179)), month_from_abbrev(F.lit("Sept")), normalise_name(F.lit(" Bembeke.Turn.Off "), {"BEMBEKE TURN OFF": "BEMBEKE"}),
        dotted_date(F.lit("X2006.01.15")), month_from_abbrev(F.lit("xyz"))).first()
    assert tuple(one) == (dt.date(2010, 1, 1), 9, "BEMBEKE", dt.date(2006, 1, 15), None)


M1, M2 = dt.date(2010, 1, 1), dt.date(2010, 2, 1)


def market_data(spark):
    # Four markets on a line, one degree apart; C and D lack January, D lacks February too.
    obs = [("A", "maize", M1, 1.0), ("B", "maize", M1, 2.0), ("A", "maize", M2, 5.0), ("B", "maize", M2, 6.0), ("C", "maize", M2, 7.0), ("D", "nuts", M1, 9.0)]
    coords = spark.createDataFrame([("A", 0.0, 0.0), ("B", 0.0, 1.0), ("C", 0.0, 2.0), ("D", 0.0, 3.1)], "market string, lat double, lon double")
    return prices.dense_prices(spark.createDataFrame(obs, "market string, commodity string, month date, price double")), coords


def test_spatial_fill(spark):
    dense, coords = market_data(spark)
    assert dense.count() == 16
    got = {(r["market"], r["month"]): (r["price"], r["donor"]) for r in prices.spatial_fill(dense, coords, k_max=1).filter("commodity = 'maize'").collect()}
    assert got[("C", M1)] == (2.0, "B") and got[("D", M1)] == (2.0, "B") and got[("D", M2)] == (7.0, "C") and got[("A", M1)] == (1.0, None)
    cascade = {(r["market"], r["month"]): r["price"] for r in prices.spatial_fill(dense, coords, "cascade", 2).filter("commodity = 'maize'").collect()}
    # Round 1: D asks C, which holds nothing before the round; round 2: D asks B.
    assert cascade[("C", M1)] == 2.0 and cascade[("D", M1)] == 2.0
    # However few neighbours are ranked at once, only cells that no market of the month fills stay open.
    for mode in ("cascade", "growing"):
        filled = prices.spatial_fill(dense, coords, mode, 1)
        assert filled.filter("price IS NULL").select("commodity", "month").distinct().count() == 1 and filled.count() == 16
    nuts = prices.spatial_fill(dense, coords, "cascade", 1).filter("commodity = 'nuts' AND month = '2010-02-01'")
    assert nuts.filter("price IS NOT NULL").count() == 0
    left = [r["missing"] for r in prices.missing_by_k(dense, coords, 3).orderBy("k").collect()]
    assert left == sorted(left, reverse=True)
    known = dense.filter("price IS NOT NULL").select("market", "commodity", "month", "price")
    assert known.exceptAll(prices.spatial_fill(dense, coords).select("market", "commodity", "month", "price")).count() == 0


def test_zone_price_is_null_with_a_missing_member(spark):
    dense, _ = market_data(spark)
    w = spark.createDataFrame([("A", "z", 0.25), ("B", "z", 0.75), ("C", "y", 1.0)], "market string, zone string, weight double")
    got = {(r["zone"], r["commodity"], r["month"]): r["zone_price"] for r in prices.zone_price(dense, w).collect()}
    assert got[("z", "maize", M1)] == 1.75 and got[("y", "maize", M1)] is None and got[("y", "maize", M2)] == 7.0


def test_donor_and_catchment(spark):
    ents = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 1.0), (3, 0.0, 1.2)], "e int, lat double, lon double")
    series = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "e int, v string")
    got = {(r["e"], r["v"], r["donor"]) for r in prices.donor_fill(series, ents, "e").collect()}
    assert got == {(1, "x", 1), (2, "y", 2), (2, "z", 2), (3, "y", 2), (3, "z", 2)}
    square = [{"x": a, "y": b} for a, b in ((-1.0, -1.0), (5.0, -1.0), (5.0, 1.0), (-1.0, 1.0))]
    zones = spark.createDataFrame([("z", square)], "zone string, ring array<struct<x double, y double>>")
    pixels = spark.createDataFrame([(0.0, 0.0, 10.0), (0.0, 0.2, 20.0), (0.0, 3.0, 70.0), (9.0, 9.0, 99.0)], "lat double, lon double, pop double")
    _, coords = market_data(spark)
    w = {r["market"]: r["weight"] for r in prices.catchment_weights(pixels, zones, coords, "zone").collect()}
    assert w == pytest.approx({"A": 0.3, "D": 0.7})


def test_scores(spark):
    items = [("h", "A", 8), ("h", "B", 3), ("h", "C", 1), ("h", "J", 7), ("h", "I", 2), ("e", "D", 0)]
    df = spark.createDataFrame(items, "hh string, g string, d int")
    assert {r["hh"]: r["FCS"] for r in scores.food_consumption_score(df, "hh", "g", "d").collect()} == {"h": 18.0, "e": 0.0}
    assert {r["hh"]: r["HDDS"] for r in scores.dietary_diversity(df, "hh", "g", "d").collect()} == {"h": 2, "e": 0}
    c = spark.createDataFrame([(7, 7, 7, 7, 7), (1, 1, 1, 1, 1), (1, None, 1, 1, 1)], "a int, b int, c int, d int, e int")
    assert [r["rCSI"] for r in scores.coping_index(c, list("abcde")).collect()] == [42, 8, None]
    assert [r["rCSI"] for r in scores.coping_index(c, list("abcde"), stata_missing=True).collect()] == [42, 8, 42]
    m = spark.createDataFrame([(1, "X", None), (2, "X", "X"), (None, "X", "")], "g int, m1 string, m2 string")
    assert [r["MAHFP"] for r in scores.months_adequate(m, ["m1", "m2"], "g").collect()] == [11, 12, 12]
    a = spark.createDataFrame([("h", 507, 1), ("h", 507, 1), ("h", 509, 0), ("g", 1, 5)], "hh string, c int, q int")
    got = {r["hh"]: (r["asset_507"], r["asset_509"]) for r in scores.asset_dummies(a, "hh", "c", "q").collect()}
    assert got == {"h": (1, 0), "g": (0, 0)}


def test_asset_index_is_standardised(spark):
    df = spark.createDataFrame([(float(i % 5), float((i * 3) % 7), float(i % 5 + (i % 2))) for i in range(60)], "a double, b double, c double")
    one = scores.asset_index(df, ["a", "b", "c"], rotate=False, factors=1)
    st = one.agg(F.avg("asset_index"), F.stddev_samp("asset_index"), F.corr("asset_index", "a")).first()
    assert st[0] == pytest.approx(0, abs=1e-9) and st[1] == pytest.approx(1, abs=1e-6) and st[2] > 0.8
    assert "asset_index" in scores.asset_index(df, ["a", "b", "c"]).columns


def test_region_fill(spark):
    df = spark.createDataFrame([(1, "", -17.0), (2, "", -12.0), (3, "", -9.0), (4, "North", -17.0), (4, "", -17.0), (5, "South", 0.0), (5, "Central", 0.0)], "k int, r string, lat double")
    got = {r["k"]: r["r"] for r in scores.region_fill(df, ["k"], "r", "lat").collect()}
    assert got == {1: "South", 2: "Central", 3: "North", 4: "North", 5: "Central"}


def test_hh_panel_lags_by_month(spark):
    hh = spark.createDataFrame([(1, "z", M2, 2010), (2, "y", M1, 2010)], "id int, zone string, month date, FS_year int")
    pr = spark.createDataFrame([("z", M1, 1.0), ("z", M2, 2.0)], "zone string, month date, maize double")
    se = spark.createDataFrame([("z", 2010, 99.0)], "zone string, FS_year int, rain double")
    got = panel.hh_panel(hh, pr, se, ["zone"], ["zone", "FS_year"], required=["maize_current"]).collect()
    assert len(got) == 1 and (got[0]["maize_current"], got[0]["maize_lag"], got[0]["rain"]) == (2.0, 1.0, 99.0)


def test_asset_index_from_sums_about_the_means(spark, monkeypatch):
    """Two cheap aggregates in place of one of all correlations; constant columns stay out."""
    monkeypatch.setattr(scores.F, "corr", None)
    data = [(float(i % 5), 1e9 + (i * 3) % 7, float(i % 5 + (i % 2)), 0.1) for i in range(61)]
    df = spark.createDataFrame([*data, (None, 1.0, 1.0, 5.0)], "a double, b double, c double, d double")
    out = scores.asset_index(df, list("abcd"), rotate=False)
    x = np.array(data)[:, :3]
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    values, vectors = np.linalg.eigh(np.corrcoef(x.T))
    want = z @ vectors[:, -1] / np.sqrt(values[-1])
    want *= 1 if vectors[np.argmax(np.abs(vectors[:, -1])), -1] > 0 else -1
    got = [(r["a"], r["b"], r["asset_index"]) for r in out.collect()]
    assert [g[2] for g in got[:61]] == pytest.approx(list(want)) and got[61][2] is None
    flat = scores.asset_index(df.limit(1), list("abcd"))
    assert flat.collect()[0]["asset_index"] is None
