"""One small case for each trap that no other test meets; the numbers are those of the survey."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkpanel.operators import aggregates, clean, dedup, windows
from sparkpanel.plans import evaluate as ev
from sparkpanel.plans import models as md
from sparkpanel.plans import prices, scores, seasons

JAN, FEB = dt.date(2010, 1, 1), dt.date(2010, 2, 1)


def test_z4_statistics_of_nothing_are_null(spark):
    df = spark.createDataFrame([("a", None, None), ("b", 1.0, 2.0)], "g string, v double, w double")
    got = {r["g"]: (r["v"], r["w"]) for r in aggregates.collapse(df, ["g"], {"mean": ["v"], "max": ["w"]}).collect()}
    assert got == {"a": (None, None), "b": (1.0, 2.0)}


def test_z6_rough_terrain_is_any_of_the_codes(spark):
    df = spark.createDataFrame([(5,), (6,), (8,)], "code int")
    got = df.select(scores.terrain_rough("code", (5, 6, 7)), scores.terrain_rough("code", (5, 6, 7), strict_reference=True)).collect()
    assert [tuple(r) for r in got] == [(1, 0), (1, 0), (0, 0)]


def test_z7_a_market_asks_its_own_neighbours(spark):
    # B is nearest to A, but A is not nearest to B.
    coords = spark.createDataFrame([("A", 0.0, 0.0), ("B", 0.0, 1.0), ("C", 0.0, 1.5)], "market string, lat double, lon double")
    dense = spark.createDataFrame([("A", "m", JAN, 1.0), ("B", "m", JAN, None), ("C", "m", JAN, 3.0), ("A", "m", FEB, None), ("B", "m", FEB, 5.0), ("C", "m", FEB, 6.0)],
                                  "market string, commodity string, month date, price double")
    got = {(r["market"], r["month"]): r["price"] for r in prices.spatial_fill(dense, coords, "cascade", 1).collect()}
    assert got[("B", JAN)] == 3.0 and got[("A", FEB)] == 5.0


def test_z8_thinness_is_that_of_the_raw_prices(spark):
    dense = spark.createDataFrame([("A", "m", JAN, 1.0), ("B", "m", JAN, None)], "market string, commodity string, month date, price double")
    coords = spark.createDataFrame([("A", 0.0, 0.0), ("B", 0.0, 1.0)], "market string, lat double, lon double")
    assert {r["market"]: r["thin"] for r in prices.thin_flag(dense).collect()} == {"A": 0, "B": 1}
    filled = prices.spatial_fill(dense, coords).withColumn("thin", F.col("donor").isNotNull().cast("int"))
    weights = spark.createDataFrame([("A", "z", 0.25), ("B", "z", 0.75)], "market string, zone string, weight double")
    row = prices.zone_price_thin(filled.drop("donor", "dist_km"), weights).first()
    assert (row["price"], row["thin"]) == (1.0, 0.75)


def test_z13_interpolation_stays_inside_an_entity(spark):
    rows = [("a", JAN, 1.0), ("a", FEB, None), ("b", JAN, None), ("b", FEB, 9.0)]
    df = spark.createDataFrame(rows, "e string, d date, v double")
    got = {(r["e"], r["d"]): r["v"] for r in windows.interp_linear(df, ["e"], "d", "v").collect()}
    assert got == {("a", JAN): 1.0, ("a", FEB): 1.0, ("b", JAN): 9.0, ("b", FEB): 9.0}


@pytest.mark.parametrize("width", [1, 5])
def test_z14_region_labels_follow_the_key_not_the_order(spark, width):
    rows = [(k, "", float(-k)) for k in (17, 3, 11, 9, 1)]
    got = {r["k"]: r["r"] for r in scores.region_fill(spark.createDataFrame(rows, "k int, r string, lat double").repartition(width), ["k"], "r", "lat").collect()}
    assert got == {17: "South", 11: "Central", 9: "Central", 3: "North", 1: "North"}


def test_z15_z22_a_gap_nulls_its_own_column_and_zone(spark):
    days = [dt.date(2009, 10, d) for d in (1, 2, 3)]
    rows = [(z, d, None if (z, d) == ("x", days[1]) else 1.0, 2009) for z in "xy" for d in days]
    tagged = spark.createDataFrame(rows, "z string, day date, rain double, cropyear int")
    got = {r["z"]: (r["raincytot"], r["rainmax"]) for r in seasons.season_stats(tagged, ["z"], "day", "rain").collect()}
    assert got == {"x": (None, 1.0), "y": (3.0, 1.0)}


def test_z16_crossed_factors_are_not_added(spark):
    # Month + cluster is 3 in every row, so a sum of the numbers would explain nothing.
    df = spark.createDataFrame([(1, 2, 5.0), (2, 1, 9.0), (1, 2, 5.0), (2, 1, 9.0)], "month int, cluster int, y double")
    assert md.group_r2(df, ["y"], {"both": ["month", "cluster"]}).first()["r2"] == pytest.approx(1.0)


def test_z17_z19_each_measure_has_its_own_fit(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, -3.0 * i + 1) for i in range(10)], "x double, a double, b double")
    fits = {f.spec.y: f.coef["x"] for f in md.fit_all(df, [md.ModelSpec("m", y, ("x",)) for y in ("a", "b")])}
    assert fits == pytest.approx({"a": 2.0, "b": -3.0})
    pairs = md.predict(df, md.fit_all(df, [md.ModelSpec("m", y, ("x",)) for y in ("a", "b")]), ["x"])
    assert pairs.filter("y = 'b' AND x = 2").first()["actual"] == -5.0


def test_z20_z24_codes_and_dates_are_compared_as_values(spark):
    df = spark.createDataFrame([(106, dt.date(2013, 7, 30)), (107, dt.date(2013, 8, 6)), (9, None)], "code int, d date")
    table = {101: "North", 106: "North", 107: "North"}
    assert [r["region"] for r in clean.recode(df, "code", table, into="region").orderBy("code").collect()] == [None, "North", "North"]
    assert df.filter(~F.col("d").isin(dt.date(2013, 7, 30))).count() == 1


def test_z23_every_commodity_has_its_own_prices(spark):
    rows = [("A", "maize", JAN, 1.0, 0), ("A", "rice", JAN, 2.0, 1)]
    df = spark.createDataFrame(rows, "market string, commodity string, month date, price double, thin int")
    row = prices.price_panel(df, ["market", "month"], {"maize": "m", "rice": "r"}, "price", "clust").first()
    assert (row["clust_m_price"], row["clust_r_price"], row["clust_m_mktthin"], row["clust_r_mktthin"]) == (1.0, 2.0, 0, 1)


def test_z25_clusters_with_equal_outcomes_stay_apart(spark):
    df = spark.createDataFrame([(1, 4.0), (2, 4.0), (2, 4.0)], "ea int, mean double")
    assert sorted(r["ea"] for r in dedup.first_per_key(df, ["ea"], ["mean"]).collect()) == [1, 2]


def test_z26_boundaries_belong_to_a_class(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 3, 6, 9)], "v double")
    assert all(r[0] is not None for r in df.select(ev.class_rank("v", "HDDS")).collect())


def test_z27_every_statistic_reaches_the_season_table(spark):
    day = dt.date(2009, 10, 1)
    rain = spark.createDataFrame([("e", day, 3.0, 2009)], "entity string, day date, rain double, cropyear int")
    temp = spark.createDataFrame([("z", day, 20.0)], "zone string, day date, tmean double")
    zones = spark.createDataFrame([("e", "z")], "entity string, zone string")
    out = seasons.season_panel(rain, temp, seasons.unimodal_seasons(spark, 2009, 2009), "entity", "zone", zones, flood_zones=["z"]).first().asDict()
    floods = out.pop("floodmax")
    assert out == {"zone": "z", "FS_year": 2010, "entity": "e", "raincytot": 3.0, "day1rain": None, "maxdaysnorain": 0, "rainmax": 3.0, "tmean": 20.0, "gdd": 1, "heatdays": 0}
    assert floods is None  # floods are keyed by the crop year itself
