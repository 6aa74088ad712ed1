"""Written stages: read by column, with every kind of value intact."""

import re

import pytest
from pyspark.sql import functions as F

from sparkpanel.operators.joins import asof_join
from sparkpanel.plans import panel
from sparkpanel.plans.panel import hh_panel
from sparkpanel.queries import base, fits, survey
from sparkpanel.session import cut_lineage


def test_stage_keeps_rows_and_reads_wanted_columns(spark, rows):
    df = spark.range(50).select(
        "id", (F.col("id") / 7).alias("quarter1_region_MIDDLE EAST"), F.when(F.col("id") > 9, F.array(F.struct("id", F.lit("x").alias("s")))).alias("links"),
        F.date_add(F.lit("1500-01-01").cast("date"), F.col("id").cast("int")).alias("day"), F.when(F.col("id") % 3 > 0, F.lit(float("nan"))).alias("v"))
    stage = cut_lineage(df)
    assert stage.dtypes == df.dtypes and rows(stage.select(*[F.col(f"`{c}`").cast("string") for c in df.columns])) == rows(
        df.select(*[F.col(f"`{c}`").cast("string") for c in df.columns]))
    plan = stage.select("day")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<day:date>" in plan
    assert cut_lineage(df.filter("id < 0")).count() == 0


def test_a_fit_stages_its_own_columns(spark, monkeypatch):
    wide = spark.range(8).select(F.col("id").alias("ea_id"), *[F.col("id").alias(f"c{i}") for i in range(5)])
    monkeypatch.setattr(fits, "clusters", lambda *_: wide)
    assert fits.staged(spark, "", "ea_id", "c1", "ea_id").columns == ["ea_id", "c1"] and fits.staged(spark, "").columns == wide.columns


def unknown_size(df):
    """The same rows with an estimate far beyond what is broadcast."""
    none = df.sparkSession.range(1).withColumnRenamed("id", "_n")
    for i in range(4):
        none = none.crossJoin(df.sparkSession.range(100_000).select(F.col("id").alias(f"_n{i}")))
    return df.join(none.limit(1).select("_n"), F.lit(True), "left").drop("_n")


def physical(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_small_tables_beside_households_are_broadcast(spark, rows):
    hh = unknown_size(spark.createDataFrame([(1, 1, "2000-02-01"), (2, 1, "2000-03-01"), (3, 2, "2000-02-01"), (4, None, None)], "id int, zone int, month string"))
    hh = hh.withColumn("month", F.col("month").cast("date"))
    prices = spark.createDataFrame([(1, "2000-02-01", 5.0), (2, "2000-01-01", 7.0)], "zone int, month string, p double").withColumn("month", F.col("month").cast("date"))
    season = spark.createDataFrame([(1, 9.0)], "zone int, rain double")
    out = hh_panel(hh, unknown_size(prices), unknown_size(season), ["zone"], ["zone"])
    assert "SortMergeJoin" not in physical(out)
    assert rows(out, "id", "p_current", "p_lag", "rain") == [(1, 5.0, None, 9.0), (2, None, 5.0, 9.0), (3, None, 7.0, None), (4, None, None, None)]
    near = asof_join(hh, unknown_size(prices), "month", ["zone"], ["p"])
    assert "SortMergeJoin" not in physical(near)
    assert rows(near, "id", "p") == [(1, 5.0), (2, 5.0), (3, 7.0), (4, None)]


def test_items_of_households_are_dealt_out_once(spark, tmp_path, monkeypatch, rows):
    lines = [(h, p, float(q)) for h in (1, 2, None) for p, q in ((0, 3), (7, 11), (13, 2 * (h or 4)), (22, 5))]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    plans = []
    monkeypatch.setattr(survey, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut_lineage(df))
    monkeypatch.setattr(survey.scores, "asset_index", lambda df, cols, name: df.withColumn(name, sum(F.col(c) for c in cols)))
    got = {r.case_id: (r.FCS, r.HDDS, r.asset) for r in survey.household_items(spark, str(tmp_path)).collect() if r.case_id}
    assert plans[0].count("FileScan parquet") == 2 and plans[0].count("Exchange") == 2 and len(set(re.findall(r"FileScan parquet (\[[^]]*\])", re.sub(r"#\d+L?", "", plans[0])))) == 1
    food = {r.hh: (r.FCS, r.HDDS) for r in survey.scores.food_scores(survey.lettered(spark, str(tmp_path)), "hh", "group", "days").collect() if r.hh}
    assert {k: v[:2] for k, v in got.items()} == food and {k: v[2] for k, v in got.items()} == {
        r.hh: sum(r[1:]) for r in survey.asset_dummies(spark, str(tmp_path)).collect() if r.hh}


def test_daily_rain_is_summed_after_its_lines_are_dealt_out(spark, rows, tmp_path):
    """One line a day and entity is the rule: sums in front of the shuffle hold a row for each line and spill."""
    spark.createDataFrame(
        [(1, "1995-01-01 00:00:00", 2.0), (1, "1995-01-01 00:00:00", 3.0), (1, "1995-01-02 00:00:00", None), (None, None, 4.0), (None, None, 5.0)],
        "l_suppkey long, l_shipdate string, l_quantity double").withColumn("l_shipdate", F.to_timestamp_ntz("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    out = base.rain_obs(spark, str(tmp_path))
    assert rows(out.select("entity", F.col("day").cast("string"), "rain")) == [(1, "1995-01-01", 5.0), (1, "1995-01-02", None), (None, None, 9.0)]
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("HashAggregate") == 2 and "HashAggregate" not in plan[plan.index("Exchange") :]


def test_cluster_panel_stages_what_wanted_columns_need(spark, rows, monkeypatch):
    """Columns nobody reads later are not written beside the households and clusters, and the rows stay."""
    hh = spark.createDataFrame(
        [(c, y, m, "a" if c in (1, 2) else None, "N" if c == 1 else "S", float(v), float(v * (c or 7)), float(v)) for c, y, m, v in (
            (1, 2000, 2, 3), (1, 2000, 2, 4), (2, 2000, 7, 1), (3, 2001, 5, 9), (3, 2001, 6, 2), (None, 2001, 1, 8))],
        "ea int, year int, month int, area string, region string, FCS double, rain double, other double")
    stages = []
    monkeypatch.setattr(panel, "cut_lineage", lambda df: stages.append(df.columns) or cut_lineage(df))
    make = lambda **more: panel.cluster_panel(hh, "ea", "year", "month", ["area", "region"], "area", ["rain", "other"], "region", ["N", "S"], **more)
    whole, cols = make(), ["ea", "year", "area", "region", "month", "logFCS", "TA_rain", "quarter1", "quarter3_region_S", "month7"]
    stages.clear()
    some = make(wanted=cols)
    assert stages and all("other" not in s for s in stages) and "TA_other" not in some.columns
    assert rows(some, *cols) == rows(whole, *cols) and [t for t in some.dtypes if t[0] in cols] == [t for t in whole.dtypes if t[0] in cols]
    few = make(wanted=["ea", "region_N"])
    assert rows(few, "ea", "region_N") == rows(whole, "ea", "region_N") and "FCS" not in few.columns


def test_fits_ask_the_panel_for_their_columns(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(fits, "clusters", lambda spark, sf, *wanted: asked.append(wanted) or spark.range(2).select(F.col("id").alias("ea_id"), F.lit(1999).alias("FS_year")))
    fits.staged(spark, "", "ea_id")
    fits.split_year(spark, "")
    assert asked == [(("ea_id",),), (("ea_id", "FS_year"),)]


def test_filled_panel_stages_what_it_reads(spark, monkeypatch):
    class Staged(Exception):
        pass

    def stop(df):
        raise Staged(df.columns)

    names = ["case_id", "ea_id", "zone", "TA_names", "region", "FS_year", "FS_month", "month", "FCS", "HDDS", "asset", "IPC1", *survey._FILLED]
    monkeypatch.setattr(survey, "gappy", lambda *_: spark.range(1).select(*[F.col("id").alias(c) for c in names]))
    monkeypatch.setattr(survey, "cut_lineage", stop)
    with pytest.raises(Staged) as found:
        survey.cluster_panel_filled(spark, "")
    assert found.value.args[0] == [c for c in names if c not in ("case_id", "HDDS", "asset", "IPC1")]
