import csv
import math
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkpanel.plans import evaluate as ev
from sparkpanel.sources.io import read_dir

# Folder of published results: pair tables per level, squared correlations, class errors.
GOLD = Path(os.environ.get("PUBLISHED_RESULTS", "/nonexistent"))
needs_gold = pytest.mark.skipif(not GOLD.exists(), reason="set PUBLISHED_RESULTS to the folder of published results")


def test_cuts_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 3, 3.01, 6, 6.5)] + [(None,)], "v double")
    assert [r[0] for r in df.select(ev.class_rank("v", "HDDS")).collect()] == [None, 1, 2, 2, 3, None]
    df = spark.createDataFrame([(float(x),) for x in (-5, 4, 4.5, 17, 42, 43)], "v double")
    assert [r[0] for r in df.select(ev.class_rank("v", "rCSI")).collect()] == [1, 1, 2, 2, 3, 4]
    df = spark.createDataFrame([(math.log(28),), (math.log(42),), (math.log(43),)], "v double")
    assert [r[0] for r in df.select(ev.categorise("v", "logFCS")).collect()] == ["Poor", "Borderline", "Acceptable"]


def test_confusion_has_every_cell(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("a", "a"), (None, "a")], "p string, q string")
    got = {(r["predicted"], r["actual"]): r["n"] for r in ev.confusion(df, "p", "q", ["a", "b"]).collect()}
    assert got == {("a", "a"): 2, ("a", "b"): 1, ("b", "a"): 0, ("b", "b"): 0}


def test_error_regions(spark):
    df = spark.createDataFrame([(5.0, 7.0), (7.0, 5.0), (4.0, 5.0), (5.0, 4.0), (6.5, 7.0), (7.0, 6.5), (5.0, 5.0)], "a double, p double")
    assert [r[0] for r in df.select(ev.error_region("p", "a", "HDDS")).collect()] == ["I", "IV", "IIa", "IIIa", "IIb", "IIIb", None]
    df = spark.createDataFrame([(10.0, 2.0), (2.0, 10.0), (10.0, 7.0), (2.0, 0.5), (2.0, 3.0), (7.0, 10.0)], "a double, p double")
    assert [r[0] for r in df.select(ev.error_region("p", "a", "rCSI")).collect()] == ["I", "IV", "IIb", "IIa", "IIIa", "IIIb"]


def test_fit_errors_and_kde(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, None)], "p double, a double")
    r = ev.fit_errors(df, "p", "a").first()
    assert r["rmse"] == pytest.approx(math.sqrt(0.5)) and r["rmse_all_rows"] == pytest.approx(math.sqrt(1 / 3)) and r["mae"] == 0.5
    v = spark.createDataFrame([("g", float(i % 10)) for i in range(200)], "g string, v double")
    d = ev.kde(v, "v", ["g"], 128).orderBy("i").collect()
    both = ev.kde(v.unionByName(v.select(F.lit(None).cast("string").alias("g"), (F.col("v") * 2).alias("v"))), "v", ["g"], 64)
    assert {(r["g"], r["count"]) for r in both.groupBy("g").count().collect()} == {("g", 64), (None, 64)}
    step = d[1]["x"] - d[0]["x"]
    assert sum(x["density"] for x in d) * step == pytest.approx(1, abs=0.01) and max(x["scaled"] for x in d) == 1.0


def gold_pairs(spark, tail):
    end = "_tail" if tail else ""
    folder = "prediction_tail" if tail else "prediction"
    return read_dir(
        spark, f"{GOLD}/{folder}/*/*{end}_pair.csv", r"^([A-Za-z]+)_([A-Za-z]+)_(model\d)" + end + r"_pair\.csv$",
        ["measure", "level", "model"], "actual double, predict double")


@needs_gold
@pytest.mark.parametrize("tail", [False, True])
def test_published_r2(spark, tail):
    got = {(r["level"], r["model"], r["measure"]): r["r2"] for r in gold_pairs(spark, tail).groupBy("measure", "level", "model").agg(
        F.round(F.pow(F.corr("predict", "actual"), F.lit(2.0)), 3).alias("r2")).collect()}
    seen = 0
    for path in GOLD.glob("**/*r2matrix.csv"):
        if ("_tail_" in path.name) != tail:
            continue
        level = path.name.split("_")[0]
        for i, row in enumerate(csv.DictReader(path.open())):
            for m in ("logFCS", "HDDS", "rCSI"):
                assert (got[(level, f"model{i}", m)] or 0) == pytest.approx(float(row[m]), abs=1e-9)
                seen += 1
    assert seen == 36


@needs_gold
@pytest.mark.parametrize("tail", [False, True])
def test_published_class_errors(spark, tail):
    scored = ev.score_measures(gold_pairs(spark, tail), "predict", "actual", "measure", ["level", "model"], list(ev.CUTS))
    got = {(r["measure"], r["level"], r["model"][-1]): r for r in scored.collect()}
    (path,) = GOLD.glob(f"*matrix_{'tail' if tail else 'full'}.csv")
    rows = list(csv.DictReader(path.open()))
    assert len(rows) == 27
    for row in rows:
        m, lv, k = (row.get("model") or row[""]).split("_")[:3]
        for col in ("accuracy", "type1", "type2"):
            assert got[(m, lv, k[1])][col] == pytest.approx(float(row[col]), abs=1e-9)


@needs_gold
def test_published_over_under(spark):
    best = gold_pairs(spark, False).filter("level = 'clust' AND model = 'model3'")
    got = {r["measure"]: (r["over"], r["under"]) for r in ev.over_under(best, "predict", "actual", ["measure"]).collect()}
    assert got == {"HDDS": (43, 160), "logFCS": (37, 166), "rCSI": (124, 79)}


def test_long_and_single_measure_scores_agree(spark):
    vals = [(m, float(a), float(p)) for m, s in (("HDDS", 1.0), ("rCSI", 4.0), ("logFCS", 0.6)) for a, p in [(s * (i % 9), s * (i * 5 % 11)) for i in range(60)]]
    df = spark.createDataFrame(vals, "measure string, actual double, predict double")
    long = {r["measure"]: r for r in ev.score_measures(df, "predict", "actual", "measure", [], list(ev.CUTS)).collect()}
    for m in ev.CUTS:
        one = ev.score_classes(df.filter(F.col("measure") == m), "predict", "actual", m).first()
        for col in ("accuracy", "type1", "type2", "recall", "pairs"):
            assert one[col] == long[m][col]
