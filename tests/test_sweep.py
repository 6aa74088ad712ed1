"""Sweeps of many specifications: products and scores by sums of tasks, and the columns that the query reads."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkpanel.plans import models as md
from sparkpanel.plans.evaluate import score_measures
from sparkpanel.queries import fits


class Asked(Exception):
    pass


def stop(spark, sf, cols=()):
    raise Asked(set(cols))


def panel_rows(n=900, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({c: rng.normal(0, 1, n) for c in "abc"})
    pdf["HDDS"] = np.round(5 + pdf.a - pdf.b + rng.normal(0, 1, n), 1)
    pdf["rCSI"] = np.abs(np.round(8 + 3 * pdf.c + rng.normal(0, 4, n), 0))
    pdf = pdf.astype(object)
    for i, c in enumerate(pdf.columns):
        pdf.loc[rng.random(n) < 0.04 * i, c] = None
    return [tuple(r) for r in pdf.itertuples(index=False)]


SCHEMA = "a double, b double, c double, HDDS double, rCSI double"
SETS = {"none": (), "one": ("a",), "two": ("a", "b"), "three": ("a", "b", "c"), "twice": ("a", "a2")}


def test_sweep_asks_the_panel_for_the_columns_of_its_sets(spark, monkeypatch):
    monkeypatch.setattr(fits, "clusters", stop)
    with pytest.raises(Asked) as asked:
        fits.spec_sweep(spark, "")
    used = {x for xs in fits.SETS.values() for x in xs}
    assert asked.value.args[0] == {"ea_id", "FS_year", "FS_month", "region", *fits.MEASURES, *used} - {"trend", "station_current", "station_lag"}


def test_products_of_specs_are_those_of_their_complete_rows(spark):
    rows = panel_rows()
    df = spark.createDataFrame([(i % 3, *r) for i, r in enumerate(rows)], "f int, " + SCHEMA)
    specs = [md.ModelSpec(f"{y}{n}", y, xs) for y in ("HDDS", "rCSI") for n, xs in SETS.items() if n != "twice"]
    found = md.grams(df, specs, "f", 3)
    pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")], dtype=float)
    for s, spec in enumerate(specs):
        for f in range(3):
            cols = [*spec.xs, spec.y]
            part = pdf.iloc[f::3][cols].dropna().to_numpy()
            z = np.column_stack([np.ones(len(part)), part - found[(s, f)].shift])
            assert found[(s, f)].matrix == pytest.approx(z.T @ z, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("odd", [False, True])
def test_fits_are_scored_without_a_row_for_each(spark, monkeypatch, odd):
    rows = panel_rows()
    # NaN counts as known in the scores, and null does not.
    more = [(float("nan"), 1.0, 1.0, 5.0, 3.0), (1.0, 1.0, float("nan"), None, 3.0), (0.5, 0.1, 0.2, 5.0, float("nan"))] if odd else []
    train = spark.createDataFrame(rows, SCHEMA).withColumn("a2", F.col("a") * 2)
    test = spark.createDataFrame(rows[:300] + more, SCHEMA).withColumn("a2", F.col("a") * 2).repartition(5)
    specs = [md.ModelSpec(n, y, xs) for y in ("HDDS", "rCSI") for n, xs in SETS.items() if xs]
    models = md.fit_all(train, specs)
    want = score_measures(md.predict(test, models, []), "predict", "actual", "y", ["model"], ["HDDS", "rCSI"])
    want = {(r["model"], r["y"]): r for r in want.collect()}
    monkeypatch.setattr(md, "predict", lambda *_: pytest.fail("a row for each fit"))
    got = md.score_fits(test, models).collect()
    assert len(got) == len(want) == 8
    for r in got:
        w = want[(r["model"], r["y"])]
        assert r["pairs"] == w["pairs"] and all(
            r[k] is None and w[k] is None or r[k] == pytest.approx(w[k], rel=1e-9, nan_ok=True) for k in ("r2", "accuracy", "recall"))
    assert md.sweep({"all": (train, test)}, {"one": ("a",)}, ["HDDS"], []).columns == ["split", "model", "y", "r2", "accuracy", "recall", "pairs"]
    assert md.score_fits(test.filter("a > 1e9 AND a < 0"), models).count() == 0
