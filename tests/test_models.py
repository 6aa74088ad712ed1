import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkpanel.plans import models as md


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    n = 400
    pdf = pd.DataFrame({"key": range(n), "a": rng.normal(100, 3, n), "b": rng.normal(0, 1, n), "f": [f"g{i % 4}" for i in range(n)]})
    pdf["c"] = 2 * pdf.a - pdf.b
    pdf["k"] = 5.0
    pdf["y"] = 1 + 0.5 * pdf.a - 2 * pdf.b + (pdf.f == "g2") * 3 + rng.normal(0, 1, n)
    pdf["holed"] = pdf.b.where(pdf.key % 10 != 0, None)
    return pdf, spark.createDataFrame(pdf).withColumn("holed", F.nanvl("holed", F.lit(None))).repartition(5).cache()


def numpy_ols(pdf, xs, y="y"):
    x = np.column_stack([np.ones(len(pdf)), pdf[xs]])
    b, *_ = np.linalg.lstsq(x, pdf[y], rcond=None)
    e = pdf[y] - x @ b
    s2 = e @ e / (len(pdf) - x.shape[1])
    return b, np.sqrt(np.diag(s2 * np.linalg.inv(x.T @ x))), 1 - e @ e / ((pdf[y] - pdf[y].mean()) ** 2).sum()


def test_ols_matches_numpy(data):
    pdf, df = data
    b, se, r2 = numpy_ols(pdf, ["a", "b"])
    fit = md.ols_fit(df, "y", ["a", "b"])
    assert list(fit.coef.values()) == pytest.approx(list(b), rel=1e-9)
    assert list(fit.se.values()) == pytest.approx(list(se), rel=1e-8) and fit.r2 == pytest.approx(r2, rel=1e-9)


def test_aliased_regressors_are_dropped_in_declared_order(data):
    pdf, df = data
    fit = md.ols_fit(df, "y", ["k", "a", "b", "c"])
    assert fit.dropped == ["k", "c"] and list(fit.coef) == ["intercept", "a", "b"]
    other = md.ols_fit(df, "y", ["c", "a", "b"])
    assert other.dropped == ["b"] and other.r2 == pytest.approx(fit.r2, rel=1e-9)


def test_each_spec_uses_its_own_complete_rows(data):
    pdf, df = data
    one, two = md.fit_all(df, [md.ModelSpec("m", "y", ("a", "holed")), md.ModelSpec("n", "y", ("a",))])
    b, _, _ = numpy_ols(pdf.dropna(subset=["holed"]).assign(holed=lambda d: d.holed.astype(float)), ["a", "holed"])
    assert (one.n, two.n) == (360, 400) and list(one.coef.values()) == pytest.approx(list(b), rel=1e-9)
    pairs = md.predict(df, [one], ["key"])
    assert pairs.filter("predict IS NULL").count() == 40


def test_fixed_effects_two_ways(data):
    pdf, df = data
    dummy = md.fe_ols(df, "y", ["a", "b"], ["f"])
    within = md.within_ols(df, "y", ["a", "b"], "f")
    assert within.coef["a"] == pytest.approx(dummy.coef["a"], rel=1e-8) and "f_g0" not in dummy.coef and "f_g2" in dummy.coef
    assert within.se["a"] == pytest.approx(dummy.se["a"], rel=1e-8) and within.df_resid == dummy.df_resid == 400 - 6
    assert within.overall_r2 == pytest.approx(dummy.r2, rel=1e-8) and within.r2 < dummy.r2 and "intercept" not in within.coef
    # A column that looks like a dummy plays no part.
    clash = md.fe_ols(df.withColumn("f_g2", F.lit(7)), "y", ["a", "b"], ["f"])
    assert clash.coef == pytest.approx(dummy.coef, rel=1e-8)
    r2 = {(r["measure"], r["factor"]): r["r2"] for r in md.group_r2(df, ["y"], {"f": ["f"]}).collect()}
    assert r2[("y", "f")] == pytest.approx(md.fe_ols(df, "y", [], ["f"]).r2, rel=1e-8)


def test_p_values():
    assert md.t_two_sided(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert md.t_two_sided(0.0, 10) == 1.0 and md.t_two_sided(12.706, 1) == pytest.approx(0.05, abs=1e-4)


def test_elastic_net_limits(data):
    pdf, df = data
    tiny = md.elastic_net_cv(df, "y", ["a", "b"], "key", [1.0], [1e-6], folds=4)
    b, *_ = numpy_ols(pdf, ["a", "b"])
    assert list(tiny.coef.values()) == pytest.approx(list(b), abs=1e-3)
    huge = md.elastic_net_cv(df, "y", ["a", "b"], "key", [1.0], [1e3], folds=4)
    assert huge.coef["a"] == 0 and huge.coef["intercept"] == pytest.approx(pdf.y.mean())
    grid = md.elastic_net_cv(df, "y", ["a", "b"], "key", folds=4)
    assert len(grid.path) == 11 * 100 and grid.cv_rmse == min(p[2] for p in grid.path) and 1.2 < grid.cv_rmse < 2.2
    # Ridge has a closed form on standardised regressors.
    lam = 0.7
    ridge = md.elastic_net_cv(df, "y", ["a", "b"], "key", [0.0], [lam], folds=4)
    z = (pdf[["a", "b"]] - pdf[["a", "b"]].mean()) / pdf[["a", "b"]].std(ddof=0)
    w = np.linalg.solve(z.T @ z / len(z) + lam * np.eye(2), z.T @ (pdf.y - pdf.y.mean()) / len(z)) / pdf[["a", "b"]].std(ddof=0)
    assert [ridge.coef["a"], ridge.coef["b"]] == pytest.approx(list(w), rel=1e-5)


def test_tobit_recovers_the_latent_slope(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, 3000)
    y = np.maximum(0.0, 0.5 + 1.5 * x + rng.normal(0, 1, 3000))
    df = spark.createDataFrame(pd.DataFrame({"x": x, "twice": 2 * x, "y": y}))
    fit = md.tobit_fit(df, "y", ["x", "twice"])
    assert fit.coef["x"] == pytest.approx(1.5, abs=0.1) and fit.sigma == pytest.approx(1, abs=0.08) and "twice" not in fit.coef
    assert fit.censored == int((y == 0).sum()) and fit.lnl > fit.lnl0 and fit.gradient < 1e-6
    # The slope's error is near that of the simulation, and above that of a fit without censoring.
    assert 0.02 < fit.se["x"] < 0.05 and {t for t, *_ in fit.rows()} == {"intercept", "x"} and all(p < 1e-6 for *_, p in fit.rows())
    assert md._log_normal_cdf(np.array([0.0, -40.0])) == pytest.approx([math.log(0.5), -804.608442], abs=1e-5)


def test_binary_links(data):
    _, df = data
    flagged = df.withColumn("hi", (F.col("y") > 51).cast("int") * 3)
    a, b = md.binary_fit(flagged, "hi", ["b"]), md.binary_fit(flagged, "hi", ["b"], "probit")
    assert a.coefficients[0] < 0 and 1.4 < a.coefficients[0] / b.coefficients[0] < 2.0


def test_stratified_split_is_exact_and_repeatable(data):
    _, df = data
    one = md.stratified_split(df, "y", "key", 0.7, 5)
    two = md.stratified_split(df.repartition(3), "y", "key", 0.7, 5)
    a = {r["key"] for r in one.filter("train").collect()}
    assert a == {r["key"] for r in two.filter("train").collect()} and 280 <= len(a) <= 285
    big = df.sparkSession.range(20_000).select(F.col("id").alias("key"), (F.xxhash64("id") % 1000 / 7).alias("y"))
    splits = [{r["key"] for r in md.stratified_split(big.repartition(n), "y", "key").filter("train").collect()} for n in (2, 7)]
    assert splits[0] == splits[1] and 14_000 <= len(splits[0]) <= 14_005


def test_grid(data):
    _, df = data
    pairs, r2 = md.run_grid(df, df, [md.ModelSpec("m1", "y", ("a",)), md.ModelSpec("m2", "y", ("a", "b"))], ["key"])
    got = {r["model"]: r["r2"] for r in r2.collect()}
    assert pairs.count() == 800 and got["m2"] > got["m1"]
    specs = md.level_specs(["y"], ["clust", "TA"], {"m": ("a",)}, ("q",), "clust")
    assert [(s.name, s.xs) for s in specs] == [("y_clust_m", ("a", "q")), ("y_TA_m", ("TA_a", "q"))]
