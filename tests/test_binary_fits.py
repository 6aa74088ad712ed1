"""Logit and probit by sums of tasks, and the columns that their queries read."""

import math

import numpy as np
import pytest

from sparkpanel.plans import models as md
from sparkpanel.queries import fits


class Asked(Exception):
    pass


def stop(spark, sf, cols=()):
    raise Asked(set(cols))


@pytest.mark.parametrize("query", ["logit", "binary_score"])
def test_binary_queries_ask_the_panel_for_their_columns(spark, monkeypatch, query):
    monkeypatch.setattr(fits, "clusters", stop)
    with pytest.raises(Asked) as asked:
        getattr(fits, query)(spark, "")
    assert asked.value.args[0] == {*fits.MEASURES, *fits._SHORT}


@pytest.mark.parametrize("link", ["logit", "probit"])
def test_binary_fit_is_that_of_the_general_model(spark, link):
    rng = np.random.default_rng(5)
    x, w = rng.normal(40, 5, 1500), rng.integers(0, 4, 1500)
    flag = [None if i % 50 == 0 else int(v) * 2 for i, v in enumerate(0.1 * (x - 40) + 0.5 * w - 1 + rng.normal(0, 1, 1500) > 0)]
    df = spark.createDataFrame([(float(a), int(b), c) for a, b, c in zip(x, w, flag)], "x double, w int, y int").repartition(4)
    own, general = md.binary_fit(df, "y", ["x", "w"], link), md._glm_fit(df.dropna(), "y", ["x", "w"], link)
    s = general.summary
    assert [*own.coefficients, own.intercept] == pytest.approx([*general.coefficients, general.intercept], rel=1e-7)
    assert own.coefficientStandardErrors == pytest.approx(s.coefficientStandardErrors, rel=1e-6) and own.summary.tValues == pytest.approx(s.tValues, rel=1e-6)
    assert own.pValues == pytest.approx(s.pValues, rel=1e-5, abs=1e-14) and own.n == 1470
    assert (own.deviance, own.null_deviance, own.aic) == pytest.approx((s.deviance, s.nullDeviance, s.aic), rel=1e-7)
    p = own.transform(spark.createDataFrame([(41.0, 2), (None, 1)], "x double, w int")).collect()
    eta = own.intercept + 41 * own.coefficients[0] + 2 * own.coefficients[1]
    assert p[0]["prediction"] == pytest.approx(1 / (1 + math.exp(-eta)) if link == "logit" else 0.5 * math.erfc(-eta / math.sqrt(2))) and p[1]["prediction"] is None


def test_a_flag_that_never_changes_has_a_fit(spark):
    df = spark.createDataFrame([(float(i), 1) for i in range(20)], "x double, y int")
    assert list(md.binary_fit(df, "y", ["x"]).coefficients) == [0.0]
