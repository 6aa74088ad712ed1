"""A regressor that is the same everywhere, as the prior phase is in large tables."""

import numpy as np
import pandas as pd
import pytest

from sparkpanel.plans import models as md
from sparkpanel.queries import fits


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(3)
    n = 600
    pdf = pd.DataFrame({c: rng.normal(2, 1, n) for c in fits._OPEN})
    pdf["ea_id"], pdf["FS_year"], pdf["IPC1"] = range(n), 1995, 2.1
    pdf["logFCS"] = 4 + 0.3 * pdf.hhsize + rng.normal(0, 1, n)
    pdf["HDDS"] = 4 + 0.5 * pdf.hh_age + rng.normal(0, 2, n)
    pdf["rCSI"] = 5 + 2 * pdf.elevation + rng.normal(0, 4, n)
    return spark.createDataFrame(pdf).cache()


def test_net_leaves_a_constant_out(panel):
    fit = md.elastic_net_cv(panel, "HDDS", ["hh_age", "IPC1"], "ea_id", alphas=[0.0], lambdas=[1e-3, 1e-2])
    alone = md.elastic_net_cv(panel, "HDDS", ["hh_age"], "ea_id", alphas=[0.0], lambdas=[1e-3, 1e-2])
    assert fit.dropped == ["IPC1"] and fit.coef["IPC1"] == 0
    assert fit.coef["hh_age"] == pytest.approx(alone.coef["hh_age"]) and fit.cv_rmse == pytest.approx(alone.cv_rmse)


def test_enet_conditions_hold(spark, panel, monkeypatch):
    monkeypatch.setattr(fits, "staged", lambda *_: panel)
    found = fits.enet_conditions(spark, "").collect()
    assert len(found) == 3 * len(fits._OPEN) and all(r["excess"] == 0 and r["n"] == 600 for r in found)


def test_logit_gives_errors_of_what_varies(spark, panel, monkeypatch):
    monkeypatch.setattr(fits, "staged", lambda *_: panel)
    found = fits.logit(spark, "").collect()
    assert {r["term"] for r in found} == {*fits._SHORT, "intercept"} - {"IPC1"} and len(found) == 3 * 2 * 5
    assert all(r["se"] > 0 for r in found)


def test_binary_score_has_every_term(spark, panel, monkeypatch):
    monkeypatch.setattr(fits, "staged", lambda *_: panel)
    found = fits.binary_score(spark, "").collect()
    assert len(found) == 3 * 2 * 6 and all(r["score"] == 0 and r["n"] == 600 for r in found)
