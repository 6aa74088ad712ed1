"""Season statistics from days with rain alone against those of the whole calendar."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sparkpanel.operators.windows import dense_grid
from sparkpanel.plans import seasons as sea


@pytest.fixture(scope="module")
def obs(spark):
    rnd = random.Random(5)
    first, rows = dt.date(2001, 1, 9), []
    for entity, share in ((1, 0.6), (2, 0.05), (3, 0.3), (4, 0.9), (None, 0.2)):
        for i in range(900):
            if rnd.random() < share:
                rows.append((entity, first + dt.timedelta(i), rnd.choice([0.0, 0.5, 2.2, 2.3, 7.0, 9.0, None])))
    rows += [(5, dt.date(2002, 1, 1), 0.0), (6, dt.date(2003, 10, 20), 3.0)]
    return spark.createDataFrame(rows, "entity long, day date, rain double").cache()


def test_season_stats_from_wet_days(spark, obs, rows):
    cal = sea.seasons_spanning(obs, "day")
    dense = sea.season_stats(sea.season_grid(obs, ["entity"], "day", cal, "rain"), ["entity"], "day", "rain")
    sparse = sea.observed_season_stats(obs, ["entity"], "day", "rain", cal)
    rounded = [F.round("raincytot", 6), "entity", "cropyear", "day1rain", "maxdaysnorain", "rainmax"]
    assert rows(sparse, *rounded) == rows(dense, *rounded) and sparse.dtypes == dense.dtypes
    # Days without rain are no rows of a window.
    assert "Generate explode(sequence" not in sparse._jdf.queryExecution().optimizedPlan().toString()


def test_legacy_dry_spells_from_wet_days(spark, obs, rows):
    daily = dense_grid(obs, ["entity"], "day").join(obs, ["entity", "day"], "left").withColumn("rain", F.coalesce("rain", F.lit(0.0)))
    years = sea.crop_years(obs, "day")
    dense = sea.dry_spell_legacy(daily, ["entity"], "day", "rain", *years)
    sparse = sea.observed_dry_spell_legacy(obs, ["entity"], "day", "rain", *years)
    assert rows(sparse) == rows(dense) and sparse.dtypes == dense.dtypes and sparse.count() > 18


@pytest.mark.parametrize("k", [1, 3, 7])
def test_onset_looks_at_days_by_place(spark, obs, rows, k):
    """Of k days, more than half over the threshold; no frame slides over the rows."""
    cal = sea.seasons_spanning(obs, "day")
    dense = sea.season_stats(sea.season_grid(obs, ["entity"], "day", cal, "rain"), ["entity"], "day", "rain", k)
    sparse = sea.observed_season_stats(obs, ["entity"], "day", "rain", cal, k)
    assert rows(sparse, "entity", "cropyear", "day1rain") == rows(dense, "entity", "cropyear", "day1rain")
    assert "rangeframe" not in sparse._jdf.queryExecution().optimizedPlan().toString().lower()
