"""Gaps of series filled from a state-space model.

Local level: a value is a level plus noise, and the level moves by noise of its own from
one row to the next. Both variances are one scale, which drops out, times ``1 - signal``
and ``signal``, so a signal of 0 is a constant level and one of 1 a random walk seen
without error. The level's start is diffuse: the first known value sets it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places at which the likelihood is tried before the best one's surroundings are searched.
GRID = 33
#: Steps of the search; it ends on an angle known to 5e-8.
STEPS = 30
#: Cells of a matrix of series; a step of the filter takes few rows of it, so a larger one is no faster.
CELLS = 200_000
_TINY = 1e-300
_FIT = "signal double, filled array<double>"


def _filtered(y: np.ndarray, signal: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list, list]:
    """Deviance of each column's series, scale profiled out; with ``keep`` the levels and their variances as well.

    ``y`` is time by series and has NaN where a value is missing; first values are known.
    """
    noise = 1 - signal
    level, spread = y[0], noise.copy()
    squares, logs, seen = np.zeros(len(signal)), np.zeros(len(signal)), np.zeros(len(signal))
    levels, spreads = [level], [spread]
    for row in y[1:]:
        known = ~np.isnan(row)
        ahead = spread + signal
        total = ahead + noise
        gain = np.where(known, ahead / total, 0.0)
        error = np.where(known, row - level, 0.0)
        squares += error * error / total
        logs += np.where(known, np.log(total), 0.0)
        seen += known
        level = level + gain * error
        spread = np.where(known, gain * noise, ahead)
        if keep:
            levels.append(level)
            spreads.append(spread)
    return seen * np.log(np.maximum(squares, _TINY)) + logs, levels, spreads


def _smoothed(y: np.ndarray, signal: np.ndarray) -> np.ndarray:
    _, levels, spreads = _filtered(y, signal, keep=True)
    out = np.array(levels)
    for i in range(len(out) - 2, -1, -1):
        out[i] += spreads[i] / np.maximum(spreads[i] + signal, _TINY) * (out[i + 1] - levels[i])
    return out


def _likeliest(y: np.ndarray) -> np.ndarray:
    """Signal of least deviance of each series: the best of a grid of angles, then a golden section beside it."""
    n = y.shape[1]
    best, angle = np.full(n, np.inf), np.zeros(n)
    angles = np.linspace(0, math.pi / 2, GRID)
    for a in angles:
        deviance = _filtered(y, np.full(n, math.sin(a) ** 2))[0]
        better = deviance < best - 1e-12
        best, angle = np.where(better, deviance, best), np.where(better, a, angle)
    def at(a):
        return _filtered(y, np.sin(a) ** 2)[0]

    ratio = (math.sqrt(5) - 1) / 2
    low, high = np.maximum(angle - angles[1], 0), np.minimum(angle + angles[1], math.pi / 2)
    left, right = high - ratio * (high - low), low + ratio * (high - low)
    f_left, f_right = at(left), at(right)
    for _ in range(STEPS):
        down = f_left < f_right
        low, high = np.where(down, low, left), np.where(down, right, high)
        new = np.where(down, high - ratio * (high - low), low + ratio * (high - low))
        f_new = at(new)
        left, right = np.where(down, new, right), np.where(down, left, new)
        f_left, f_right = np.where(down, f_new, f_right), np.where(down, f_left, f_new)
    middle = (low + high) / 2
    return np.sin(np.where(at(middle) < best, middle, angle)) ** 2


def _fit_many(series: list[np.ndarray], signal: float | None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Signal and filled values of each series; series of like length share a matrix."""
    known = [np.flatnonzero(~np.isnan(y)) for y in series]
    signals, out = np.zeros(len(series)), [y.copy() for y in series]
    # From the first known value to the last; beyond them the level stays as it is there.
    core = [y[k[0] : k[-1] + 1] if len(k) else y[:0] for y, k in zip(series, known, strict=True)]
    order = [i for i in sorted(range(len(series)), key=lambda i: len(core[i])) if len(core[i])]
    while order:
        # The longest left decides how many go together.
        most = max(1, CELLS // len(core[order[-1]]))
        chosen, order = order[-most:], order[:-most]
        y = np.full((len(core[chosen[-1]]), len(chosen)), np.nan)
        for c, i in enumerate(chosen):
            y[: len(core[i]), c] = core[i]
        enough = np.array([len(known[i]) > 2 for i in chosen])
        s = np.zeros(len(chosen))
        if signal is not None:
            s[:] = signal
        elif enough.any():
            s[enough] = _likeliest(y[:, enough])
        level = _smoothed(y, s)
        signals[chosen] = s
        for c, i in enumerate(chosen):
            first, last = known[i][0], known[i][-1]
            fill = np.concatenate([np.full(first, level[0, c]), level[: last - first + 1, c], np.full(len(series[i]) - last - 1, level[last - first, c])])
            out[i] = np.where(np.isnan(series[i]), fill, series[i])
    return signals, out


def local_level_fit(df: DataFrame, by: list[str], t: str, v: str, signal: float | None = None) -> DataFrame:
    """A row for each series: by, n_known, signal, and steps, its (at, value, filled) in the order of ``t``.

    ``signal`` is the share of the level in both variances; where it isn't given, each
    series takes the one of greatest likelihood (0 with fewer than three known values,
    whose likelihood says nothing; else the least of equals). Equal known values are filled
    alike at any signal, which then has no meaning. Rows of a series count as equally far apart. NaN counts as missing. Many series go through the filter as one
    matrix; a task holds the series of an Arrow batch.
    """
    if signal is not None and not 0 <= signal <= 1:
        raise ValueError(f"signal {signal} lies outside 0 to 1")

    @F.pandas_udf(_FIT)
    def fit(values: pd.Series) -> pd.DataFrame:
        signals, filled = _fit_many([np.asarray(y, float) for y in values], signal)
        return pd.DataFrame({"signal": signals, "filled": filled})

    # Spark makes copies of a deterministic function, to filter on its result, each with workers of its own.
    fit = fit.asNondeterministic()
    value = F.col(v).cast("double")
    rows = df.select(*by, F.struct(F.col(t).alias("at"), F.when(~F.isnan(value), value).alias("value")).alias("_row"))
    series = rows.groupBy(*by).agg(F.sort_array(F.collect_list("_row")).alias("_rows"), F.count("_row.value").alias("n_known"))
    plain = F.transform("_rows", lambda r: F.coalesce(r["value"], F.lit(float("nan"))))
    fitted = series.withColumn("_fit", fit(plain))
    steps = F.zip_with("_rows", "_fit.filled", lambda r, x: F.struct(r["at"].alias("at"), r["value"].alias("value"), F.when(~F.isnan(x), x).alias("filled")))
    return fitted.select(*by, "n_known", F.when(F.col("n_known") > 0, F.col("_fit.signal")).alias("signal"), steps.alias("steps"))


def fill_local_level(df: DataFrame, by: list[str], t: str, v: str, name: str = "filled", signal: float | None = None) -> DataFrame:
    """Missing values from the smoothed local level of each series: by, t and ``name``.

    Known values stay. A series without any stays null. See ``local_level_fit``.
    """
    fitted = local_level_fit(df, by, t, v, signal).select(*by, F.explode("steps").alias("_s"))
    return fitted.select(*by, F.col("_s.at").alias(t), F.col("_s.filled").alias(name))


def level_deviance(values: Column, signal: Column) -> Column:
    """Deviance of an array of values (null = missing) at a signal, by SQL functions alone; null without a known value."""
    noise = 1 - signal
    start = F.struct(
        F.lit(None).cast("double").alias("level"), F.lit(0.0).alias("spread"), F.lit(0.0).alias("squares"), F.lit(0.0).alias("logs"), F.lit(0).alias("seen"),
    )

    def step(s: Column, y: Column) -> Column:
        first, ahead = s["level"].isNull(), s["spread"] + signal
        total, error = ahead + noise, y - s["level"]
        moved = F.when(y.isNull(), s["level"]).when(first, y).otherwise(s["level"] + ahead / total * error)
        spread = F.when(y.isNull(), F.when(first, F.lit(0.0)).otherwise(ahead)).when(first, noise).otherwise(ahead / total * noise)
        later = y.isNotNull() & ~first
        return F.struct(
            moved.alias("level"), spread.alias("spread"), (s["squares"] + F.when(later, error * error / total).otherwise(0.0)).alias("squares"),
            (s["logs"] + F.when(later, F.log(total)).otherwise(0.0)).alias("logs"), (s["seen"] + F.when(later, 1).otherwise(0)).alias("seen"),
        )

    def done(s: Column) -> Column:
        return F.when(s["level"].isNotNull(), s["seen"] * F.log(F.greatest(s["squares"], F.lit(_TINY))) + s["logs"])

    return F.aggregate(values, start, step, done)
