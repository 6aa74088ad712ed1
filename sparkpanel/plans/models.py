"""Regression on panels: one distributed cross-product pass, small solves on the driver.

Every task reduces its rows to one cross-product matrix per model; Spark sums the
cells. What reaches the driver is p x p per model, independent of the row count.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkpanel.operators.aggregates import attach
from sparkpanel.operators.graph import connected_parts
from sparkpanel.operators.reshape import levels
from sparkpanel.operators.skew import group_quantiles, ordinal
from sparkpanel.plans.evaluate import CUTS, HIGH_IS_SECURE
from sparkpanel.session import cut_lineage

# A regressor is aliased when what earlier ones leave of it is below this part of its norm.
ALIAS_TOL = 1e-7

_CELL_SCHEMA = T.StructType([
    T.StructField("spec", T.IntegerType()), T.StructField("fold", T.IntegerType()),
    T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("v", T.DoubleType()),
])


@dataclass(frozen=True)
class ModelSpec:
    name: str
    y: str
    xs: tuple[str, ...]


@dataclass
class Gram:
    """Cross-products of (1, xs, y) shifted by ``shift``."""

    matrix: np.ndarray
    shift: np.ndarray


@dataclass
class OlsFit:
    spec: ModelSpec
    coef: dict[str, float]
    se: dict[str, float]
    n: int
    r2: float
    adj_r2: float
    sse: float
    sst: float
    dropped: list[str] = field(default_factory=list)
    absorbed: int = 0
    overall_r2: float | None = None

    @property
    def df_resid(self) -> int:
        return self.n - len(self.coef) - self.absorbed

    def rows(self) -> list[tuple]:
        out = []
        for term, b in self.coef.items():
            se = self.se[term]
            t = b / se if se > 0 else float("nan")
            p = t_two_sided(t, self.df_resid)
            stars = "***" if p < 0.01 else "**" if p < 0.05 else "*" if p < 0.10 else ""
            out.append((self.spec.name, self.spec.y, term, b, se, t, p, stars, self.n, self.r2))
        return out

    def predictor(self) -> Column:
        """Fitted value as a column, null when a regressor is null."""
        terms = [F.lit(b) * (F.col(t).cast("double") if t != "intercept" else F.lit(1.0)) for t, b in self.coef.items()]
        # Aliased regressors have no weight but still null the prediction.
        terms += [F.lit(0.0) * F.col(t).cast("double") for t in self.dropped]
        return sum(terms[1:], terms[0])


def _beta_cf(a: float, b: float, x: float) -> float:
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            c = 1 + num / c
            d = 1 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return h


def t_two_sided(t: float, dof: int) -> float:
    """Two-sided p-value of Student's t by the incomplete beta function."""
    if dof <= 0 or math.isnan(t):
        return float("nan")
    a, b, x = dof / 2, 0.5, dof / (dof + t * t)
    if x >= 1:
        return 1.0
    if x <= 0:
        return 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_cf(a, b, x) / a
    return 1 - front * _beta_cf(b, a, 1 - x) / b


def _sum_cells(df: DataFrame, task) -> list:
    return df.mapInPandas(task, _CELL_SCHEMA).groupBy("spec", "fold", "i", "j").agg(F.sum("v").alias("v")).collect()


def grams(df: DataFrame, specs: Sequence[ModelSpec], fold: str | None = None, folds: int = 1) -> dict[tuple[int, int], Gram]:
    """Cross-product matrix per (spec, fold), each over that spec's complete rows.

    Columns are shifted by their means first, so the cells keep their precision.
    """
    cols = sorted({c for s in specs for c in (*s.xs, s.y)})
    num = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols], *([F.col(fold).cast("int").alias("_fold")] if fold else []))
    means = num.agg(*[F.avg(c).alias(c) for c in cols]).first()
    centre = {c: (means[c] if means[c] is not None else 0.0) for c in cols}
    place = {c: i for i, c in enumerate(cols)}
    picks = [[place[c] for c in (*s.xs, s.y)] for s in specs]
    cells = [np.array([0, *(1 + i for i in pick)]) for pick in picks]
    shift = np.array([centre[c] for c in cols])

    def task(batches: Iterable[pd.DataFrame]):
        acc: dict[tuple[int, int], np.ndarray] = {}
        for pdf in batches:
            data = pdf[cols].to_numpy(dtype=float) - shift
            which = pdf["_fold"].to_numpy() if fold else np.zeros(len(pdf), dtype=int)
            known = ~np.isnan(data)
            complete = np.column_stack([known[:, pick].all(axis=1) for pick in picks])
            kinds, kind = np.unique(np.column_stack([which, np.packbits(complete, axis=1)]), axis=0, return_inverse=True)
            shared = len(kinds) < len(picks)
            z = np.column_stack([np.ones(len(data)), np.where(known, data, 0.0)]) if shared else None
            for k, f in enumerate(kinds[:, 0] if shared else ()):
                # Rows that are complete for the same specs go into one product, of which each spec has its part.
                rows = np.flatnonzero(kind.ravel() == k)
                own = np.flatnonzero(complete[rows[0]])
                if len(own):
                    part = z[rows]
                    whole = part.T @ part
                    for s in own:
                        key = (int(s), int(f))
                        acc[key] = acc.get(key, 0.0) + whole[np.ix_(cells[s], cells[s])]
            for s, pick in enumerate(() if shared else picks):
                for f in np.unique(which[complete[:, s]]):
                    rows = data[complete[:, s] & (which == f)][:, pick]
                    z = np.column_stack([np.ones(len(rows)), rows])
                    key = (s, int(f))
                    acc[key] = acc.get(key, 0.0) + z.T @ z
        for (s, f), m in acc.items():
            i, j = np.triu_indices(len(m))
            yield pd.DataFrame({"spec": s, "fold": f, "i": i, "j": j, "v": m[i, j]}).astype(
                {"spec": "int32", "fold": "int32", "i": "int32", "j": "int32"}
            )

    out = {
        (s, f): Gram(np.zeros((len(p) + 1,) * 2), shift[p]) for s, p in enumerate(picks) for f in range(folds)
    }
    for r in _sum_cells(num, task):
        m = out[(r["spec"], r["fold"])].matrix
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["v"]
    return out


def _independent(g: np.ndarray) -> list[int]:
    """Columns kept when aliased ones are dropped in declared order."""
    kept: list[int] = []
    for j in range(len(g)):
        left = g[j, j]
        if kept:
            sol = np.linalg.lstsq(g[np.ix_(kept, kept)], g[kept, j], rcond=None)[0]
            left = g[j, j] - g[j, kept] @ sol
        if left > ALIAS_TOL * max(g[j, j], 1e-300) and g[j, j] > 0:
            kept.append(j)
    return kept


def solve_ols(gram: Gram, spec: ModelSpec) -> OlsFit:
    m, p = gram.matrix, len(spec.xs)
    n = int(round(m[0, 0]))
    if n == 0:
        nan = float("nan")
        return OlsFit(spec, {"intercept": nan}, {"intercept": nan}, 0, nan, nan, nan, nan, list(spec.xs))
    mean = m[0, 1:] / n
    centred = m[1:, 1:] - n * np.outer(mean, mean)
    # A regressor constant over the rows is aliased with the intercept; what rounding
    # leaves of it is judged against its size before centring.
    raw = np.diag(m)[1:p + 1] + n * gram.shift[:p] ** 2
    sxx, sxy, sst = centred[:p, :p], centred[:p, p], max(centred[p, p], 0.0)
    alive = [j for j in range(p) if sxx[j, j] > 1e-12 * max(raw[j], 1e-300)]
    kept = [alive[j] for j in _independent(sxx[np.ix_(alive, alive)])]
    inv = np.linalg.inv(sxx[np.ix_(kept, kept)]) if kept else np.zeros((0, 0))
    b = inv @ sxy[kept]
    sse = max(sst - b @ sxy[kept], 0.0) if kept else sst
    dof = n - len(kept) - 1
    sigma2 = sse / dof if dof > 0 else float("nan")
    centre = gram.shift[:p][kept] + mean[:p][kept]
    intercept = gram.shift[p] + mean[p] - b @ centre
    names = [spec.xs[j] for j in kept]
    se = np.sqrt(sigma2 * np.diag(inv)) if kept else np.array([])
    se0 = math.sqrt(float(sigma2 * (1 / n + centre @ inv @ centre))) if dof > 0 else float("nan")
    sse, sst = float(sse), float(sst)
    r2 = 1 - sse / sst if sst > 0 else float("nan")
    adj = 1 - (1 - r2) * (n - 1) / dof if dof > 0 else float("nan")
    return OlsFit(
        spec, {"intercept": float(intercept), **{t: float(v) for t, v in zip(names, b)}},
        {"intercept": se0, **{t: float(v) for t, v in zip(names, se)}},
        n, r2, adj, sse, sst, [x for j, x in enumerate(spec.xs) if j not in kept],
    )


def fit_all(df: DataFrame, specs: Sequence[ModelSpec]) -> list[OlsFit]:
    """Least squares for every spec from one pass over the data."""
    g = grams(df, specs)
    return [solve_ols(g[(i, 0)], s) for i, s in enumerate(specs)]


def ols_fit(df: DataFrame, y: str, xs: Sequence[str], name: str = "ols") -> OlsFit:
    return fit_all(df, [ModelSpec(name, y, tuple(xs))])[0]


def coef_table(spark: SparkSession, fits: Sequence[OlsFit]) -> DataFrame:
    """Estimates, errors, t, p, stars, N and R2 as rows."""
    schema = "model string, y string, term string, estimate double, se double, t double, p double, stars string, n int, r2 double"
    return spark.createDataFrame([r for f in fits for r in f.rows()], schema)


def fit_stats(spark: SparkSession, fits: Sequence[OlsFit]) -> DataFrame:
    """N, R2, adjusted R2, Gaussian log-likelihoods and the pseudo R2 per model."""
    rows = []
    for f in fits:
        def lnl(ss: float) -> float:
            return -f.n / 2 * (math.log(2 * math.pi) + math.log(ss / f.n) + 1) if f.n and ss > 0 else float("nan")
        full, null = lnl(f.sse), lnl(f.sst)
        rows.append((f.spec.name, f.spec.y, f.n, f.r2, f.adj_r2, full, null, 1 - full / null if null else float("nan")))
    return spark.createDataFrame(
        rows, "model string, y string, n int, r2 double, adj_r2 double, lnl double, lnl0 double, pseudo_r2 double"
    )


def predict(df: DataFrame, fits: Sequence[OlsFit], keys: list[str]) -> DataFrame:
    """Long (keys, model, y, actual, predict) for all fits, one scan."""
    cells = [
        F.struct(F.lit(f.spec.name).alias("model"), F.lit(f.spec.y).alias("y"),
                 F.col(f.spec.y).cast("double").alias("actual"), f.predictor().alias("predict"))
        for f in fits
    ]
    return df.select(*keys, F.explode(F.array(*cells)).alias("_c")).select(*keys, "_c.*")


def run_grid(train: DataFrame, test: DataFrame, specs: Sequence[ModelSpec], keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Pairs of all specs on the test rows, and their squared correlations."""
    pairs = predict(test, fit_all(train, specs), keys)
    both = pairs.filter(F.col("actual").isNotNull() & F.col("predict").isNotNull())
    r2 = both.groupBy("model", "y").agg(
        F.round(F.pow(F.corr("predict", "actual"), F.lit(2.0)), 3).alias("r2"), F.count(F.lit(1)).alias("n")
    )
    return pairs, r2


def level_specs(
    measures: Sequence[str], levels: Sequence[str], groups: dict[str, Sequence[str]], always: Sequence[str], plain_level: str
) -> list[ModelSpec]:
    """One spec per measure, level and model; ``groups`` gives the level variables of a model.

    Level variables carry the level prefix except at ``plain_level``; ``always``
    (quarters and the prior phase) never do.
    """
    return [
        ModelSpec(f"{y}_{lv}_{m}", y, (*(v if lv == plain_level else f"{lv}_{v}" for v in vs), *always))
        for y in measures for lv in levels for m, vs in groups.items()
    ]


def _merged(parts: DataFrame) -> DataFrame:
    """Scores of each fit from the sums of the tasks; the moments of a task are about its own means."""
    total = parts.groupBy("fit").agg(F.sum("n").alias("_n"), *[(F.sum(F.col("n") * F.col(m)) / F.nullif(F.sum("n"), F.lit(0.0))).alias(f"_{m}") for m in ("mx", "my")])
    dx, dy = F.col("mx") - F.col("_mx"), F.col("my") - F.col("_my")
    flat = lambda v: F.min(f"lo{v}") == F.max(f"hi{v}")
    sums = parts.join(total, "fit").groupBy("fit").agg(
        F.max("_n").alias("n"), F.sum(F.col("sxy") + F.coalesce(F.col("n") * dx * dy, F.lit(0.0))).alias("sxy"),
        *[F.when(flat(v), F.lit(0.0)).otherwise(F.sum(F.col(f"s{v}{v}") + F.coalesce(F.col("n") * d * d, F.lit(0.0)))).alias(f"s{v}{v}") for v, d in (("x", dx), ("y", dy))],
        *[F.sum(c).alias(c) for c in ("pairs", "right", "base", "hits")],
    )
    r = F.when(F.col("n") > 1, F.col("sxy") / F.sqrt(F.col("sxx") * F.col("syy")))
    return sums.select(
        "fit", F.pow(r, F.lit(2.0)).alias("r2"), (F.col("right") / F.nullif(F.col("pairs"), F.lit(0.0))).alias("accuracy"),
        (F.col("hits") / F.nullif(F.col("base"), F.lit(0.0))).alias("recall"), F.col("pairs").cast("long").alias("pairs"),
    )


def _ranks(x: np.ndarray, measure: str) -> np.ndarray:
    """Class numbers as ``class_rank`` gives them, 0 outside the bins."""
    low, bins = CUTS[measure]
    rank = np.searchsorted([high for _, high in bins[:-1]], x) + 1
    return np.where(np.isnan(x) | (x <= low if low > -math.inf else False), 0, rank)


def score_fits(df: DataFrame, fits: Sequence[OlsFit]) -> DataFrame:
    """r2, accuracy, recall and pairs of each fit on these rows, as ``predict`` and ``score_measures`` have them.

    A task predicts a batch by all fits at once and sums up what the scores need, so that no
    row is made for a fit. A fit's ``y`` is its measure.
    """
    xs = list(dict.fromkeys(t for f in fits for t in (*f.coef, *f.dropped) if t != "intercept"))
    beta = np.array([[f.coef.get(x, 0.0) for f in fits] for x in xs]).reshape(len(xs), len(fits))
    start = np.array([f.coef["intercept"] for f in fits])
    needs = np.array([[x in f.coef or x in f.dropped for f in fits] for x in xs], dtype=bool).reshape(len(xs), len(fits))
    ys = list(dict.fromkeys(f.spec.y for f in fits))
    of = {y: np.array([k for k, f in enumerate(fits) if f.spec.y == y]) for y in ys}
    secure_up = dict(HIGH_IS_SECURE)
    names = ["n", "mx", "my", "sxx", "syy", "sxy", "lox", "hix", "loy", "hiy", "pairs", "right", "base", "hits"]

    def batch_sums(values: np.ndarray, null: np.ndarray, y: str, pred: np.ndarray, absent: np.ndarray) -> np.ndarray:
        both = ~absent & ~null[:, None]
        n, a = both.sum(axis=0).astype(float), np.broadcast_to(values[:, None], both.shape)
        some = np.maximum(n, 1.0)
        mx, my = np.where(both, pred, 0.0).sum(axis=0) / some, np.where(both, a, 0.0).sum(axis=0) / some
        dx, dy = np.where(both, pred - mx, 0.0), np.where(both, a - my, 0.0)
        ends = [e(np.where(both, v, far), axis=0) for v in (pred, a) for e, far in ((np.min, math.inf), (np.max, -math.inf))]
        p, q = np.where(absent, 0, _ranks(pred, y)), np.where(null, 0, _ranks(values, y))[:, None]
        known = (p > 0) & (q > 0)
        base = known & (q == 2) & ((p == 2) | (p == (3 if secure_up[y] else 1)))
        return np.array([n, mx, my, (dx * dx).sum(axis=0), (dy * dy).sum(axis=0), (dx * dy).sum(axis=0), *ends,
                         known.sum(axis=0), (known & (p == q)).sum(axis=0), base.sum(axis=0), (base & (p == 2)).sum(axis=0)])

    def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, n = a + b, np.maximum(a[0] + b[0], 1.0)
        d = np.where((a[0] > 0) & (b[0] > 0), b[1:3] - a[1:3], 0.0)
        out[1:3] = (a[0] * a[1:3] + b[0] * b[1:3]) / n
        out[3:6] += np.array([d[0] * d[0], d[1] * d[1], d[0] * d[1]]) * a[0] * b[0] / n
        out[[6, 8]], out[[7, 9]] = np.minimum(a, b)[[6, 8]], np.maximum(a, b)[[7, 9]]
        return out

    def task(batches):
        acc: dict[str, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            # Arrow tells null, which has no prediction, from NaN, which has one.
            null = np.array([c.is_null().to_numpy(zero_copy_only=False) for c in batch.columns])
            data = np.array([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
            x = data[: len(xs)].T
            with np.errstate(all="ignore"):
                if np.isfinite(x).all():
                    pred = x @ beta + start
                else:
                    pred = np.column_stack([x[:, needs[:, k]] @ beta[needs[:, k], k] + start[k] for k in range(len(fits))])
                gaps = null[: len(xs)]
                absent = gaps.T.astype(np.float32) @ needs.astype(np.float32) > 0 if gaps.any() else np.zeros(pred.shape, dtype=bool)
                for j, y in enumerate(ys, len(xs)):
                    new = batch_sums(data[j], null[j], y, pred[:, of[y]], absent[:, of[y]])
                    acc[y] = add(acc[y], new) if y in acc else new
        for y, sums in acc.items():
            yield pa.RecordBatch.from_arrays([pa.array(of[y].astype("int32")), *[pa.array(v.astype(float)) for v in sums]], ["fit", *names])

    cols = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate([*xs, *ys])])
    # A row for each task and fit, read twice.
    scores = _merged(cut_lineage(cols.mapInArrow(task, "fit int, " + ", ".join(f"{n} double" for n in names))))
    named = df.sparkSession.createDataFrame([(k, f.spec.name, f.spec.y) for k, f in enumerate(fits)], "fit int, model string, y string")
    return scores.join(F.broadcast(named), "fit").select("model", "y", "r2", "accuracy", "recall", "pairs")


def sweep(splits: dict[str, tuple[DataFrame, DataFrame]], sets: dict[str, Sequence[str]], measures: Sequence[str], keys: list[str]) -> DataFrame:
    """R2, accuracy and recall per split, variable set and measure."""
    parts = []
    for split, (train, test) in splits.items():
        specs = [ModelSpec(n, y, tuple(xs)) for y in measures for n, xs in sets.items()]
        parts.append(score_fits(test, fit_all(train, specs)).withColumn("split", F.lit(split)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("split", "model", "y", "r2", "accuracy", "recall", "pairs")


def fe_ols(df: DataFrame, y: str, xs: Sequence[str], factors: Sequence[str], name: str = "fe") -> OlsFit:
    """Least squares with factor dummies, the lowest level of each factor as base.

    The dummies are columns of their own and named ``factor_level`` in the fit only, so
    that columns which the frame has already play no part.
    """
    terms: dict[str, str] = {}
    for i, f in enumerate(factors):
        for j, level in enumerate(levels(df, f)[1:]):
            terms[f"_fe{i}_{j}"] = f"{f}_{level}"
            df = df.withColumn(f"_fe{i}_{j}", F.when(F.col(f).isNotNull(), (F.col(f) == level).cast("int")))
    fit = ols_fit(df, y, [*xs, *terms], name)
    named = lambda d: {terms.get(t, t): v for t, v in d.items()}
    return replace(fit, coef=named(fit.coef), se=named(fit.se), dropped=[terms.get(t, t) for t in fit.dropped])


def within_ols(df: DataFrame, y: str, xs: Sequence[str], factor: str, name: str = "within") -> OlsFit:
    """Slopes with one factor of many levels swept out by group means.

    Errors, t and p count the swept means as parameters. ``r2`` is that within the groups,
    ``overall_r2`` that of the fit with a mean for each group.
    """
    cols = [y, *xs]
    complete = df.select(factor, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=[factor, *cols])
    means = complete.groupBy(factor).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
    inner = attach(complete, means, [factor]).select(*[(F.col(c) - F.col(f"_m_{c}")).alias(c) for c in cols])
    fit = ols_fit(inner, y, xs, name)
    total = complete.agg(F.count_distinct(factor).alias("groups"), (F.var_pop(y) * F.count(y)).alias("sst")).first()
    coef = {t: b for t, b in fit.coef.items() if t != "intercept"}
    dof = fit.n - total["groups"] - len(coef)
    scale = math.sqrt((fit.n - len(coef) - 1) / dof) if dof > 0 else float("nan")
    overall = 1 - fit.sse / total["sst"] if total["sst"] else float("nan")
    return replace(
        fit, coef=coef, se={t: fit.se[t] * scale for t in coef}, absorbed=total["groups"], overall_r2=overall,
        adj_r2=1 - (1 - overall) * (fit.n - 1) / dof if dof > 0 else float("nan"),
    )


def _level_effects(cells: DataFrame, factors: Sequence[str], cols: Sequence[str], tol: float, most: int) -> list[DataFrame]:
    """For each factor the level effects that, taken off together, leave every column with mean 0 in every level.

    A sweep gives one factor after the other the means of what the others leave, from the
    cells alone; it ends where no effect moved by more than ``tol`` deviations of its column.
    """
    spread = cells.agg(F.sum("_n").alias("n"), *[a for c in cols for a in (F.sum(f"_s_{c}").alias(f"s_{c}"), F.sum(f"_q_{c}").alias(f"q_{c}"))]).first()
    scale = {c: math.sqrt(max(spread[f"q_{c}"] / spread["n"] - (spread[f"s_{c}"] / spread["n"]) ** 2, 0.0)) or 1.0 for c in cols}
    effects: list[DataFrame | None] = [None] * len(factors)
    for _ in range(most):
        moved = 0.0
        for k, f in enumerate(factors):
            left = cells
            for j, g in enumerate(factors):
                if j != k and effects[j] is not None:
                    left = left.join(effects[j].withColumnsRenamed({f"_e_{c}": f"_o{j}_{c}" for c in cols}), g)
            others = [j for j in range(len(factors)) if j != k and effects[j] is not None]
            rest = {c: F.col(f"_s_{c}") - F.col("_n") * sum((F.col(f"_o{j}_{c}") for j in others), F.lit(0.0)) for c in cols}
            new = cut_lineage(left.groupBy(f).agg(*[(F.sum(rest[c]) / F.sum("_n")).alias(f"_e_{c}") for c in cols]))
            if effects[k] is None:
                moved = math.inf
            else:
                old = effects[k].withColumnsRenamed({f"_e_{c}": f"_was_{c}" for c in cols})
                step = new.join(old, f).agg(*[F.max(F.abs(F.col(f"_e_{c}") - F.col(f"_was_{c}"))).alias(c) for c in cols]).first()
                moved = max(moved, *[(step[c] or 0.0) / scale[c] for c in cols])
            effects[k] = new
        if moved < tol:
            return effects
    raise ArithmeticError(f"the effects of {list(factors)} still moved by {moved:.1e} deviations after {most} sweeps")


def _absorbed_rank(cells: DataFrame, factors: Sequence[str]) -> int:
    """Parameters that the levels of the factors take, the intercept among them.

    Two factors lose one level for each connected part of the graph that links the levels
    which occur together. A further factor loses the parts that it forms with the first,
    which is exact unless its levels also follow from several others together.
    """
    counts = cells.agg(*[F.count_distinct(f).alias(f"_l{i}") for i, f in enumerate(factors)]).first()
    rank = counts["_l0"]
    for i, f in enumerate(factors[1:], 1):
        named = lambda j, c: F.concat(F.lit(f"{j}:"), F.col(c).cast("string"))
        links = cells.select(named(0, factors[0]).alias("a"), named(i, f).alias("b")).distinct()
        rank += counts[f"_l{i}"] - connected_parts(links, "a", "b").agg(F.count_distinct("part")).first()[0]
    return rank


def absorbed_ols(
    df: DataFrame, y: str, xs: Sequence[str], factors: Sequence[str], name: str = "absorbed", tol: float = 1e-9, sweeps: int = 500,
) -> OlsFit:
    """Slopes beside several factors of any number of levels, without a column for a level.

    Rows are summed up once into the cells of the factors. Alternating sweeps over the cells
    find the effects of all levels, which are then taken off the rows; the slopes come from
    what is left. Errors, t and p count the rank of the levels, from the connected parts of
    the graph of levels. Equal to least squares with a dummy for each level. ``r2`` is that
    of the rest, ``overall_r2`` that of the fit with the levels. Rows with a null or NaN in
    the outcome, a regressor or a factor are left out.
    """
    if len(factors) == 1:
        return within_ols(df, y, xs, factors[0], name)
    cols = [y, *xs]
    clean = df.select(*factors, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols]).dropna()
    # Far from zero, sums of squares lose what a deviation is measured by.
    centre = clean.agg(*[F.avg(c).alias(c) for c in cols]).first()
    if centre[y] is None:
        return within_ols(df, y, xs, factors[0], name)
    rows = cut_lineage(clean.withColumns({c: F.col(c) - F.lit(centre[c]) for c in cols}))
    cells = cut_lineage(rows.groupBy(*factors).agg(
        F.count(F.lit(1)).alias("_n"), *[a for c in cols for a in (F.sum(c).alias(f"_s_{c}"), F.sum(F.col(c) * F.col(c)).alias(f"_q_{c}"))]
    ))
    left = rows
    for j, (f, effect) in enumerate(zip(factors, _level_effects(cells, factors, cols, tol, sweeps), strict=True)):
        left = left.join(effect.withColumnsRenamed({f"_e_{c}": f"_o{j}_{c}" for c in cols}), f)
    inner = left.select(*[(F.col(c) - sum(F.col(f"_o{j}_{c}") for j in range(len(factors)))).alias(c) for c in cols])
    # What sweeps leave of a regressor that the factors determine is rounding, not variation.
    sums = inner.agg(*[F.sum(F.col(c) * F.col(c)).alias(c) for c in cols]).first()
    whole = cells.agg(*[F.sum(f"_q_{c}").alias(c) for c in cols]).first()
    alive = [x for x in xs if sums[x] > 1e-12 * max(whole[x], 1e-300)]
    fit = ols_fit(inner, y, alive, name)
    rank = _absorbed_rank(cells, factors)
    coef = {t: b for t, b in fit.coef.items() if t != "intercept"}
    dof = fit.n - rank - len(coef)
    scale = math.sqrt((fit.n - len(coef) - 1) / dof) if dof > 0 else float("nan")
    overall = 1 - fit.sse / whole[y] if whole[y] else float("nan")
    return replace(
        fit, spec=ModelSpec(name, y, tuple(xs)), coef=coef, se={t: fit.se[t] * scale for t in coef}, absorbed=rank, overall_r2=overall,
        adj_r2=1 - (1 - overall) * (fit.n - 1) / dof if dof > 0 else float("nan"), dropped=[x for x in xs if x not in coef],
    )


def group_r2(df: DataFrame, ys: Sequence[str], factors: dict[str, list[str]]) -> DataFrame:
    """R2 of each measure on the means of each factor, as 1 - within / total.

    One aggregate gives count, mean and variance of all measures in the cells of every
    factor; a second adds the cells up.
    """
    keys = list(dict.fromkeys(c for cols in factors.values() for c in cols))
    names = list(factors)
    # Cells of each factor, known rows only; a spare copy of each key tells null from left out.
    rows = df.select(*keys, *[F.col(y).cast("double").alias(y) for y in ys])
    stacked = rows.withColumn("_f", F.explode(F.lit(list(range(len(names)))).cast("array<int>")))
    complete = F.lit(False)
    for i, n in enumerate(names):
        complete = complete | ((F.col("_f") == i) & F.expr(" and ".join(f"`{c}` is not null" for c in factors[n])))
    part = {c: F.when(F.col("_f").isin([i for i, n in enumerate(names) if c in factors[n]]), F.col(c)) for c in keys}
    cells = stacked.filter(complete).select("_f", *[e.alias(c) for c, e in part.items()], *ys).groupBy("_f", *keys).agg(*[
        a for y in ys for a in (F.count(y).alias(f"_n_{y}"), F.var_pop(y).alias(f"_v_{y}"), F.avg(y).alias(f"_m_{y}"))
    ])
    found = []
    for y in ys:
        n, v, m = (F.col(f"_{k}_{y}") for k in "nvm")
        total = F.sum(n * (v + m * m)) - F.pow(F.sum(n * m), F.lit(2.0)) / F.sum(n)
        found.append((1 - F.sum(n * v) / F.nullif(total, F.lit(0.0))).alias(y))
    wide = cells.groupBy("_f").agg(*found)
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_f") + 1)
    return wide.select(label.alias("factor"), *ys).unpivot(["factor"], list(ys), "measure", "r2").select("measure", "factor", "r2")


def stratified_split(df: DataFrame, y: str, key: str, p: float = 0.7, seed: int = 1, strata: int = 5) -> DataFrame:
    """Adds ``train``: the fraction p of each outcome stratum, chosen by a seeded hash of the key.

    Strata are cut at exact quantiles, and the hash is the MD5 of seed and key, so the
    choice depends on the rows alone.
    """
    probs = {f"_c{i}": i / strata for i in range(1, strata)}
    cuts = group_quantiles(df.select(F.lit(0).alias("_all"), y), ["_all"], y, probs).first()
    edges = [cuts[c] for c in probs if cuts is not None and cuts[c] is not None]
    stratum = sum(((F.col(y) > e).cast("int") for e in edges), F.lit(0))
    tagged = df.withColumn("_stratum", stratum).withColumn("_h", F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string"))))
    numbered = ordinal(tagged, ["_stratum"], ["_h", key], "_rn")
    sizes = tagged.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_n"))
    return attach(numbered, sizes, ["_stratum"]).withColumn(
        "train", F.col("_rn") <= F.ceil(F.col("_n") * p)
    ).drop("_stratum", "_h", "_rn", "_n")


@dataclass
class NetFit:
    spec: ModelSpec
    coef: dict[str, float]
    alpha: float
    lam: float
    cv_rmse: float
    path: list[tuple[float, float, float]]
    dropped: list[str] = field(default_factory=list)

    def predictor(self) -> Column:
        terms = [F.lit(b) * (F.col(t).cast("double") if t != "intercept" else F.lit(1.0)) for t, b in self.coef.items()]
        return sum(terms[1:], terms[0])


def _net_path(sxx, sxy, alphas, lambdas, sweeps: int = 1000, tol: float = 1e-8):
    """Coordinate descent for a stack of problems, warm-started down the penalties.

    sxx: (q, p, p) with unit diagonals, sxy: (q, p). Yields coefficients per penalty.
    """
    q, p = sxy.shape
    b = np.zeros((q, p))
    for lam in lambdas:
        l1, l2 = lam * alphas, lam * (1 - alphas)
        for _ in range(sweeps):
            move = 0.0
            for j in range(p):
                rho = sxy[:, j] - np.einsum("qk,qk->q", sxx[:, j, :], b) + sxx[:, j, j] * b[:, j]
                new = np.sign(rho) * np.maximum(np.abs(rho) - l1, 0) / np.maximum(sxx[:, j, j] + l2, 1e-12)
                move = max(move, float(np.max(np.abs(new - b[:, j]))))
                b[:, j] = new
            if move < tol:
                break
        yield lam, b.copy()


def _standard(m: np.ndarray, shift: np.ndarray):
    """Means, deviations and standardised cross-products of a (1, xs, y) matrix, and which regressors vary.

    One that doesn't has no products, so that it stays out at every penalty; what rounding
    leaves of it is judged against its size before centring.
    """
    n = max(m[0, 0], 1.0)
    mean = m[0, 1:] / n
    cov = m[1:, 1:] / n - np.outer(mean, mean)
    raw = np.diag(m)[1:] / n + shift**2
    varies = np.diag(cov)[:-1] > 1e-12 * np.maximum(raw[:-1], 1e-300)
    sd = np.sqrt(np.where(varies, np.diag(cov)[:-1], 1.0))
    return mean, sd, cov[:-1, :-1] / np.outer(sd, sd) * np.outer(varies, varies), cov[:-1, -1] / sd * varies, varies


def elastic_net_cv(
    df: DataFrame, y: str, xs: Sequence[str], key: str, alphas: Sequence[float] | None = None,
    lambdas: Sequence[float] | None = None, folds: int = 10, seed: int = 1, name: str = "enet",
) -> NetFit:
    """Elastic net with the penalty pair of smallest mean cross-validated RMSE.

    One pass gives the cross-products of each fold; training sets are their sums and
    held-out errors are quadratic forms in them, so no fold is read twice. Mixing
    values above 1 count as 1. A regressor that is constant over the rows has the
    coefficient 0 and is listed in ``dropped``.
    """
    alphas = sorted({min(1.0, a) for a in (alphas if alphas is not None else np.arange(0, 5.01, 0.1).round(1))})
    lambdas = np.sort(lambdas if lambdas is not None else 10 ** np.linspace(-3, 3, 100))[::-1]
    spec = ModelSpec(name, y, tuple(xs))
    tagged = df.withColumn("_f", F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(folds)))
    parts = grams(tagged, [spec], "_f", folds)
    mats = [parts[(0, f)].matrix for f in range(folds)]
    shift = parts[(0, 0)].shift
    total = sum(mats)
    used = [f for f in range(folds) if mats[f][0, 0] > 0 and total[0, 0] - mats[f][0, 0] > 1]
    a_grid = np.array(alphas)

    prep = [_standard(total - mats[f], shift) for f in used]
    stack = [(a, f) for a in range(len(a_grid)) for f in range(len(used))]
    sxx = np.array([prep[f][2] for _, f in stack])
    sxy = np.array([prep[f][3] for _, f in stack])
    errors = np.zeros((len(lambdas), len(a_grid)))
    for li, (_, b) in enumerate(_net_path(sxx, sxy, a_grid[[a for a, _ in stack]], lambdas)):
        for row, (a, f) in enumerate(stack):
            mean, sd, *_ = prep[f]
            slope = b[row] / sd
            w = np.concatenate([[-(mean[-1] - slope @ mean[:-1])], -slope, [1.0]])
            m = mats[used[f]]
            errors[li, a] += math.sqrt(max(w @ m @ w, 0.0) / m[0, 0]) / len(used)
    li, ai = np.unravel_index(np.argmin(errors), errors.shape)
    mean, sd, cxx, cxy, varies = _standard(total, shift)
    for lam, b in _net_path(cxx[None], cxy[None], a_grid[[ai]], lambdas[: li + 1]):
        pass
    slope = b[0] / sd
    intercept = shift[-1] + mean[-1] - slope @ (mean[:-1] + shift[:-1])
    path = [(float(a_grid[j]), float(lambdas[i]), float(errors[i, j])) for i in range(len(lambdas)) for j in range(len(a_grid))]
    return NetFit(
        spec, {"intercept": float(intercept), **{x: float(v) for x, v in zip(spec.xs, slope)}},
        float(a_grid[ai]), float(lambdas[li]), float(errors[li, ai]), path, [x for x, v in zip(spec.xs, varies) if not v],
    )


def _log_normal_cdf(z: np.ndarray) -> np.ndarray:
    """Logarithm of the normal distribution function.

    Right of -4 by the power series of the integral, left of it by the continued fraction
    of Mills' ratio; both are run to double precision for whole arrays at once.
    """
    z = np.asarray(z, dtype=float)
    density = -0.5 * z * z - 0.5 * math.log(2 * math.pi)
    out = np.empty_like(z)
    left = z < -4
    x = -z[left]
    ratio = np.zeros_like(x)
    for k in range(120, 0, -1):
        ratio = k / (x + ratio)
    out[left] = density[left] - np.log(x + ratio)
    a = np.minimum(np.abs(z[~left]), 38.0)
    term, total = a.copy(), a.copy()
    for k in range(1, 400):
        term = term * a * a / (2 * k + 1)
        total += term
        if not np.any(term > 1e-17 * total):
            break
    half = np.exp(-0.5 * a * a - 0.5 * math.log(2 * math.pi)) * np.where(a < 10, total, 0.0)
    upper = np.where(a < 10, half, 0.5)
    out[~left] = np.where(z[~left] >= 0, np.log1p(-(0.5 - upper)), np.log(np.maximum(0.5 - upper, 1e-300)))
    return out


@dataclass
class TobitFit:
    spec: ModelSpec
    coef: dict[str, float]
    sigma: float
    lnl: float
    lnl0: float
    n: int
    censored: int
    limit: float
    se: dict[str, float]
    gradient: float

    def rows(self) -> list[tuple]:
        """term, estimate, se, z, p."""
        out = []
        for term, b in self.coef.items():
            z = b / self.se[term] if self.se[term] > 0 else float("nan")
            out.append((term, b, self.se[term], z, math.erfc(abs(z) / math.sqrt(2))))
        return out


def _tobit_newton(num: DataFrame, cols: list[str], y: str, limit: float, shift, scale, sst: float, n: int, rounds: int):
    """Newton steps in (beta/sigma, 1/sigma), where the likelihood is concave."""
    p = len(cols) + 1

    def pieces(theta: np.ndarray):
        def task(batches):
            acc = np.zeros((p + 2, p + 2))
            for pdf in batches:
                x = np.column_stack([np.ones(len(pdf)), (pdf[cols].to_numpy(dtype=float) - shift) / scale]) if cols else np.ones((len(pdf), 1))
                yy = pdf[y].to_numpy(dtype=float)
                low = yy <= limit
                delta, gamma = theta[:p], theta[p]
                z = np.column_stack([x, -yy])
                u = x @ delta - gamma * yy
                free = z[~low]
                e = u[~low]
                lnl = (~low).sum() * (math.log(gamma) - 0.5 * math.log(2 * math.pi)) - 0.5 * (e @ e)
                grad, hess = -(free.T @ e), -(free.T @ free)
                grad[p] += (~low).sum() / gamma
                hess[p, p] -= (~low).sum() / gamma**2
                if low.any():
                    zc = np.column_stack([-x[low], np.full(low.sum(), limit)])
                    a = zc @ theta
                    lc = _log_normal_cdf(a)
                    mills = np.exp(-0.5 * a * a - 0.5 * math.log(2 * math.pi) - lc)
                    lnl += lc.sum()
                    grad += zc.T @ mills
                    hess -= (zc * (mills * (mills + a))[:, None]).T @ zc
                acc[:p + 1, :p + 1] += hess
                acc[p + 1, :p + 1] += grad
                acc[p + 1, p + 1] += lnl
            i, j = np.indices(acc.shape)
            yield pd.DataFrame({"spec": 0, "fold": 0, "i": i.ravel(), "j": j.ravel(), "v": acc.ravel()}).astype(
                {"spec": "int32", "fold": "int32", "i": "int32", "j": "int32"}
            )

        full = np.zeros((p + 2, p + 2))
        for r in _sum_cells(num, task):
            full[r["i"], r["j"]] = r["v"]
        return full[p + 1, p + 1], full[p + 1, :p + 1], full[:p + 1, :p + 1]

    theta = np.zeros(p + 1)
    theta[p] = 1 / math.sqrt(max(sst / n, 1e-12))
    lnl, grad, hess = pieces(theta)
    for _ in range(rounds):
        step = np.linalg.lstsq(hess, -grad, rcond=None)[0]
        size = 1.0
        while theta[p] + size * step[p] <= 0:
            size /= 2
        trial = pieces(theta + size * step)
        while trial[0] < lnl - 1e-9 and size > 1e-6:
            size /= 2
            trial = pieces(theta + size * step)
        gain = trial[0] - lnl
        theta, (lnl, grad, hess) = theta + size * step, trial
        if abs(gain) < 1e-9 * (1 + abs(lnl)):
            break
    return theta, lnl, grad, hess


def tobit_fit(df: DataFrame, y: str, xs: Sequence[str], rounds: int = 30, name: str = "tobit") -> TobitFit:
    """Censored regression with the lower limit at the smallest outcome.

    The complete rows are written once; each round is one distributed sum of gradient and
    curvature over them. Aliased regressors are dropped in declared order first. Errors
    come from the curvature at the end, carried to slopes by the delta method; ``gradient``
    is the largest part of the score left there, for one row.
    """
    spec = ModelSpec(name, y, tuple(xs))
    num = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in (*xs, y)]).dropna())
    start = ols_fit(num, y, xs, name)
    cols = [x for x in xs if x not in start.dropped]
    st = num.agg(
        F.min(y).alias("lo"), F.avg(y).alias("ym"), *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]
    ).first()
    limit = st["lo"]
    censored = num.filter(F.col(y) <= limit).count()
    shift = np.array([st[f"m_{c}"] for c in cols])
    scale = np.array([st[f"s_{c}"] or 1.0 for c in cols])
    theta, lnl, grad, hess = _tobit_newton(num, cols, y, limit, shift, scale, start.sst, start.n, rounds)
    _, lnl0, _, _ = _tobit_newton(num, [], y, limit, shift[:0], scale[:0], start.sst, start.n, rounds)
    sigma = 1 / theta[-1]
    slope = theta[1:-1] * sigma / scale
    coef = {"intercept": float(theta[0] * sigma - slope @ shift), **{c: float(v) for c, v in zip(cols, slope)}}
    # Derivatives of the slopes and the intercept by (beta / sigma, 1 / sigma).
    p = len(cols)
    jac = np.zeros((p + 1, p + 2))
    jac[1:, 1:-1] = np.diag(sigma / scale)
    jac[1:, -1] = -slope * sigma
    jac[0, 0] = sigma
    jac[0, 1:-1] = -sigma * shift / scale
    jac[0, -1] = -coef["intercept"] * sigma
    cov = jac @ np.linalg.pinv(-hess) @ jac.T
    se = {t: float(math.sqrt(max(v, 0.0))) for t, v in zip(["intercept", *cols], np.diag(cov))}
    return TobitFit(spec, coef, float(sigma), float(lnl), float(lnl0), start.n, int(censored), float(limit), se, float(np.abs(grad).max() / start.n))


def unaliased(df: DataFrame, y: str, xs: Sequence[str]) -> list[str]:
    """Regressors left when constant and aliased ones are dropped in declared order, over the complete rows."""
    dropped = ols_fit(df, y, xs).dropped
    return [x for x in xs if x not in dropped]


def _normal_cdf(z: np.ndarray) -> np.ndarray:
    return 0.5 * np.array([math.erfc(v) for v in (z / -math.sqrt(2)).tolist()])


# Probabilities keep this distance from 0 and 1.
_EDGE = 1e-16


def _fitted(eta: np.ndarray, link: str) -> np.ndarray:
    mu = 1 / (1 + np.exp(-eta)) if link == "logit" else _normal_cdf(eta)
    return np.clip(mu, _EDGE, 1 - _EDGE)


@dataclass
class BinaryFit:
    """``summary`` is the fit itself; its lists have the slopes first and the intercept last."""

    xs: list[str]
    link: str
    coefficients: list[float]
    intercept: float
    coefficientStandardErrors: list[float]  # noqa: N815
    n: int
    deviance: float
    null_deviance: float
    rounds: int

    @property
    def summary(self) -> BinaryFit:
        return self

    @property
    def aic(self) -> float:
        return self.deviance + 2 * (len(self.xs) + 1)

    @property
    def tValues(self) -> list[float]:  # noqa: N802
        return [b / se for b, se in zip([*self.coefficients, self.intercept], self.coefficientStandardErrors, strict=True)]

    @property
    def pValues(self) -> list[float]:  # noqa: N802
        return [2 * (1 - 0.5 * (1 + math.erf(abs(t) / math.sqrt(2)))) for t in self.tValues]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``, the probability at the regressors of a row."""
        link = self.link
        eta = sum((F.lit(b) * F.col(x).cast("double") for b, x in zip(self.coefficients, self.xs, strict=True)), F.lit(self.intercept))
        if link == "logit":
            mean = 1 / (1 + F.exp(-eta))
        else:
            mean = F.pandas_udf(lambda v: pd.Series(_fitted(v.to_numpy(dtype=float), link)), "double")(eta)
        return df.withColumn("prediction", F.when(eta.isNotNull(), F.greatest(F.least(mean, F.lit(1 - _EDGE)), F.lit(_EDGE))))


def _binary_sums(rows: DataFrame, cols: list[str], link: str, shift, scale, theta: np.ndarray | None):
    """Weighted cross-products of (1, xs, working outcome) and the deviance at ``theta``, at the start that of each row by itself."""
    p = len(cols) + 1

    def task(batches):
        acc, dev = np.zeros((p + 1, p + 1)), 0.0
        for pdf in batches:
            y = pdf["_y"].to_numpy(dtype=float)
            z = np.column_stack([np.ones(len(y)), (pdf[cols].to_numpy(dtype=float) - shift) / scale])
            if theta is None:
                spot = math.log(3) if link == "logit" else 0.6744897501960817
                work, weight = np.where(y > 0, spot, -spot), 1.0
            else:
                eta = z @ theta
                mu = _fitted(eta, link)
                if link == "logit":
                    slope = mu * (1 - mu)
                else:
                    slope = np.exp(-0.5 * np.clip(eta, -8.2221, 8.2095) ** 2) / math.sqrt(2 * math.pi)
                work, weight = eta + (y - mu) / slope, slope * slope / (mu * (1 - mu))
                dev -= 2 * float(np.log(np.where(y > 0, mu, 1 - mu)).sum())
            full = np.column_stack([z, work])
            acc += (full * np.reshape(weight, (-1, 1))).T @ full
        i, j = np.indices(acc.shape)
        cells = pd.DataFrame({"spec": 0, "fold": 0, "i": i.ravel(), "j": j.ravel(), "v": acc.ravel()})
        yield pd.concat([cells, pd.DataFrame({"spec": [1], "fold": [0], "i": [0], "j": [0], "v": [dev]})]).astype(
            {"spec": "int32", "fold": "int32", "i": "int32", "j": "int32"})

    m, dev = np.zeros((p + 1, p + 1)), 0.0
    for r in _sum_cells(rows, task):
        if r["spec"]:
            dev = r["v"]
        else:
            m[r["i"], r["j"]] = r["v"]
    return m[:p, :p], m[:p, p], dev


def binary_fit(df: DataFrame, y: str, xs: Sequence[str], link: str = "logit", rounds: int = 50, tol: float = 1e-10) -> BinaryFit:
    """Logit or probit of a flag, where any known non-zero value counts as 1.

    Reweighted least squares until no coefficient moves by ``tol``; each round is one
    distributed sum of cross-products. Without errors of the coefficients where a regressor
    is aliased; see ``unaliased``. A flag that is the same in all rows is left to Spark's fit.
    """
    cols, xs = [f"_x{i}" for i in range(len(xs))], list(xs)
    known = df.dropna(subset=[y, *xs])
    rows = known.select(*[F.col(x).cast("double").alias(c) for x, c in zip(xs, cols, strict=True)], (F.col(y) != 0).cast("double").alias("_y"))
    st = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("share"), *[f(c).alias(f"{k}{c}") for c in cols for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if not xs or st["share"] in (None, 0.0, 1.0):
        return _glm_fit(known, y, xs, link)
    shift, scale = np.array([st[f"m{c}"] for c in cols]), np.array([st[f"s{c}"] or 1.0 for c in cols])

    def plain(theta: np.ndarray) -> np.ndarray:
        slope = theta[1:] / scale
        return np.array([*slope, theta[0] - slope @ shift])

    a, b, _ = _binary_sums(rows, cols, link, shift, scale, None)
    theta, done = np.linalg.lstsq(a, b, rcond=None)[0], 0
    for done in range(1, rounds + 1):
        a, b, deviance = _binary_sums(rows, cols, link, shift, scale, theta)
        before, theta = theta, np.linalg.lstsq(a, b, rcond=None)[0]
        if np.abs(plain(theta) - plain(before)).max() < tol:
            break
    jac = np.vstack([np.column_stack([np.zeros(len(cols)), np.diag(1 / scale)]), [1.0, *(-shift / scale)]])
    errors = np.sqrt(np.maximum(np.diag(jac @ np.linalg.pinv(a) @ jac.T), 0.0))
    found, share = plain(theta), st["share"]
    return BinaryFit(
        xs, link, [float(v) for v in found[:-1]], float(found[-1]), [float(v) for v in errors], st["n"], float(deviance),
        -2 * st["n"] * (share * math.log(share) + (1 - share) * math.log(1 - share)), done,
    )


def _glm_fit(df: DataFrame, y: str, xs: Sequence[str], link: str):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    rows = df.withColumn("_y", (F.col(y) != 0).cast("double"))
    data = VectorAssembler(inputCols=list(xs), outputCol="_x").transform(rows).select("_x", "_y")
    return GeneralizedLinearRegression(
        family="binomial", link=link, featuresCol="_x", labelCol="_y", maxIter=50, tol=1e-10
    ).fit(data)
