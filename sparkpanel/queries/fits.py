"""Regressions on the cluster panel, trained on early years and scored on the last ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.operators.clean import insecure_side
from sparkpanel.operators.windows import broadcast_mean
from sparkpanel.plans import models as md
from sparkpanel.plans import panel
from sparkpanel.queries.base import query, rounded, table
from sparkpanel.queries.market import station_frame
from sparkpanel.queries.survey import CLUSTER_SQL, clusters
from sparkpanel.session import cut_lineage

FIRST_TEST = 2000
# The variables of each part of a model.
MEASURES = ("logFCS", "HDDS", "rCSI")
WEATHER = ("raincytot", "day1rain", "floodmax", "maxdaysnorain")
ACCESS = ("maize_current", "maize_mktthin_current")
LAND = ("percent_ag", "elevation", "nutri")
DISTANCE = ("dist_road", "dist_admarc")
ASSET = ("roof_natural_inverse", "number_celphones")
DEMO = ("hhsize", "hh_age", "hh_gender", "asset")
QUARTERS = ("quarter1", "quarter2", "quarter3")
PRIOR = "IPC1"
GROUPS = {
    "model0": (),
    "model1": (*WEATHER, *ACCESS, *LAND, *DISTANCE),
    "model2": (*WEATHER, *ACCESS, *ASSET, *LAND, *DISTANCE),
    "model3": (*WEATHER, *ACCESS, *ASSET, *LAND, *DISTANCE, *DEMO),
}


def staged(spark, sf, *cols, number=None):
    """The cluster panel, or these of its columns, as a written stage; every fit reads it several times.

    ``number`` names a column that tells its rows apart.
    """
    panel_rows = clusters(spark, sf, cols)
    panel_rows = panel_rows.select(*dict.fromkeys(cols)) if cols else panel_rows
    return cut_lineage(panel_rows.withColumn(number, F.monotonically_increasing_id()) if number else panel_rows)


def levelled(spark, sf):
    """Cluster panel with zone and area means of the model variables beside the own values."""
    df = staged(spark, sf)
    df = df.drop(*[c for c in df.columns if c.startswith("TA_") and c != "TA_names"])
    for prefix, key in (("lhz_", "zone"), ("TA_", "TA_names")):
        df = broadcast_mean(df, [key, "FS_year"], list(GROUPS["model3"]), prefix)
    return cut_lineage(df)


def grid_specs():
    # The fourth quarter is the base; the prior phase is in every model.
    return md.level_specs(MEASURES, ("lhz", "TA", "clust"), GROUPS, (*QUARTERS, PRIOR), "clust")


# ---- one and several regressors on raw lines

@query("ols_simple", """SELECT l_returnflag, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
  round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, count(*) AS n FROM lineitem GROUP BY ALL""")
def ols_simple(spark, sf):
    y, x = "l_extendedprice", "l_quantity"
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.regr_intercept(y, x), 4).alias("intercept"), F.round(F.regr_slope(y, x), 6).alias("slope"),
        F.round(F.regr_r2(y, x), 6).alias("r2"), F.count(F.lit(1)).alias("n"))


@query("ols_gram", """WITH r AS (SELECT regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b,
    regr_r2(l_extendedprice, l_quantity) AS r2, count(*) AS n FROM lineitem)
  SELECT 'intercept' AS term, round(a, 4) AS estimate, CAST(n AS INTEGER) AS n, round(r2, 6) AS r2 FROM r UNION ALL SELECT 'l_quantity', round(b, 4), CAST(n AS INTEGER), round(r2, 6) FROM r""")
def ols_gram(spark, sf):
    fit = md.ols_fit(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"])
    return md.coef_table(spark, [fit]).select("term", F.round("estimate", 4).alias("estimate"), "n", F.round("r2", 6).alias("r2"))


@query("ols_predict", """WITH r AS (SELECT regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b FROM lineitem)
  SELECT l_orderkey, l_linenumber, l_quantity, round(a + b * l_quantity, 3) AS predict FROM lineitem, r""")
def ols_predict(spark, sf):
    li = table(spark, sf, "lineitem")
    fit = md.ols_fit(li, "l_extendedprice", ["l_quantity"])
    return li.select("l_orderkey", "l_linenumber", "l_quantity", F.round(fit.predictor(), 3).alias("predict"))


@query("ols_multi")
def ols_multi(spark, sf):
    train, _ = panel.split_year(staged(spark, sf, "FS_year", *MEASURES, *GROUPS["model3"], *QUARTERS, PRIOR), "FS_year", FIRST_TEST)
    specs = [md.ModelSpec(y, y, (*GROUPS["model3"], *QUARTERS, PRIOR)) for y in MEASURES]
    return md.coef_table(spark, md.fit_all(train, specs))


# Variables of the panel that SQL builds as well.
_OPEN = ("raincytot", "day1rain", "elevation", "maize_current", "maize_mktthin_current", "hhsize", "hh_age", PRIOR)
_K = len(_OPEN)


def _known_sql(where: str = "") -> str:
    """Rows of each measure that are complete in it and in all regressors."""
    return "known AS (" + " UNION ALL ".join(
        f"SELECT '{y}' AS y, {y} AS v, {', '.join(_OPEN)} FROM cl2 WHERE {where}{y} IS NOT NULL AND {' AND '.join(f'{x} IS NOT NULL' for x in _OPEN)}"
        for y in MEASURES) + ")"


# Normal equations of centred columns, pivoted in place one regressor at a time.
@query("ols_errors", f"""WITH RECURSIVE {CLUSTER_SQL}, {_known_sql(f'FS_year < {FIRST_TEST} AND ')},
  w AS (SELECT y, [{', '.join(f'{x} - avg({x}) OVER p' for x in (*_OPEN, 'v'))}] AS z FROM known WINDOW p AS (PARTITION BY y)),
  cells AS (SELECT y, i, j, sum(z[i] * z[j]) AS v FROM w, range(1, {_K + 2}) a(i), range(1, {_K + 2}) b(j) GROUP BY y, i, j),
  lines AS (SELECT y, i, list(v ORDER BY j) AS r FROM cells GROUP BY y, i),
  pivoted AS (SELECT y, 0 AS k, list(r ORDER BY i) AS m FROM lines GROUP BY y
    UNION ALL SELECT y, k + 1, list_transform(range(1, {_K + 2}), lambda i: list_transform(range(1, {_K + 2}), lambda j:
      CASE WHEN i = k + 1 AND j = k + 1 THEN 1 / m[i][j] WHEN i = k + 1 THEN m[i][j] / m[i][i] WHEN j = k + 1 THEN -m[i][j] / m[j][j]
           ELSE m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1] END)) FROM pivoted WHERE k < {_K}),
  f AS (SELECT p.y, p.m, s.n, p.m[{_K + 1}][{_K + 1}] AS sse, q.m[{_K + 1}][{_K + 1}] AS sst, sse / (s.n - {_K + 1}) AS s2
    FROM pivoted p JOIN pivoted q ON q.y = p.y AND q.k = 0 JOIN (SELECT y, count(*) AS n FROM known GROUP BY y) s ON s.y = p.y WHERE p.k = {_K})
  SELECT y, t AS term, round(m[i][{_K + 1}], 6) AS estimate, round(sqrt(m[i][i] * s2), 6) AS se, round(m[i][{_K + 1}] / sqrt(m[i][i] * s2), 4) AS t, CAST(n AS INTEGER) AS n,
    round(1 - sse / sst, 6) AS r2, round(1 - sse / sst * (n - 1) / (n - {_K + 1}), 6) AS adj_r2, round(-n / 2 * (ln(2 * pi()) + ln(sse / n) + 1), 4) AS lnl,
    round(1 - (ln(2 * pi()) + ln(sse / n) + 1) / (ln(2 * pi()) + ln(sst / n) + 1), 6) AS pseudo_r2
  FROM f, (VALUES {', '.join(f"({i + 1}, '{x}')" for i, x in enumerate(_OPEN))}) v(i, t)""")
def ols_errors(spark, sf):
    train, _ = panel.split_year(staged(spark, sf, "FS_year", *MEASURES, *_OPEN), "FS_year", FIRST_TEST)
    fits = md.fit_all(train, [md.ModelSpec(y, y, _OPEN) for y in MEASURES])
    slopes = md.coef_table(spark, fits).filter("term <> 'intercept'").select("y", "term", "estimate", "se", "t", "n", "r2")
    both = slopes.join(md.fit_stats(spark, fits).select("y", "adj_r2", "lnl", "pseudo_r2"), "y")
    return rounded(rounded(both, ["estimate", "se", "r2", "adj_r2", "pseudo_r2"]), ["t", "lnl"], 4)


@query("fit_stats")
def fit_stats(spark, sf):
    train, _ = panel.split_year(staged(spark, sf, "FS_year", *MEASURES, *GROUPS["model3"], *QUARTERS, PRIOR), "FS_year", FIRST_TEST)
    specs = [md.ModelSpec(m, y, (*xs, *QUARTERS, PRIOR)) for y in MEASURES for m, xs in GROUPS.items()]
    return md.fit_stats(spark, md.fit_all(train, specs))


@query("fe_ols")
def fe_ols(spark, sf):
    return md.coef_table(spark, [md.fe_ols(staged(spark, sf, "HDDS", "hhsize", "hh_age", "FS_year", "region"), "HDDS", ["hhsize", "hh_age"], ["FS_year", "region"])])


# What makes a least squares fit: residuals that are orthogonal to every regressor.
@query("fe_ols_score", f"""WITH {CLUSTER_SQL}, known AS (SELECT * FROM cl2 WHERE HDDS IS NOT NULL AND hhsize IS NOT NULL AND hh_age IS NOT NULL),
  terms AS (SELECT unnest(['intercept', 'hhsize', 'hh_age']) AS term
    UNION ALL SELECT DISTINCT 'FS_year_' || FS_year FROM known WHERE FS_year > (SELECT min(FS_year) FROM known)
    UNION ALL SELECT DISTINCT 'region_' || region FROM known WHERE region > (SELECT min(region) FROM known))
  SELECT term, (SELECT count(*) FROM known) AS n, 0.0::DOUBLE AS score FROM terms""")
def fe_ols_score(spark, sf):
    df = staged(spark, sf, "HDDS", "hhsize", "hh_age", "FS_year", "region")
    fit = md.fe_ols(df, "HDDS", ["hhsize", "hh_age"], ["FS_year", "region"])
    own = [t for t in fit.coef if t.startswith(("FS_year_", "region_"))]
    factor = lambda t: "FS_year" if t.startswith("FS_year_") else "region"
    flags = df.select("HDDS", "hhsize", "hh_age", F.lit(1.0).alias("intercept"), *[
        (F.col(factor(t)).cast("string") == t[len(factor(t)) + 1:]).cast("double").alias(f"_t{i}") for i, t in enumerate(own)
    ]).dropna()
    column = {**{t: t for t in ("intercept", "hhsize", "hh_age")}, **{t: f"_t{i}" for i, t in enumerate(own)}}
    rest = F.col("HDDS") - sum((F.lit(b) * F.col(column[t]) for t, b in fit.coef.items()), F.lit(0.0))
    sums = flags.agg(*[F.abs(F.round(F.avg(rest * F.col(c)), 6)).alias(t) for t, c in column.items()], F.count(F.lit(1)).alias("n"))
    return sums.unpivot(["n"], list(column), "term", "score").select("term", "n", "score")


@query("fe_within", f"""WITH {CLUSTER_SQL}, w AS (SELECT ea_id, HDDS - avg(HDDS) OVER p AS y, hhsize - avg(hhsize) OVER p AS a, hh_age - avg(hh_age) OVER p AS b, HDDS AS raw
    FROM cl2 WHERE HDDS IS NOT NULL AND hhsize IS NOT NULL AND hh_age IS NOT NULL WINDOW p AS (PARTITION BY ea_id)),
  s AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS yb, sum(y * y) AS yy, var_pop(raw) * count(*) AS sst, count(*) AS n, count(DISTINCT ea_id) AS g FROM w),
  f AS (SELECT *, aa * bb - ab * ab AS det, (ay * bb - yb * ab) / det AS b1, (yb * aa - ay * ab) / det AS b2, yy - b1 * ay - b2 * yb AS sse, sse / (n - g - 2) AS s2 FROM s)
  SELECT 'hhsize' AS term, round(b1, 6) AS estimate, round(sqrt(s2 * bb / det), 6) AS se, round(b1 / sqrt(s2 * bb / det), 5) AS t, CAST(n AS INTEGER) AS n, round(1 - sse / yy, 6) AS within_r2, round(1 - sse / sst, 6) AS overall_r2 FROM f
  UNION ALL SELECT 'hh_age', round(b2, 6), round(sqrt(s2 * aa / det), 6), round(b2 / sqrt(s2 * aa / det), 5), CAST(n AS INTEGER), round(1 - sse / yy, 6), round(1 - sse / sst, 6) FROM f""")
def fe_within(spark, sf):
    fit = md.within_ols(staged(spark, sf, "HDDS", "hhsize", "hh_age", "ea_id"), "HDDS", ["hhsize", "hh_age"], "ea_id")
    return md.coef_table(spark, [fit]).select(
        "term", F.round("estimate", 6).alias("estimate"), F.round("se", 6).alias("se"), F.round("t", 5).alias("t"), "n",
        F.round("r2", 6).alias("within_r2"), F.round(F.lit(fit.overall_r2), 6).alias("overall_r2"))


# Suppliers are swept out by their means, line numbers (1 to 7) and regressors by a matrix that is pivoted in place.
_TERMS = ("l_quantity", "l_discount", *(f"(l_linenumber = {i})::INT::DOUBLE" for i in range(2, 8)), "l_extendedprice")
_P = len(_TERMS) - 1


@query("fe_two_way", f"""WITH RECURSIVE w AS (SELECT [{', '.join(f'({t}) - avg({t}) OVER p' for t in _TERMS)}] AS z, l_suppkey, l_extendedprice AS y FROM lineitem WINDOW p AS (PARTITION BY l_suppkey)),
  cells AS (SELECT i, j, sum(z[i] * z[j]) AS v FROM w, range(1, {_P + 2}) a(i), range(1, {_P + 2}) b(j) GROUP BY i, j),
  lines AS (SELECT i, list(v ORDER BY j) AS r FROM cells GROUP BY i),
  pivoted AS (SELECT 0 AS k, list(r ORDER BY i) AS m FROM lines
    UNION ALL SELECT k + 1, list_transform(range(1, {_P + 2}), lambda i: list_transform(range(1, {_P + 2}), lambda j:
      CASE WHEN i = k + 1 AND j = k + 1 THEN 1 / m[i][j] WHEN i = k + 1 THEN m[i][j] / m[i][i] WHEN j = k + 1 THEN -m[i][j] / m[j][j]
           ELSE m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1] END)) FROM pivoted WHERE k < {_P}),
  f AS (SELECT m, count(*) AS n, m[{_P + 1}][{_P + 1}] / (count(*) - count(DISTINCT l_suppkey) - {_P}) AS s2, var_pop(y) * count(*) AS sst FROM pivoted, w WHERE k = {_P} GROUP BY m)
  SELECT t AS term, round(m[i][{_P + 1}], 4) AS estimate, round(sqrt(m[i][i] * s2), 4) AS se, CAST(n AS INTEGER) AS n, round(1 - m[{_P + 1}][{_P + 1}] / sst, 6) AS overall_r2
  FROM f, (VALUES (1, 'l_quantity'), (2, 'l_discount')) v(i, t)""")
def fe_two_way(spark, sf):
    fit = md.absorbed_ols(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount"], ["l_suppkey", "l_linenumber"])
    return md.coef_table(spark, [fit]).select(
        "term", F.round("estimate", 4).alias("estimate"), F.round("se", 4).alias("se"), "n", F.round(F.lit(fit.overall_r2), 6).alias("overall_r2"))


_FACTORS = {"Month": ["FS_month"], "IPC": ["zone"], "TA": ["TA_names"], "Cluster": ["ea_id"], "Month x TA": ["FS_month", "TA_names"]}


@query("group_r2", f"""WITH {CLUSTER_SQL}, """ + ", ".join(
    f"g{i} AS (SELECT {', '.join(f'{y} - avg({y}) OVER (PARTITION BY {chr(44).join(ks)}) AS w_{y}, {y} AS t_{y}' for y in ('HDDS', 'rCSI'))} FROM cl2)" for i, ks in enumerate(_FACTORS.values())
) + " " + " UNION ALL ".join(
    f"SELECT '{y}' AS measure, '{name}' AS factor, round(1 - sum(pow(w_{y}, 2)) / (var_pop(t_{y}) * count(t_{y})), 6) AS r2 FROM g{i}"
    for i, name in enumerate(_FACTORS) for y in ("HDDS", "rCSI")))
def group_r2(spark, sf):
    return rounded(md.group_r2(staged(spark, sf, "HDDS", "rCSI", *(c for cols in _FACTORS.values() for c in cols)), ["HDDS", "rCSI"], _FACTORS), ["r2"])


@query("split_year", f"""WITH {CLUSTER_SQL} SELECT ea_id, FS_year AS "FS_year", CASE WHEN FS_year < {FIRST_TEST} THEN 'train' ELSE 'test' END AS part FROM cl2""")
def split_year(spark, sf):
    train, test = panel.split_year(clusters(spark, sf, ("ea_id", "FS_year")).select("ea_id", "FS_year"), "FS_year", FIRST_TEST)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("strat_split", """WITH q AS (SELECT quantile_cont(o_totalprice, [0.2, 0.4, 0.6, 0.8]) AS c FROM orders),
  s AS (SELECT o_orderkey, CAST(o_totalprice > c[1] AS INTEGER) + CAST(o_totalprice > c[2] AS INTEGER) + CAST(o_totalprice > c[3] AS INTEGER) + CAST(o_totalprice > c[4] AS INTEGER) AS st FROM orders, q)
  SELECT o_orderkey, row_number() OVER (PARTITION BY st ORDER BY md5('7-' || o_orderkey), o_orderkey) <= ceil(count(*) OVER (PARTITION BY st) * 0.7::DOUBLE) AS train FROM s""")
def strat_split(spark, sf):
    return md.stratified_split(table(spark, sf, "orders"), "o_totalprice", "o_orderkey", 0.7, 7).select("o_orderkey", "train")


@query("model_grid")
def model_grid(spark, sf):
    train, test = panel.split_year(levelled(spark, sf), "FS_year", FIRST_TEST)
    _, r2 = md.run_grid(train, test, grid_specs(), ["ea_id", "FS_year"])
    return r2


@query("model_grid_tail")
def model_grid_tail(spark, sf):
    train, test = panel.split_year(levelled(spark, sf), "FS_year", FIRST_TEST)
    parts = []
    for y in MEASURES:
        specs = [s for s in grid_specs() if s.y == y]
        parts.append(md.run_grid(train.filter(insecure_side(y, y)), test, specs, ["ea_id", "FS_year"])[1])
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("grid_pairs")
def grid_pairs(spark, sf):
    train, test = panel.split_year(levelled(spark, sf), "FS_year", FIRST_TEST)
    pairs, _ = md.run_grid(train, test, grid_specs(), ["ea_id", "FS_year"])
    return rounded(pairs, ["actual", "predict"])


# What each choice of a specification adds.
PRICES = {"none": (), "current": ACCESS, "lagged": ("maize_lag", "maize_mktthin_lag"), "station": ("station_current",), "station_lagged": ("station_lag",)}
CALENDARS = {"none": (), "quarter": QUARTERS, "month": tuple(f"month{m}" for m in range(1, 12)), "trend": ("trend",)}
REGIONS = ("region_AFRICA", "region_AMERICA", "region_ASIA", "region_EUROPE")
TEMPERATURE = ("gdd", "tmean", "heatdays")
BASE = (*WEATHER, *LAND, *DISTANCE, *ASSET, "hhsize", "hh_age")


def variable_set(price: str, calendar: str, region: bool, temperature: bool) -> tuple[str, tuple[str, ...]]:
    """Name and variables of one specification; regions meet the quarters where both are in."""
    parts = [*BASE, *PRICES[price], *CALENDARS[calendar]]
    if region:
        parts += REGIONS
        if calendar == "quarter":
            parts += [f"quarter{q}_{r}" for q in range(1, 5) for r in (*REGIONS, "region_MIDDLE EAST")]
    if temperature:
        parts += TEMPERATURE
    name = f"price_{price}.calendar_{calendar}" + ".region" * region + ".temperature" * temperature
    return name, tuple(parts)


# Each price alone, the market prices with each calendar, then regions and temperatures beside some of these.
CHOICES = [
    *[(price, "none", False, False) for price in PRICES],
    *[(price, calendar, False, False) for calendar in ("quarter", "month", "trend") for price in ("none", "current", "lagged")],
    *[(price, calendar, True, False) for price, calendar in (("current", "none"), ("none", "quarter"), ("current", "quarter"), ("none", "month"))],
    *[(price, "none", False, True) for price in ("current", "station_lagged")],
]
SETS = dict(variable_set(*choice) for choice in CHOICES)


@query("spec_sweep")
def spec_sweep(spark, sf):
    made = ("trend", *PRICES["station"], *PRICES["station_lagged"])
    panel_cols = ["ea_id", "FS_year", "FS_month", "region", *MEASURES, *(x for xs in SETS.values() for x in xs if x not in made)]
    df = staged(spark, sf, *panel_cols, number="_row")
    # Stations and the random split are found beside the few columns that they need, and the wide rows move once.
    narrow = df.select("_row", "ea_id", "HDDS", F.make_date("FS_year", F.col("FS_month").cast("int"), F.lit(1)).alias("month"))
    stations = station_frame(spark, sf, narrow.select(F.col("ea_id").alias("c_custkey"), "month")).select(
        F.col("c_custkey").alias("ea_id"), "month", F.col("price").alias("station_current"), F.col("price_lag").alias("station_lag"))
    narrow = cut_lineage(narrow.join(stations, ["ea_id", "month"], "left"))
    found = ["_row", "station_current", "station_lag"]
    tagged = md.stratified_split(narrow.filter("HDDS IS NOT NULL"), "HDDS", "ea_id", 0.7, 7).select(*found, "train")
    tagged = tagged.unionByName(narrow.filter("HDDS IS NULL").select(*found, F.lit(None).cast("boolean").alias("train")))
    df = df.withColumn("trend", (F.col("FS_year") - FIRST_TEST) * 12 + F.col("FS_month"))
    df = cut_lineage(df.join(tagged, "_row").drop("_row"))
    splits = {
        "year": panel.split_year(df, "FS_year", FIRST_TEST),
        "region": panel.split_region(df, "region", "EUROPE"),
        "random": (df.filter("train"), df.filter("NOT train")),
    }
    return md.sweep(splits, SETS, MEASURES, ["ea_id", "FS_year"])


@query("enet_cv")
def enet_cv(spark, sf):
    train, _ = panel.split_year(staged(spark, sf, "ea_id", "FS_year", *MEASURES, *GROUPS["model3"], *QUARTERS, PRIOR), "FS_year", FIRST_TEST)
    rows = []
    for y in MEASURES:
        fit = md.elastic_net_cv(train, y, (*GROUPS["model3"], *QUARTERS, PRIOR), "ea_id")
        rows += [(y, t, b, fit.alpha, fit.lam, fit.cv_rmse) for t, b in fit.coef.items()]
    return spark.createDataFrame(rows, "measure string, term string, estimate double, alpha double, lambda double, cv_rmse double")


# At the smallest penalised error no term can gain: the slope of the error is the penalty's where a term is in, and within it where it is out.
@query("enet_conditions", f"""WITH {CLUSTER_SQL}, {_known_sql(f'FS_year < {FIRST_TEST} AND ')}
  SELECT y AS measure, term, CAST(count(*) AS INTEGER) AS n, 0.0::DOUBLE AS excess FROM known, (VALUES {', '.join(f"('{x}')" for x in _OPEN)}) t(term) GROUP BY ALL""")
def enet_conditions(spark, sf):
    train, _ = panel.split_year(staged(spark, sf, "ea_id", "FS_year", *MEASURES, *_OPEN), "FS_year", FIRST_TEST)
    parts = None
    for y in MEASURES:
        fit = md.elastic_net_cv(train, y, _OPEN, "ea_id")
        rows = train.select(F.col(y).alias("_y"), *[F.col(x).cast("double").alias(x) for x in _OPEN]).dropna()
        rest = F.col("_y") - sum((F.lit(fit.coef[x]) * F.col(x) for x in _OPEN), F.lit(fit.coef["intercept"]))
        excess = []
        for x in _OPEN:
            if x in fit.dropped:
                # A constant takes nothing off the error.
                excess.append(F.lit(0.0).alias(x))
                continue
            b, l1, l2 = fit.coef[x], fit.lam * fit.alpha, fit.lam * (1 - fit.alpha)
            sd = F.stddev_pop(x)
            slope = F.covar_pop(rest, F.col(x)) / sd
            off = F.greatest(F.abs(slope) - l1, F.lit(0.0)) if b == 0 else F.abs(slope - sd * (l2 * b) - (l1 if b > 0 else -l1))
            excess.append(F.round(off, 5).alias(x))
        sums = rows.agg(*excess, F.count(F.lit(1)).cast("int").alias("n"))
        part = sums.unpivot(["n"], list(_OPEN), "term", "excess").select(F.lit(y).alias("measure"), "term", "n", "excess")
        parts = part if parts is None else parts.unionByName(part)
    return parts


_SHORT = ["maize_current", "hhsize", "hh_age", "elevation", PRIOR]


def _tobits(spark, sf):
    train, _ = panel.split_year(staged(spark, sf, "FS_year", *MEASURES, *_SHORT), "FS_year", FIRST_TEST)
    return [(y, md.tobit_fit(train, y, _SHORT)) for y in MEASURES]


@query("tobit")
def tobit(spark, sf):
    rows = [
        (y, *row, fit.sigma, fit.lnl, 1 - fit.lnl / fit.lnl0, fit.n, fit.censored)
        for y, fit in _tobits(spark, sf) for row in fit.rows()
    ]
    return spark.createDataFrame(
        rows, "measure string, term string, estimate double, se double, z double, p double, sigma double, lnl double, pseudo_r2 double, n int, censored int")


# At the largest likelihood the score of a row is zero on average.
@query("tobit_score", f"""WITH {CLUSTER_SQL}, known AS (SELECT * FROM cl2 WHERE FS_year < {FIRST_TEST} AND maize_current IS NOT NULL AND hhsize IS NOT NULL AND hh_age IS NOT NULL AND elevation IS NOT NULL AND IPC1 IS NOT NULL)
  """ + " UNION ALL ".join(
    f"SELECT '{y}' AS measure, CAST(count({y}) AS INTEGER) AS n, CAST(count(*) FILTER ({y} = (SELECT min({y}) FROM known)) AS INTEGER) AS censored, 0.0::DOUBLE AS score FROM known" for y in MEASURES))
def tobit_score(spark, sf):
    rows = [(y, fit.n, fit.censored, round(abs(fit.gradient), 6)) for y, fit in _tobits(spark, sf)]
    return spark.createDataFrame(rows, "measure string, n int, censored int, score double")


@query("logit")
def logit(spark, sf):
    flags = {y: insecure_side(y, y) for y in MEASURES}
    df = cut_lineage(staged(spark, sf, *MEASURES, *_SHORT).select(*_SHORT, *[F.when(F.col(y).isNotNull(), c.cast("int")).alias(y) for y, c in flags.items()]))
    rows = []
    for y in MEASURES:
        known = df.dropna(subset=[y, *_SHORT])
        # Aliased regressors have no estimate and no row.
        kept = md.unaliased(known, y, _SHORT)
        for link in ("logit", "probit"):
            fit = md.binary_fit(known, y, kept, link)
            s = fit.summary
            # The summary lists the slopes first and the intercept last.
            rows += [
                (y, link, t, float(b), float(se), float(z), float(p))
                for t, b, se, z, p in zip([*kept, "intercept"], [*fit.coefficients, fit.intercept], s.coefficientStandardErrors, s.tValues, s.pValues)
            ]
    return spark.createDataFrame(rows, "measure string, link string, term string, estimate double, se double, z double, p double")


# At the largest likelihood the score of each term is zero on average.
@query("binary_score", f"""WITH {CLUSTER_SQL}, known AS (SELECT * FROM cl2 WHERE {' AND '.join(f'{x} IS NOT NULL' for x in _SHORT)})
  SELECT y AS measure, link, term, CAST(n AS INTEGER) AS n, 0.0::DOUBLE AS score FROM ({' UNION ALL '.join(f"SELECT '{y}' AS y, count({y}) AS n FROM known" for y in MEASURES)}),
    (VALUES ('logit'), ('probit')) l(link), (VALUES {', '.join(f"('{t}')" for t in ('intercept', *_SHORT))}) t(term)""")
def binary_score(spark, sf):
    from pyspark.ml.feature import VectorAssembler

    flags = [F.when(F.col(y).isNotNull(), insecure_side(y, y).cast("double")).alias(y) for y in MEASURES]
    df = cut_lineage(staged(spark, sf, *MEASURES, *_SHORT).select(F.lit(1.0).alias("intercept"), *[F.col(x).cast("double").alias(x) for x in _SHORT], *flags))
    parts = None
    for y in MEASURES:
        known = df.dropna(subset=[y, *_SHORT])
        kept = md.unaliased(known, y, _SHORT)
        rows = VectorAssembler(inputCols=kept, outputCol="_x").transform(known)
        for link in ("logit", "probit"):
            fit = md.binary_fit(known, y, kept, link)
            p = F.col("prediction")
            eta = sum((F.lit(float(b)) * F.col(x) for b, x in zip(fit.coefficients, kept)), F.lit(float(fit.intercept)))
            # The slope of the link over the variance, which is 1 for the logit.
            weight = F.lit(1.0) if link == "logit" else F.coalesce(F.exp(-eta * eta / 2) / F.nullif(p * (1 - p), F.lit(0.0)), F.lit(0.0))
            score = [F.abs(F.round(F.avg((F.col(y) - p) * weight * F.col(t)) / F.avg(F.abs(F.col(t))), 5)).alias(t) for t in ("intercept", *_SHORT)]
            sums = fit.transform(rows).agg(*score, F.count(F.lit(1)).cast("int").alias("n"))
            part = sums.unpivot(["n"], ["intercept", *_SHORT], "term", "score").select(F.lit(y).alias("measure"), F.lit(link).alias("link"), "term", "n", "score")
            parts = part if parts is None else parts.unionByName(part)
    return parts
