"""Class cuts, confusion tables and error measures on per-order pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.operators import reshape
from sparkpanel.plans import evaluate as ev
from sparkpanel.queries.base import nation_month, query, rounded, table
from sparkpanel.queries.series import PHASE_SQL, phases

# Pairs: per supplier and month the mean of two halves of its lines, scaled to each measure.
_PAIR_SQL = """half AS (SELECT l_suppkey AS k, l_linenumber AS m, avg(l_quantity) FILTER (l_returnflag <> 'N') AS a, avg(l_quantity) FILTER (l_returnflag = 'N') AS p
  FROM lineitem GROUP BY ALL),
pairs AS (
  SELECT k, m, 'HDDS' AS measure, a / 5 AS actual, p / 5 AS predict FROM half
  UNION ALL SELECT k, m, 'rCSI', a - 21, p - 21 FROM half
  UNION ALL SELECT k, m, 'logFCS', ln(a * 1.6), ln(p * 1.6) FROM half)"""


def pairs(spark, sf):
    later = F.col("l_returnflag") == "N"
    half = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("k"), F.col("l_linenumber").alias("m")).agg(
        F.avg(F.when(~later, F.col("l_quantity"))).alias("a"), F.avg(F.when(later, F.col("l_quantity"))).alias("p"))
    def side(c):
        x = F.col(c)
        return [("HDDS", x / 5), ("rCSI", x - 21), ("logFCS", F.log(x * 1.6))]
    cells = [F.struct(F.lit(n).alias("measure"), a.alias("actual"), p.alias("predict")) for (n, a), (_, p) in zip(side("a"), side("p"))]
    return half.select("k", "m", F.explode(F.array(*cells)).alias("c")).select("k", "m", "c.*")


def _rank_sql(x: str) -> str:
    return f"""CASE WHEN {x} IS NULL THEN NULL
      WHEN measure = 'rCSI' THEN CASE WHEN {x} <= 4 THEN 1 WHEN {x} <= 17 THEN 2 WHEN {x} <= 42 THEN 3 ELSE 4 END
      WHEN {x} <= 0 THEN NULL
      WHEN measure = 'HDDS' THEN CASE WHEN {x} <= 3 THEN 1 WHEN {x} <= 6 THEN 2 ELSE 3 END
      ELSE CASE WHEN {x} <= ln(28::DOUBLE) THEN 1 WHEN {x} <= ln(42::DOUBLE) THEN 2 ELSE 3 END END"""


_NAMES = {m: ev.labels(m) for m in ("logFCS", "HDDS", "rCSI")}
_NAME_ROWS = ", ".join(f"('{m}', {i}, '{n}')" for m, ns in _NAMES.items() for i, n in enumerate(ns, 1))
_RANKED = f"""{_PAIR_SQL}, names(measure, rk, label) AS (VALUES {_NAME_ROWS}),
ranked AS (SELECT *, {_rank_sql('predict')} AS rp, {_rank_sql('actual')} AS ra FROM pairs)"""


def _by_measure(fn, df):
    return reshape.union_by_name(*[
        fn(df.filter(F.col("measure") == m), m).withColumn("measure", F.lit(m)) for m in ev.CUTS])


@query("categorise", f"""WITH {_RANKED} SELECT k, m, r.measure, a.label AS actual_class, p.label AS predict_class FROM ranked r
  LEFT JOIN names a ON a.measure = r.measure AND a.rk = ra LEFT JOIN names p ON p.measure = r.measure AND p.rk = rp""")
def categorise(spark, sf):
    return _by_measure(lambda d, m: d.select(
        "k", "m", ev.categorise("actual", m).alias("actual_class"), ev.categorise("predict", m).alias("predict_class")), pairs(spark, sf))


@query("confusion", f"""WITH {_RANKED} SELECT p.measure, p.label AS predicted, a.label AS actual, count(r.k) AS n
  FROM names p JOIN names a ON a.measure = p.measure LEFT JOIN ranked r ON r.measure = p.measure AND r.rp = p.rk AND r.ra = a.rk GROUP BY ALL""")
def confusion(spark, sf):
    def one(d, m):
        classed = d.select(ev.categorise("predict", m).alias("p"), ev.categorise("actual", m).alias("a"))
        return ev.confusion(classed, "p", "a", ev.labels(m))
    return _by_measure(one, pairs(spark, sf))


def _scored(spark, sf, *cols):
    out = _by_measure(lambda d, m: ev.score_classes(d, "predict", "actual", m), pairs(spark, sf))
    return rounded(out.select("measure", *cols), [c for c in cols if c != "pairs"])


@query("accuracy", f"""WITH {_RANKED} SELECT measure, round(avg(CAST(rp = ra AS DOUBLE)), 6) AS accuracy, count(*) AS pairs FROM ranked WHERE rp IS NOT NULL AND ra IS NOT NULL GROUP BY measure""")
def accuracy(spark, sf):
    return _scored(spark, sf, "accuracy", "pairs")


@query("recall", f"""WITH {_RANKED} SELECT measure, round(count(*) FILTER (rp = 2) / CAST(nullif(count(*) FILTER (CASE WHEN measure = 'rCSI' THEN rp IN (1, 2) ELSE rp IN (2, 3) END), 0) AS DOUBLE), 6) AS recall
  FROM ranked WHERE ra = 2 AND rp IS NOT NULL GROUP BY measure""")
def recall(spark, sf):
    return _scored(spark, sf, "recall")


@query("type_errors", f"""WITH {_RANKED}, s AS (SELECT *, CASE WHEN measure = 'rCSI' THEN -1 ELSE 1 END AS dir FROM ranked WHERE rp IS NOT NULL AND ra IS NOT NULL)
  SELECT measure, round(avg(CAST(rp * dir < ra * dir AS DOUBLE)), 6) AS type1, round(avg(CAST(rp * dir > ra * dir AS DOUBLE)), 6) AS type2 FROM s GROUP BY measure""")
def type_errors(spark, sf):
    return _scored(spark, sf, "type1", "type2")


@query("confusion_agg", f"""WITH {_RANKED}, t AS (SELECT measure, CASE WHEN rp = CASE WHEN measure = 'rCSI' THEN 1 ELSE 3 END THEN 'secure' ELSE 'insecure' END AS p,
    CASE WHEN ra = CASE WHEN measure = 'rCSI' THEN 1 ELSE 3 END THEN 'secure' ELSE 'insecure' END AS a FROM ranked WHERE rp IS NOT NULL AND ra IS NOT NULL),
  lab(l) AS (VALUES ('secure'), ('insecure')), ms AS (SELECT DISTINCT measure FROM names)
  SELECT ms.measure, x.l AS predicted, y.l AS actual, count(t.p) AS n FROM ms CROSS JOIN lab x CROSS JOIN lab y
  LEFT JOIN t ON t.measure = ms.measure AND t.p = x.l AND t.a = y.l GROUP BY ALL""")
def confusion_agg(spark, sf):
    return _by_measure(lambda d, m: ev.aggregate_confusion(d, "predict", "actual", m), pairs(spark, sf))


@query("rmse_r2", f"""WITH {_PAIR_SQL}, b AS (SELECT *, CASE WHEN actual IS NOT NULL AND predict IS NOT NULL THEN actual END AS a2, CASE WHEN actual IS NOT NULL AND predict IS NOT NULL THEN predict END AS p2 FROM pairs)
  SELECT measure, round(sqrt(sum(pow(p2 - a2, 2)) / count(p2)), 6) AS rmse, round(sqrt(sum(pow(p2 - a2, 2)) / count(*)), 6) AS rmse_all_rows, round(avg(abs(p2 - a2)), 6) AS mae,
    round(1 - sum(pow(p2 - a2, 2)) / (var_pop(a2) * count(a2)), 6) AS r2_sse, round(pow(corr(p2, a2), 2), 6) AS r2_corr FROM b GROUP BY measure""")
def rmse_r2(spark, sf):
    return rounded(ev.fit_errors(pairs(spark, sf), "predict", "actual", ["measure"]), ["rmse", "rmse_all_rows", "mae", "r2_sse", "r2_corr"])


@query("over_under", f"""WITH {_PAIR_SQL} SELECT measure, count(*) FILTER (predict > actual) AS over, count(*) FILTER (predict < actual) AS under FROM pairs GROUP BY measure""")
def over_under(spark, sf):
    return ev.over_under(pairs(spark, sf), "predict", "actual", ["measure"])


@query("naive_baseline", f"""WITH {_RANKED} SELECT measure, round(avg(CAST(ra = CASE WHEN measure = 'HDDS' THEN 2 WHEN measure = 'logFCS' THEN 3 ELSE 1 END AS DOUBLE)), 6) AS accuracy, count(*) AS pairs
  FROM ranked WHERE ra IS NOT NULL GROUP BY measure""")
def naive_baseline(spark, sf):
    out = _by_measure(lambda d, m: ev.score_classes(d.withColumn("naive", F.lit(ev.NAIVE[m])), "naive", "actual", m), pairs(spark, sf))
    return rounded(out.select("measure", "accuracy", "pairs"), ["accuracy"])


@query("error_region", f"""WITH {_PAIR_SQL}, c AS (SELECT *, CASE measure WHEN 'logFCS' THEN ln(42::DOUBLE) WHEN 'HDDS' THEN 6 ELSE 4 END AS cut FROM pairs WHERE actual IS NOT NULL AND predict IS NOT NULL)
  SELECT k, m, measure, CASE WHEN actual <= cut AND predict > cut THEN CASE WHEN measure = 'rCSI' THEN 'IV' ELSE 'I' END
    WHEN actual > cut AND predict <= cut THEN CASE WHEN measure = 'rCSI' THEN 'I' ELSE 'IV' END
    WHEN predict = actual THEN NULL
    ELSE CASE WHEN (predict > actual) = (measure <> 'rCSI') THEN 'II' ELSE 'III' END || CASE WHEN actual <= cut THEN 'a' ELSE 'b' END END AS area FROM c""")
def error_region(spark, sf):
    known = pairs(spark, sf).dropna(subset=["actual", "predict"])
    return _by_measure(lambda d, m: d.select("k", "m", ev.error_region("predict", "actual", m).alias("area")), known)


@query("result_matrix", """WITH t AS (SELECT CASE l_returnflag WHEN 'A' THEN 'logFCS' WHEN 'N' THEN 'HDDS' ELSE 'rCSI' END AS measure, CASE l_linenumber % 3 WHEN 0 THEN 'Cluster' WHEN 1 THEN 'TA' ELSE 'IPC zone' END AS level,
    concat('Model ', l_linenumber % 3 + 1) AS model, CASE l_linestatus WHEN 'F' THEN 'tail' ELSE 'full' END AS sample, l_quantity FROM lineitem)
  SELECT measure, level, model, sample, round(avg(l_quantity), 6) AS value FROM t GROUP BY ALL""")
def result_matrix(spark, sf):
    n = F.col("l_linenumber") % 3
    key = F.concat_ws(
        "_", F.when(F.col("l_returnflag") == "A", "logFCS").when(F.col("l_returnflag") == "N", "HDDS").otherwise("rCSI"),
        F.when(n == 0, "clust").when(n == 1, "TA").otherwise("lhz"), F.concat(F.lit("m"), (n + 1).cast("string")),
        F.when(F.col("l_linestatus") == "F", "tail"))
    keyed = table(spark, sf, "lineitem").groupBy(key.alias("key")).agg(F.avg("l_quantity").alias("value"))
    return rounded(ev.result_matrix(keyed, "key"), ["value"])


_N = 64


@query("kde", f"""WITH s AS (SELECT l_returnflag AS f, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n,
    0.9::DOUBLE * least(stddev_samp(l_extendedprice), (quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)) / 1.34::DOUBLE) * pow(count(*)::DOUBLE, -0.2::DOUBLE) AS bw FROM lineitem GROUP BY ALL),
  g AS (SELECT *, lo - 3 * bw AS x0, (hi - lo + 6 * bw) / {_N - 1} AS step FROM s),
  pl AS (SELECT f, (l_extendedprice - x0) / step AS pos FROM lineitem JOIN g ON f = l_returnflag),
  w AS (SELECT f, j, sum(wt) AS wt FROM (SELECT f, floor(pos) AS j, 1 - (pos - floor(pos)) AS wt FROM pl UNION ALL SELECT f, floor(pos) + 1, pos - floor(pos) FROM pl) GROUP BY ALL),
  d AS (SELECT g.f, i, x0 + i * step AS x, sum(wt * exp(-0.5::DOUBLE * pow((i - j) * step / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())) AS dens
    FROM g CROSS JOIN range(0, {_N}) r(i) JOIN w ON w.f = g.f GROUP BY g.f, i, x0, step)
  SELECT f, CAST(i AS INTEGER) AS i, round(x, 4) AS x, round(dens * 1000, 9) AS density, round(dens / max(dens) OVER (PARTITION BY f), 6) AS scaled FROM d""")
def kde(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("f"), "l_extendedprice")
    out = ev.kde(li, "l_extendedprice", ["f"], _N)
    return out.select("f", "i", F.round("x", 4).alias("x"), F.round(F.col("density") * 1000, 9).alias("density"), F.round("scaled", 6).alias("scaled"))


@query("histogram", "SELECT l_returnflag, floor(l_extendedprice / 5000.0::DOUBLE) * 5000.0::DOUBLE AS edge, count(*) AS n FROM lineitem GROUP BY ALL")
def histogram(spark, sf):
    return ev.histogram(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"], 5000.0)


@query("monthly_profile", """WITH u AS (SELECT CAST(month(l_shipdate) AS INTEGER) AS mo, 'l_quantity' AS measure, l_quantity AS v FROM lineitem UNION ALL SELECT CAST(month(l_shipdate) AS INTEGER), 'l_tax', l_tax FROM lineitem)
  SELECT mo, measure, round(avg(v), 6) AS mean FROM u GROUP BY ALL""")
def monthly_profile(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("mo", F.month("l_shipdate"))
    return rounded(ev.monthly_profile(li, ["mo"], ["l_quantity", "l_tax"]), ["mean"])


@query("phase_crosstab", f"""WITH {PHASE_SQL}, c AS (SELECT phase, CASE WHEN v <= 3 THEN 'Low Diversity' WHEN v <= 6 THEN 'Medium Diversity' ELSE 'Good Diversity' END AS class
    FROM (SELECT s.phase, n.n / 3.0::DOUBLE AS v FROM snaps s JOIN nm n ON n.zone = s.zone AND n.month = s.month))
  SELECT phase, class, count(*) AS n FROM c GROUP BY ALL""")
def phase_crosstab(spark, sf):
    both = phases(spark, sf).join(nation_month(spark, sf).select("zone", "month", (F.col("n") / 3).alias("v")), ["zone", "month"])
    return ev.phase_crosstab(both, "phase", "v", "HDDS")


