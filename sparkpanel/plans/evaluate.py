"""Class cuts, confusion tables, error rates, density data and result naming."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpanel.operators.clean import CLASS_BOUNDS
from sparkpanel.operators.skew import group_quantiles, match_keys

# Class labels in rank order, the open lower end of the first class, the side
# of the scale that is secure, and the constants used as naive predictions.
LABELS = {
    "logFCS": ("Poor", "Borderline", "Acceptable"), "HDDS": ("Low Diversity", "Medium Diversity", "Good Diversity"),
    "rCSI": ("Food Secure", "Mild", "Moderate", "Severe"),
}
LOWEST = {"logFCS": 0.0, "HDDS": 0.0, "rCSI": -math.inf}
CUTS = {m: (LOWEST[m], list(zip(names, (*CLASS_BOUNDS[m], math.inf)))) for m, names in LABELS.items()}
HIGH_IS_SECURE = {"logFCS": True, "HDDS": True, "rCSI": False}
NAIVE = {"HDDS": 4.0, "logFCS": math.log(50), "rCSI": 2.0}
MEASURE_NAMES = {"logFCS": "logFCS", "HDDS": "HDDS", "rCSI": "rCSI"}
LEVEL_NAMES = {"clust": "Cluster", "TA": "TA", "lhz": "IPC zone"}
MODEL_NAMES = {"m1": "Model 1", "m2": "Model 2", "m3": "Model 3"}


def labels(measure: str) -> list[str]:
    return [name for name, _ in CUTS[measure][1]]


def class_rank(col: str | Column, measure: str) -> Column:
    """1-based class number, bins closed on the right; null outside the bins."""
    x = F.col(col) if isinstance(col, str) else col
    lo, bins = CUTS[measure]
    expr = F.when(x.isNull() | F.isnan(x), F.lit(None).cast("int"))
    if lo > -math.inf:
        expr = expr.when(x <= lo, F.lit(None).cast("int"))
    for i, (_, hi) in enumerate(bins, 1):
        expr = expr.otherwise(F.lit(i)) if hi == math.inf else expr.when(x <= hi, F.lit(i))
    return expr


def categorise(col: str | Column, measure: str) -> Column:
    names = F.array(*[F.lit(n) for n in labels(measure)])
    return F.get(names, class_rank(col, measure) - 1)


def confusion(df: DataFrame, pred: str, actual: str, classes: list[str], by: list[str] | None = None) -> DataFrame:
    """Counts for every (predicted, actual) pair of classes, absent pairs as 0."""
    by = list(by or [])
    known = df.filter(F.col(pred).isin(classes) & F.col(actual).isin(classes))
    counts = known.groupBy(*by).agg(*[
        F.count_if((F.col(pred) == p) & (F.col(actual) == a)).alias(f"{i}_{j}")
        for i, p in enumerate(classes) for j, a in enumerate(classes)
    ])
    cells = [f"{i}_{j}" for i in range(len(classes)) for j in range(len(classes))]
    names = F.array(*[F.lit(c) for c in classes])
    at = F.split("_cell", "_")
    return counts.unpivot(by, cells, "_cell", "n").select(
        *by, F.get(names, at[0].cast("int")).alias("predicted"), F.get(names, at[1].cast("int")).alias("actual"), "n"
    )


def score_classes(df: DataFrame, pred: str, actual: str, measure: str, by: list[str] | None = None) -> DataFrame:
    """accuracy, type1, type2, recall of the insecure class, and pairs scored.

    type2: predicted more secure than actual; type1: less secure. Recall divides the
    hits of class 2 by class-2 actuals predicted 2 or 3 (1 or 2 where low is secure).
    """
    p, a = class_rank(pred, measure), class_rank(actual, measure)
    ranked = df.select(*(by or []), p.alias("_p"), a.alias("_a")).filter("_p IS NOT NULL AND _a IS NOT NULL")
    high = HIGH_IS_SECURE[measure]
    secure = F.col("_p") > F.col("_a") if high else F.col("_p") < F.col("_a")
    less = F.col("_p") < F.col("_a") if high else F.col("_p") > F.col("_a")
    hit = (F.col("_p") == 2) & (F.col("_a") == 2)
    base = F.col("_p").isin(*((2, 3) if high else (1, 2))) & (F.col("_a") == 2)
    return ranked.groupBy(*(by or [])).agg(
        F.avg((F.col("_p") == F.col("_a")).cast("double")).alias("accuracy"),
        F.avg(less.cast("double")).alias("type1"),
        F.avg(secure.cast("double")).alias("type2"),
        (F.count_if(hit) / F.nullif(F.count_if(base), F.lit(0))).alias("recall"),
        F.count(F.lit(1)).alias("pairs"),
    )


def score_measures(
    df: DataFrame, pred: str, actual: str, measure: str, by: list[str], measures: Sequence[str]
) -> DataFrame:
    """``score_classes`` and squared correlation of long pairs of several measures, in one aggregate."""

    def ranked(col: str) -> Column:
        expr = F
        for m in measures:
            expr = expr.when(F.col(measure) == m, class_rank(col, m))
        return expr

    low = F.col(measure).isin([m for m in measures if not HIGH_IS_SECURE[m]])
    both = F.col(pred).isNotNull() & F.col(actual).isNotNull()
    rows = df.select(
        *by, measure, F.when(both, F.col(pred)).alias("_x"), F.when(both, F.col(actual)).alias("_y"),
        ranked(pred).alias("_p"), ranked(actual).alias("_a"), F.when(low, -1).otherwise(1).alias("_dir"),
    )
    known = F.col("_p").isNotNull() & F.col("_a").isNotNull()
    more = F.col("_p") * F.col("_dir") > F.col("_a") * F.col("_dir")
    less = F.col("_p") * F.col("_dir") < F.col("_a") * F.col("_dir")
    near = F.col("_p").isin(2, 3) & (F.col("_dir") == 1) | F.col("_p").isin(1, 2) & (F.col("_dir") == -1)
    base = known & (F.col("_a") == 2) & near
    return rows.groupBy(*by, measure).agg(
        F.pow(F.corr("_x", "_y"), F.lit(2.0)).alias("r2"),
        F.avg(F.when(known, (F.col("_p") == F.col("_a")).cast("double"))).alias("accuracy"),
        F.avg(F.when(known, less.cast("double"))).alias("type1"),
        F.avg(F.when(known, more.cast("double"))).alias("type2"),
        (F.count_if(base & (F.col("_p") == 2)) / F.nullif(F.count_if(base), F.lit(0))).alias("recall"),
        F.count_if(known).alias("pairs"),
    )


def secure_side(rank: Column, measure: str) -> Column:
    """secure / insecure label of a class number."""
    last = len(labels(measure))
    ok = rank == last if HIGH_IS_SECURE[measure] else rank == 1
    return F.when(ok, "secure").when(rank.isNotNull(), "insecure")


def aggregate_confusion(df: DataFrame, pred: str, actual: str, measure: str) -> DataFrame:
    two = df.select(
        secure_side(class_rank(pred, measure), measure).alias("_p"), secure_side(class_rank(actual, measure), measure).alias("_a")
    )
    return confusion(two, "_p", "_a", ["insecure", "secure"])


def fit_errors(df: DataFrame, pred: str, actual: str, by: list[str] | None = None) -> DataFrame:
    """RMSE over complete pairs, the older RMSE over all rows, MAE, 1-SSE/SST and squared correlation."""
    both = F.col(pred).isNotNull() & F.col(actual).isNotNull()
    p, a = F.when(both, F.col(pred)), F.when(both, F.col(actual))
    sse = F.sum(F.pow(p - a, F.lit(2.0)))
    return df.groupBy(*(by or [])).agg(
        F.sqrt(sse / F.count(p)).alias("rmse"),
        F.sqrt(sse / F.count(F.lit(1))).alias("rmse_all_rows"),
        F.avg(F.abs(p - a)).alias("mae"),
        (1 - sse / F.nullif(F.var_pop(a) * F.count(a), F.lit(0.0))).alias("r2_sse"),
        F.pow(F.corr(p, a), F.lit(2.0)).alias("r2_corr"),
    )


def over_under(df: DataFrame, pred: str, actual: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(
        F.count_if(F.col(pred) > F.col(actual)).alias("over"), F.count_if(F.col(pred) < F.col(actual)).alias("under")
    )


def error_region(pred: str, actual: str, measure: str) -> Column:
    """Area of the actual-predicted plane relative to the security cut-off.

    I predicted secure though insecure, IV the reverse; II a too secure and III a too
    insecure prediction on the right side, a for the class below the cut-off in value
    and b for the one above. A perfect prediction has no area.
    """
    p, a = F.col(pred), F.col(actual)
    high = HIGH_IS_SECURE[measure]
    cut = {"logFCS": math.log(42), "HDDS": 6.0, "rCSI": 4.0}[measure]
    p_low, a_low = p <= cut, a <= cut
    above = F.when(a_low, "IIa").otherwise("IIb") if high else F.when(a_low, "IIIa").otherwise("IIIb")
    below = F.when(a_low, "IIIa").otherwise("IIIb") if high else F.when(a_low, "IIa").otherwise("IIb")
    crossing_up, crossing_down = ("I", "IV") if high else ("IV", "I")
    return (
        F.when(p.isNull() | a.isNull(), None)
        .when(a_low & ~p_low, crossing_up)
        .when(~a_low & p_low, crossing_down)
        .when(p > a, above)
        .when(p < a, below)
    )


def result_matrix(df: DataFrame, key: str) -> DataFrame:
    """Split ``measure_level_model[_tail]`` keys and relabel the parts."""
    parts = F.split(F.col(key), "_")

    def named(part: Column, table: dict[str, str]) -> Column:
        pairs = [F.lit(x) for kv in table.items() for x in kv]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), part), part)

    return df.withColumns({
        "measure": named(parts[0], MEASURE_NAMES), "level": named(parts[1], LEVEL_NAMES),
        "model": named(parts[2], MODEL_NAMES), "sample": F.when(F.size(parts) > 3, "tail").otherwise("full"),
    }).drop(key)


def kde(df: DataFrame, col: str, by: list[str], n: int = 512, cut: float = 3.0, scaled: bool = True) -> DataFrame:
    """Gaussian kernel density on n points per group: by, i, x, density[, scaled].

    The bandwidth is the normal reference rule, from the smaller of the deviation and
    the scaled quartile range, or the size of the value where all are alike. Values are first spread over the grid by linear weights,
    with partial aggregation, so the kernel sum runs over at most n weights per group
    whatever the number of rows.
    """
    stats = df.filter(F.col(col).isNotNull()).groupBy(*by).agg(
        F.min(col).alias("_lo"), F.max(col).alias("_hi"), F.stddev_samp(col).alias("_sd"),
        F.count(F.lit(1)).alias("_n"),
    )
    stats = match_keys(stats, group_quantiles(df, by, col, {"_q1": 0.25, "_q3": 0.75}), by)
    iqr = (F.col("_q3") - F.col("_q1")) / 1.34
    # Without spread the size of the value serves, and 1 for zeros.
    zero = F.lit(0.0)
    sigma = F.coalesce(F.nullif(F.when(iqr > 0, F.least("_sd", iqr)), zero), F.nullif("_sd", zero), F.nullif(F.abs("_lo").cast("double"), zero), F.lit(1.0))
    width = 0.9 * sigma * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    frame = stats.withColumn("_bw", width).withColumns({
        "_from": F.col("_lo") - cut * F.col("_bw"),
        "_step": (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_bw")) / (n - 1),
    }).select(*by, "_bw", "_from", "_step", "_n")
    placed = match_keys(df.filter(F.col(col).isNotNull()).select(*by, F.col(col).alias("_v")), frame, by, "inner").withColumn(
        "_at", (F.col("_v") - F.col("_from")) / F.col("_step")
    ).withColumn("_j", F.floor("_at").cast("int"))
    part = F.col("_at") - F.col("_j")
    spread = F.array(
        F.struct(F.col("_j").alias("j"), (1 - part).alias("w")), F.struct((F.col("_j") + 1).alias("j"), part.alias("w"))
    )
    weights = placed.select(*by, F.explode(spread).alias("_s")).groupBy(*by, F.col("_s.j").alias("_j")).agg(
        F.sum("_s.w").alias("_w")
    )
    binned = weights.groupBy(*by).agg(F.collect_list(F.struct("_j", "_w")).alias("_bins"))
    at = match_keys(frame, binned, by, "inner").select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    total = F.aggregate(
        "_bins", F.lit(0.0),
        lambda acc, b: acc + b["_w"] * F.exp(-0.5 * F.pow((F.col("i") - b["_j"]) * F.col("_step") / F.col("_bw"), F.lit(2.0))),
    )
    dens = total / (F.col("_n") * F.col("_bw") * math.sqrt(2 * math.pi))
    out = at.select(*by, "i", (F.col("_from") + F.col("i") * F.col("_step")).alias("x"), dens.alias("density"))
    if scaled:
        top = out.groupBy(*by).agg(F.max("density").alias("_top"))
        out = match_keys(out, top, by).withColumn("scaled", F.col("density") / F.col("_top")).drop("_top")
    return out


def histogram(df: DataFrame, col: str, by: list[str], width: float) -> DataFrame:
    """Counts per bin of fixed width, keyed by the lower bin edge."""
    edge = (F.floor(F.col(col) / F.lit(width)) * F.lit(width)).alias("edge")
    return df.filter(F.col(col).isNotNull()).groupBy(*by, edge).agg(F.count(F.lit(1)).alias("n"))


def monthly_profile(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Mean of each measure per group, long."""
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(by, cols, "measure", "value")
    return long.groupBy(*by, "measure").agg(F.avg("value").alias("mean"))


def phase_crosstab(df: DataFrame, phase: str, outcome: str, measure: str) -> DataFrame:
    """Counts of phase by outcome class."""
    return df.withColumn("class", categorise(outcome, measure)).filter(
        F.col(phase).isNotNull() & F.col("class").isNotNull()
    ).groupBy(phase, "class").agg(F.count(F.lit(1)).alias("n"))
