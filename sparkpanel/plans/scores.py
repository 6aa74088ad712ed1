"""Household survey scores: consumption, diversity, coping, provisioning, assets."""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpanel.operators.dedup import top_k

# Food group weights (A and B counted together as AB), groups outside
# the diversity score, item codes of the later round, coping weights, asset codes.
FCS_WEIGHTS = {
    "AB": 2.0, "C": 3.0, "D": 1.0, "E": 4.0, "F": 1.0, "G": 4.0, "H": 0.5, "I": 0.5, "J": 0.0,
}
NOT_IN_DIVERSITY = ("I", "J")
NUMERIC_GROUPS = {1: "A", 2: "B", 3: "C", 4: "D", 5: "E", 6: "F", 7: "G", 8: "H", 9: "I", 10: "J"}
COPING_WEIGHTS = (1, 1, 2, 2, 2)
ASSET_CODES = (507, 509, 514, 516, 517, 518)


def group_days(items: DataFrame, hh: str, group: str, days: str) -> DataFrame:
    """Largest number of days per (household, food group), 8 taken as 7, A and B as AB."""
    merged = F.when(F.col(group).isin("A", "B"), "AB").otherwise(F.col(group))
    capped = F.when(F.col(days) == 8, 7).otherwise(F.col(days))
    return items.select(F.col(hh), merged.alias("_grp"), capped.alias("_days")).groupBy(hh, "_grp").agg(
        F.max("_days").alias("_days")
    )


def letter_groups(items: DataFrame, code: str, into: str) -> DataFrame:
    """Letters for the numeric food group codes of the later survey round."""
    pairs = [F.lit(p) for kv in NUMERIC_GROUPS.items() for p in kv]
    return items.withColumn(into, F.try_element_at(F.create_map(*pairs), F.col(code).cast("int")))


def food_scores(items: DataFrame, hh: str, group: str, days: str) -> DataFrame:
    """FCS and HDDS of each household from one grouping of its items."""
    pairs = [F.lit(p) for kv in FCS_WEIGHTS.items() for p in kv]
    weight = F.try_element_at(F.create_map(*pairs), F.col("_grp"))
    eaten = (~F.col("_grp").isin(*NOT_IN_DIVERSITY)) & (F.col("_days") >= 1)
    return group_days(items, hh, group, days).groupBy(hh).agg(F.sum(weight * F.col("_days")).alias("FCS"), F.count_if(eaten).alias("HDDS"))


def food_consumption_score(items: DataFrame, hh: str, group: str, days: str) -> DataFrame:
    return food_scores(items, hh, group, days).select(hh, "FCS")


def dietary_diversity(items: DataFrame, hh: str, group: str, days: str) -> DataFrame:
    return food_scores(items, hh, group, days).select(hh, "HDDS")


def coping_index(
    df: DataFrame, cols: list[str], weights=COPING_WEIGHTS, cap: int = 42, name: str = "rCSI", stata_missing: bool = False
) -> DataFrame:
    """Weighted sum of answers capped; with ``stata_missing`` a missing sum is the cap."""
    total = sum((F.col(c) * w for c, w in zip(cols, weights)), F.lit(0))
    empty = F.lit(cap) if stata_missing else F.lit(None)
    return df.withColumn(name, F.when(total.isNull(), empty).otherwise(F.least(total, F.lit(cap))))


def months_adequate(df: DataFrame, month_cols: list[str], gate: str, name: str = "MAHFP") -> DataFrame:
    """12 minus the months marked X, marks counting only where the gate answer is 1."""
    marked = sum(
        (F.coalesce((F.col(c) == "X") & (F.col(gate) == 1), F.lit(False)).cast("int") for c in month_cols), F.lit(0)
    )
    return df.withColumn(name, F.lit(12) - marked)


def rank_reasons(df: DataFrame, cols: list[str], top: int = 3) -> DataFrame:
    """Most frequent codes of each answer column: (question, rank, reason, n)."""
    long = df.select(*cols).unpivot([], cols, "question", "reason").filter(F.col("reason").isNotNull())
    counts = long.groupBy("question", "reason").agg(F.count(F.lit(1)).alias("n"))
    return top_k(counts, ["question"], [F.desc("n"), F.asc("reason")], top)


def asset_dummies(items: DataFrame, hh: str, code: str, qty: str, codes=ASSET_CODES) -> DataFrame:
    """1 per asset code when the household's summed quantity differs from 0."""
    cols = [
        F.coalesce((F.sum(F.when(F.col(code) == c, F.col(qty))) != 0).cast("int"), F.lit(0)).alias(f"asset_{c}")
        for c in codes
    ]
    return items.groupBy(hh).agg(*cols)


def _varimax(loadings: np.ndarray, rounds: int = 100, tol: float = 1e-10) -> np.ndarray:
    """Orthogonal rotation of a small loading matrix; returns the rotation."""
    p, m = loadings.shape
    rotation, last = np.eye(m), 0.0
    for _ in range(rounds):
        lam = loadings @ rotation
        u, s, vt = np.linalg.svd(loadings.T @ (lam**3 - lam * (lam**2).sum(axis=0) / p))
        rotation = u @ vt
        if s.sum() - last < tol:
            break
        last = s.sum()
    return rotation


def asset_index(df: DataFrame, cols: list[str], name: str = "asset_index", factors: int = 2, rotate: bool = True) -> DataFrame:
    """First component score of the correlation matrix, rotated over ``factors`` components.

    One aggregate gives the means, a second the cross-products about them; only that p x p
    matrix is decomposed on the driver. The largest loading is made positive.
    """
    known = df.dropna(subset=cols).select(*[F.col(c).cast("double").alias(c) for c in cols])
    first = known.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{t}{i}") for i, c in enumerate(cols) for t, f in (("m", F.avg), ("lo", F.min), ("hi", F.max))]).first()
    # A constant column has no deviation, whatever rounding leaves between it and its mean.
    kept = [i for i in range(len(cols)) if first["n"] > 1 and first[f"lo{i}"] != first[f"hi{i}"]]
    off = {i: F.col(cols[i]) - F.lit(first[f"m{i}"]) for i in kept}
    sums = known.agg(F.lit(0), *[F.sum(off[i] * off[j]).alias(f"c{i}_{j}") for i, j in combinations_with_replacement(kept, 2)]).first()
    kept = [i for i in kept if sums[f"c{i}_{i}"] != 0]
    if not kept:
        return df.withColumn(name, F.lit(None).cast("double"))
    stats = {f"m{i}": first[f"m{i}"] for i in kept} | {f"s{i}": float(np.sqrt(sums[f"c{i}_{i}"] / (first["n"] - 1))) for i in kept}
    corr = np.array([[1.0 if i == j else sums[f"c{min(i, j)}_{max(i, j)}"] / np.sqrt(sums[f"c{i}_{i}"] * sums[f"c{j}_{j}"]) for j in kept] for i in kept])
    values, vectors = np.linalg.eigh(corr)
    order = np.argsort(-values)[: max(1, min(factors, len(kept)))]
    loads = vectors[:, order] * np.sqrt(np.maximum(values[order], 0))
    scoring = vectors[:, order] / np.sqrt(np.maximum(values[order], 1e-12))
    if rotate and len(order) > 1:
        turn = _varimax(loads)
        loads, scoring = loads @ turn, scoring @ turn
    weight = scoring[:, 0] * (1 if loads[np.argmax(np.abs(loads[:, 0])), 0] > 0 else -1)
    score = sum(
        ((F.col(cols[i]) - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"]) * F.lit(float(w)) for i, w in zip(kept, weight)),
        F.lit(0.0),
    )
    return df.withColumn(name, score)


def land_share(code: str | Column) -> Column:
    """Cropland share by land cover code."""
    c = F.col(code) if isinstance(code, str) else code
    return F.when(c.isin(20, 30), F.lit(0.6)).when(c == 14, F.lit(1.0)).otherwise(F.lit(0.0))


def terrain_rough(code: str | Column, rough: tuple, strict_reference: bool = False) -> Column:
    """1 for the listed terrain codes; as published the conditions exclude each other and give 0."""
    c = F.col(code) if isinstance(code, str) else code
    return F.lit(0) if strict_reference else F.coalesce(c.isin(*rough), F.lit(False)).cast("int")


def nutrient_flags(code: str | Column) -> dict[str, Column]:
    """0/1 columns of the soil constraint classes."""
    c = F.col(code) if isinstance(code, str) else code
    names = {1: "no_constraint", 2: "moderate_constraint", 3: "severe_constraint"}
    return {f"nutri_{n}": F.coalesce(c == v, F.lit(False)).cast("int") for v, n in names.items()}


def region_fill(
    df: DataFrame, key: list[str], region: str, lat: str, labels: tuple[str, ...] = ("South", "Central", "North")
) -> DataFrame:
    """One region per key: the first non-empty label, else the latitude third of the unlabelled keys.

    Thirds have equal width between the lowest and highest mean latitude of the keys
    without a label, the range widened by a thousandth as in the usual binning.
    """
    labelled = F.when(F.col(region) != "", F.col(region))
    per_key = df.groupBy(*key).agg(F.min(labelled).alias("_label"), F.avg(lat).alias("_lat"))
    open_keys = per_key.filter(F.col("_label").isNull())
    lim = open_keys.agg(F.min("_lat").alias("lo"), F.max("_lat").alias("hi")).first()
    lo, hi = (lim["lo"] or 0.0), (lim["hi"] or 0.0)
    width = (hi - lo) / len(labels)
    third = F.lit(labels[-1])
    for i in range(len(labels) - 2, -1, -1):
        third = F.when(F.col("_lat") <= F.lit(lo + width * (i + 1)), F.lit(labels[i])).otherwise(third)
    return per_key.select(*key, F.coalesce("_label", F.when(F.col("_lat").isNotNull(), third)).alias(region))
