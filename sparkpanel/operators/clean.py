"""Row-wise cleaning: recodes, sentinels, clipping, patches, group-mean fills."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpanel.operators.aggregates import attach

# Upper bounds of all classes but the last, closed on the right, and the class
# from whose side on a household counts as insecure.
CLASS_BOUNDS = {"logFCS": (math.log(28), math.log(42)), "HDDS": (3.0, 6.0), "rCSI": (4.0, 17.0, 42.0)}
INSECURE = {"logFCS": ("below", 1), "HDDS": ("below", 1), "rCSI": ("above", 0)}


def across(df: DataFrame, cols: Iterable[str], fn: Callable[[Column], Column], prefix: str = "", suffix: str = "") -> DataFrame:
    """Apply ``fn`` to each column, in place unless a prefix or suffix is given."""
    return df.withColumns({f"{prefix}{c}{suffix}": fn(F.col(c)) for c in cols})


def select_prefix(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return df.select(*keys, *[c for c in df.columns if c.startswith(prefix) and c not in keys])


def recode(df: DataFrame, col: str, mapping: Mapping, into: str | None = None, default=None, keep: bool = False) -> DataFrame:
    """Replace values by a table; others become ``default``, or stay when ``keep``."""
    groups: dict = {}
    for old, new in mapping.items():
        groups.setdefault(new, []).append(old)
    other = F.col(col) if keep else F.lit(default)
    expr = reduce(
        lambda acc, item: acc.when(F.col(col).isin(item[1]), F.lit(item[0])), groups.items(), F
    ).otherwise(other)
    return df.withColumn(into or col, expr)


def null_sentinels(df: DataFrame, codes: Mapping[str, list]) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).isin(bad), F.col(c)) for c, bad in codes.items()})


def clip(df: DataFrame, col: str, lo=None, hi=None, stata_missing: bool = False) -> DataFrame:
    """Bound a column. Null stays null; with ``stata_missing`` a null counts as above ``hi``."""
    x = F.col(col)
    bounded = x
    if lo is not None:
        bounded = F.greatest(bounded, F.lit(lo))
    if hi is not None:
        bounded = F.least(bounded, F.lit(hi))
    above = F.lit(hi) if stata_missing and hi is not None else F.lit(None)
    return df.withColumn(col, F.when(x.isNull(), above).otherwise(bounded))


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def zscore(df: DataFrame, cols: list[str], suffix: str = "_z") -> DataFrame:
    """Standard scores with the sample deviation, moments taken in one aggregate."""
    stats = df.agg(
        *[F.avg(c).alias(f"{c}_m") for c in cols], *[F.stddev_samp(c).alias(f"{c}_s") for c in cols]
    ).first()
    return df.withColumns({
        c + suffix: (F.col(c) - F.lit(stats[f"{c}_m"])) / F.nullif(F.lit(stats[f"{c}_s"]), F.lit(0.0)) for c in cols
    })


def override(df: DataFrame, key: list[str], patch: DataFrame) -> DataFrame:
    """Replace cells by key where ``patch`` has a value; the patch is unique per key."""
    cols = [c for c in patch.columns if c not in key]
    renamed = patch.withColumnsRenamed({c: f"_p_{c}" for c in cols})
    out = df.join(renamed, key, "left")
    return out.withColumns({c: F.coalesce(f"_p_{c}", c) for c in cols}).select(*df.columns)


def insecure_side(col: str | Column, measure: str) -> Column:
    """Predicate for the rows on the insecure side of a measure's threshold."""
    x = F.col(col) if isinstance(col, str) else col
    side, i = INSECURE[measure]
    bound = CLASS_BOUNDS[measure][i]
    return x < bound if side == "below" else x > bound


def tail(df: DataFrame, col: str, measure: str) -> DataFrame:
    return df.filter(insecure_side(col, measure))


def group_mean_fill(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Null to the mean of its group. Means are aggregated, then joined back."""
    means = df.groupBy(*by).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
    out = attach(df, means, by)
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), f"_m_{c}") for c in cols}).select(*df.columns)


def stata_over(col: str | Column, bound) -> Column:
    """``x > bound`` where a missing value counts as larger than any number."""
    x = F.col(col) if isinstance(col, str) else col
    return x.isNull() | (x > bound)
