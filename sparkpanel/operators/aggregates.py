"""Grouped statistics. All are partial-aggregated before the shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkpanel.operators.skew import group_median, match_keys


def _numeric(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def attach(df: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """Left join of per-group statistics, null keys matching null keys."""
    return match_keys(df, stats, by)


def sum_strict(col: str | Column) -> Column:
    """Sum that is null as soon as one member is null."""
    return F.when(F.count(col) == F.count(F.lit(1)), F.sum(col))


def collapse_mean(df: DataFrame, by: list[str], exclude: Iterable[str] = ()) -> DataFrame:
    """Mean of every numeric column per group, nulls skipped."""
    cols = _numeric(df, [*by, *exclude])
    return df.groupBy(*by).agg(*[F.avg(c).alias(c) for c in cols])


def collapse(df: DataFrame, by: list[str], spec: Mapping[str, list[str]]) -> DataFrame:
    """``{"mean": [...], "sum": [...], ...}`` in one aggregate, names kept."""
    fns = {
        "mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min, "sd": F.stddev_samp,
        "count": F.count, "sum_strict": sum_strict,
    }
    return df.groupBy(*by).agg(*[fns[fn](c).alias(c) for fn, cols in spec.items() for c in cols])


def mode_strict(df: DataFrame, by: list[str], col: str, name: str = "mode") -> DataFrame:
    """Most frequent non-null value, null when several share the top count."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.groupBy(*by).agg(
        F.max(F.struct("_n", col)).alias("_hi"), F.min(F.struct((-F.col("_n")).alias("_neg"), col)).alias("_lo")
    )
    hi, lo = F.col(f"_hi.{col}"), F.col(f"_lo.{col}")
    return attach(df.select(*by).distinct(), top, by).select(*by, F.when(hi == lo, hi).alias(name))


def profile(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Mean, median, sd, min, max per (group, variable)."""
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(by, cols, "var", "value")
    moments = long.groupBy(*by, "var").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    medians = group_median(long, [*by, "var"], "value")
    return attach(moments, medians, [*by, "var"])


def freq(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Counts with one column per value, absent pairs as 0."""
    return df.groupBy(row).agg(*[F.count_if(F.col(col) == v).alias(f"{col}_{v}") for v in values])


def null_census(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def row_total(cols: list[str]) -> Column:
    """Sum across columns, a null counting as 0."""
    return sum((F.coalesce(F.col(c), F.lit(0)) for c in cols), F.lit(0))


def row_mean(cols: list[str]) -> Column:
    """Mean across the non-null columns."""
    known = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return row_total(cols) / F.nullif(known, F.lit(0))


def weighted_agg(
    df: DataFrame, by: list[str], value: str, weight: str | None = None, name: str | None = None, strict: bool = True
) -> DataFrame:
    """Sum of weight times value, or the plain mean without weights.

    ``strict``: the group is null when a member value is null.
    """
    if weight is None:
        known = F.when(F.count(value) == F.count(F.lit(1)), F.avg(value)) if strict else F.avg(value)
        return df.groupBy(*by).agg(known.alias(name or value))
    term = F.col(value) * F.col(weight)
    return df.groupBy(*by).agg((sum_strict(term) if strict else F.sum(term)).alias(name or value))


def share(df: DataFrame, by: list[str], col: str, name: str = "share") -> DataFrame:
    """Part of the group total; 0 for null parts and empty totals, 1 for a lone member."""
    totals = df.groupBy(*by).agg(F.sum(col).alias("_total"), F.count(F.lit(1)).alias("_members"))
    part = F.coalesce(F.try_divide(F.col(col).cast("double"), F.col("_total")), F.lit(0.0))
    return (
        attach(df, totals, by)
        .withColumn(name, F.when(F.col("_members") == 1, F.lit(1.0)).otherwise(part))
        .drop("_total", "_members")
    )


def r2(df: DataFrame, pred: str, actual: str, by: list[str] | None = None, digits: int | None = 3) -> DataFrame:
    """Squared Pearson correlation over complete pairs."""
    pairs = df.filter(F.col(pred).isNotNull() & F.col(actual).isNotNull())
    value = F.pow(F.corr(pred, actual), F.lit(2.0))
    value = F.round(value, digits) if digits is not None else value
    return pairs.groupBy(*(by or [])).agg(value.alias("r2"))


def multi_level(df: DataFrame, levels: Mapping[str, list[str]], time: list[str], cols: list[str]) -> DataFrame:
    """Means of ``cols`` at several levels in one pass over the input.

    Long result: level, the key columns (null where not part of the level), time, means.
    """
    keys = list(dict.fromkeys(k for ks in levels.values() for k in ks))
    sets = [[*ks, *time] for ks in levels.values()]
    marks = [F.grouping(k).alias(f"_g_{k}") for k in keys]
    wide = df.groupingSets(
        [[F.col(c) for c in s] for s in sets], *keys, *time
    ).agg(*[F.avg(c).alias(c) for c in cols], *marks)
    label = F.lit(None).cast("string")
    for name, ks in levels.items():
        hit = F.lit(True)
        for k in keys:
            hit = hit & (F.col(f"_g_{k}") == (0 if k in ks else 1))
        label = F.when(hit, F.lit(name)).otherwise(label)
    return wide.withColumn("level", label).select("level", *keys, *time, *cols)
