"""First row per key, duplicate groups, top-k. Ranks are cut per task before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkpanel.operators.aggregates import attach


def first_per_key(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """Row with the smallest ``order`` in each group."""
    return top_k(df, by, order, 1).drop("rank")


def top_k(df: DataFrame, by: list[str], order: list, k: int, name: str = "rank") -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def dup_split(df: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of groups with one member, and rows of groups with several."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    sized = attach(df, sizes, by)
    return sized.filter("_n = 1").drop("_n"), sized.filter("_n > 1").drop("_n")


def argmin(df: DataFrame, by: list[str], what: str, value: str, tie: str) -> DataFrame:
    """``what`` at the smallest ``value``, ties to the smallest ``tie``."""
    return df.groupBy(*by).agg(
        F.min_by(what, F.struct(value, tie)).alias(what), F.min(value).alias(value)
    )
