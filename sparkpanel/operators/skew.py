"""Ordered numbering and order statistics that survive a hot group.

A window over a group runs in one task. Panels (one row per entity and period) are
bounded by the calendar, raw observations are not. Here rows are cut into ranges of the
whole sort key, so that a group of any size, with any ties, is spread over as many tasks
as it needs; a row's number is its place in its range plus the rows of the ranges before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkpanel.session import cut_lineage


def match_keys(left: DataFrame, right: DataFrame, by: list[str], how: str = "left") -> DataFrame:
    """Join on ``by`` with null keys matching null keys; the left's key columns stay."""
    keyed = right.withColumnsRenamed({k: f"_k_{k}" for k in by})
    cond = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by]
    return left.join(keyed, cond, how).drop(*[f"_k_{k}" for k in by])


def ordinal(df: DataFrame, by: list[str], order: list[str], name: str = "rn") -> DataFrame:
    """Row number 1..n (long) inside ``by`` in ascending ``order``, nulls first, any group size.

    Rows that tie in ``order`` are numbered in no stated order. The rows with their
    ranges are written out first, as the cut is drawn from a sample.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(width, *by, *order, "_tie")
    cut = cut_lineage(ranged.withColumn("_cut", F.spark_partition_id()))
    before = Window.partitionBy(*by).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row for each group and range.
    offsets = cut.groupBy(*by, "_cut").agg(F.count(F.lit(1)).alias("_size")).select(
        *by, "_cut", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(*by, "_cut").orderBy(*order, "_tie")
    return match_keys(cut, offsets, [*by, "_cut"], "inner").withColumn(
        name, F.row_number().over(inside).cast("long") + F.col("_offset")
    ).drop("_cut", "_offset", "_tie")


#: Accuracy of the sketch that brackets a rank, and how many of its errors the bracket allows for.
SKETCH, MARGIN = 1000, 5
#: Groups up to this size are taken whole.
WHOLE = 2000


def _brackets(rows: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """For each group its known values and, for each probability, two values with the wanted ranks between them.

    The sketch is mergeable, so a group of any size is summed up in each task; the ranks of
    its answers are off by a thousandth of the group at most.
    """
    edges = [min(1.0, max(0.0, p + side * MARGIN / SKETCH)) for p in probs for side in (-1, 1)]
    sketched = rows.groupBy(*keys).agg(F.count("_v").alias("_n"), F.percentile_approx("_v", edges, SKETCH).alias("_e"))
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    spots = [
        F.struct(
            F.lit(i).alias("q"), ((F.col("_n") - 1) * F.lit(float(p)) + 1).alias("h"),
            F.when((F.col("_n") > WHOLE) & F.lit(edges[2 * i] > 0), F.col("_e")[2 * i]).otherwise(low).alias("low"),
            F.when((F.col("_n") > WHOLE) & F.lit(edges[2 * i + 1] < 1), F.col("_e")[2 * i + 1]).otherwise(high).alias("high"),
        ) for i, p in enumerate(probs)
    ]
    return sketched.select(*keys, "_n", F.array(*spots).alias("_spots"))


def group_quantiles(df: DataFrame, by: list[str], col: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group, nulls and NaN skipped; one column per named probability.

    A sketch of each group brackets the wanted ranks. A second pass counts what lies below a
    bracket and each distinct value inside it, in each task first, so only the few values
    inside the brackets are shuffled and sorted. Groups without a known value get nulls;
    null keys form a group, and keys may have any name.
    """
    from sparkpanel.operators.segments import scan

    keys = [f"_k{i}" for i in range(len(by))]
    value = F.nanvl(F.col(col).cast("double"), F.lit(None))
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(by, keys, strict=True)], value.alias("_v"))
    brackets = _brackets(rows, keys, list(probs.values()))
    met = match_keys(rows.filter("_v is not null"), brackets.select(*keys, "_spots"), keys, "inner")
    # A row above a bracket has no part in it, one below has its count alone.
    spots = met.select(*keys, "_v", F.explode(F.filter("_spots", lambda s: s["high"] >= F.col("_v"))).alias("_s"))
    counted = spots.groupBy(*keys, F.col("_s.q").alias("_q"), F.when(F.col("_v") >= F.col("_s.low"), F.col("_v")).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"), F.first("_s.h").alias("_h")
    )
    ranked = scan(counted, [*keys, "_q"], "_v", {"_upto": ("sum", F.col("_c"))})
    at = lambda h: F.min(F.when(F.col("_upto") >= h, F.struct(F.col("_upto").alias("u"), F.col("_v").alias("v"))))
    picked = ranked.groupBy(*keys, "_q").agg(at(F.floor("_h")).alias("_a"), at(F.ceil("_h")).alias("_b"), F.max("_h").alias("_h"))
    a, b = F.col("_a.v"), F.col("_b.v")
    missed = a.isNull() | b.isNull()
    between = a + (F.col("_h") - F.floor("_h")) * (b - a)
    exact = F.when(missed, F.raise_error(F.lit("a wanted rank lies outside its bracket")).cast("double")).otherwise(F.when(a == b, a).otherwise(between))
    values = picked.select(*keys, "_q", exact.alias("_v"))
    wide = values.groupBy(*keys).agg(*[F.max(F.when(F.col("_q") == i, F.col("_v"))).alias(f"_p{i}") for i in range(len(probs))])
    out = match_keys(brackets.select(*keys), wide, keys)
    return out.select(*[F.col(n).alias(k) for k, n in zip(by, keys, strict=True)], *[F.col(f"_p{i}").alias(n) for i, n in enumerate(probs)])


def group_median(df: DataFrame, by: list[str], col: str, name: str = "median") -> DataFrame:
    return group_quantiles(df, by, col, {name: 0.5})
