"""Joins with the merge semantics of statistical packages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkpanel.operators.segments import MOST, any_large, scan
from sparkpanel.operators.skew import ordinal
from sparkpanel.session import cut_lineage


class KeyNotUnique(ValueError):
    """A merge key that must be unique is not."""


def natural_join(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on every column the two sides share."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no shared columns to join on")
    return left.join(right, shared, how)


def full_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join on panels that are unique per key on both sides."""
    return left.join(right, on, "full")


def merge_flag(left: DataFrame, right: DataFrame, on: list[str], flag: str = "_merge") -> DataFrame:
    """Outer merge with a source mark: 1 left only, 2 right only, 3 both.

    Written as left join plus right-only rows, because adaptive skew handling splits
    a hot key in left and anti joins but not in full joins.
    """
    marked = right.withColumn("_r", F.lit(1))
    both = left.join(marked, on, "left").withColumn(
        flag, F.when(F.col("_r").isNull(), 1).otherwise(3)
    ).drop("_r")
    only_right = right.join(left.select(*on).distinct(), on, "left_anti").withColumn(flag, F.lit(2))
    return both.unionByName(only_right, allowMissingColumns=True)


def assert_unique(df: DataFrame, on: list[str], side: str) -> None:
    """Raise when a key value occurs twice; stops at the first one found."""
    twice = df.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    bad = twice.limit(1).collect()
    if bad:
        raise KeyNotUnique(f"{side} side is not unique on {on}: {bad[0].asDict()}")


def merge_checked(left: DataFrame, right: DataFrame, on: list[str], cardinality: str = "m:1", how: str = "left") -> DataFrame:
    """Equi join that fails when a side marked 1 has a repeated key."""
    l_card, r_card = cardinality.split(":")
    if l_card == "1":
        assert_unique(left, on, "left")
    if r_card == "1":
        assert_unique(right, on, "right")
    return left.join(right, on, how)


def merge_mm(
    left: DataFrame, right: DataFrame, on: list[str], order_left: list[str], order_right: list[str], most: int = MOST,
) -> DataFrame:
    """Positional merge: row i of a key pairs with row i of the other side.

    The shorter side of a key repeats its last row; keys of one side alone are kept. On
    keys unique on both sides this is the full outer join. Null keys match each other.

    Both sides are stacked with a tag and dealt out by the key once. There rows are numbered
    inside key and tag, and a scan along the positions hands on the last row of either side,
    which is also what a shorter side repeats. If a key has more than ``most`` rows, rows are
    numbered over ranges instead, and the scan cuts such a key into ranges of positions that
    both sides share.
    """
    l_cols = [c for c in left.columns if c not in on]
    r_cols = [c for c in right.columns if c not in on]

    def tagged(df: DataFrame, tag: int, cols: list[str], order: list[str]) -> DataFrame:
        return df.select(*on, F.lit(tag).alias("_tag"), F.struct(F.lit(1), *cols).alias(f"_{tag}"), F.struct(F.lit(1), *order).alias(f"_o{tag}"))

    both = tagged(left, 0, l_cols, order_left).unionByName(tagged(right, 1, r_cols, order_right), allowMissingColumns=True)
    if any_large(both, on, most):
        numbered = ordinal(both, [*on, "_tag"], ["_o0", "_o1"], "_pos")
    else:
        inside = Window.partitionBy(*on, "_tag").orderBy("_o0", "_o1")
        numbered = both.repartition(*on).withColumn("_pos", F.row_number().over(inside).cast("long"))
    steps = {"_l": ("last", F.col("_0")), "_r": ("last", F.col("_1"))}
    met = scan(numbered.select(*on, "_tag", "_pos", "_0", "_1"), on, "_pos", steps, ties=("_tag",), most=most)
    # Of the rows at one position the right's comes last and knows both sides.
    whole = met.groupBy(*on, "_pos").agg(F.max_by(F.struct("_l", "_r"), "_tag").alias("_m"))
    return whole.select(*on, *[F.col(f"_m._l.{c}").alias(c) for c in l_cols], *[F.col(f"_m._r.{c}").alias(c) for c in r_cols])


def unmatched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Key values present on one side only, with the side."""
    lk, rk = left.select(*on).distinct(), right.select(*on).distinct()
    return lk.join(rk, on, "left_anti").withColumn("side", F.lit("left")).unionByName(
        rk.join(lk, on, "left_anti").withColumn("side", F.lit("right"))
    )


def asof_join(
    left: DataFrame, right: DataFrame, on: str, by: list[str], cols: list[str], direction: str = "backward", most: int = MOST,
) -> DataFrame:
    """Each left row takes the right row of its group nearest before (or after) it.

    Only the distinct (group, time) keys of the left are matched: they and the snapshots
    are scanned along time, where a group of more than ``most`` rows is cut into segments.
    The matched keys then join back to the left rows; a null time matches nothing.
    ``right`` is unique per (by, on).
    """
    forward = direction == "forward"
    # Written stages have a known size: few keys are not searched for large groups, and beside few matches the left needs no shuffle.
    keys = cut_lineage(left.filter(F.col(on).isNotNull()).select(*by, on).distinct())
    snap = right.filter(F.col(on).isNotNull()).select(*by, on, F.struct(*cols).alias("_snap"), F.lit(0).alias("_query"))
    both = keys.withColumns({"_snap": F.lit(None).cast(snap.schema["_snap"].dataType), "_query": F.lit(1)}).unionByName(snap)
    near = scan(both, by, on, {"_hit": ("last", F.col("_snap"))}, descending=forward, ties=("_query",), most=most)
    matched = cut_lineage(near.filter("_query = 1").select(*by, on, *[F.col(f"_hit.{c}").alias(c) for c in cols]))
    return left.join(matched, [*by, on], "left")
