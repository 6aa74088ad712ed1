"""Scans along ordered groups of any size.

A window over a group runs in one task. Here a group with more than ``most`` rows is cut
along its order into segments, each a window partition of its own; what a segment hands
on (last known value, sum, count, extreme) is one row, and a second scan over those rows
gives every segment what came before it. Groups below the limit stay whole, and a frame
without a large group has the plain window's plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkpanel.operators.skew import match_keys
from sparkpanel.session import cut_lineage

#: Rows of a group that one task takes as they are.
MOST = 1_000_000
#: Segments of a group at most; beyond, segments grow.
SEGMENTS = 1000
#: Frames that Spark estimates below this many bytes are not searched for large groups.
SMALL_BYTES = 32 << 20
#: Rows of a table of cuts or carries up to which it is broadcast.
BROADCAST_ROWS = 50_000


def _place(df: DataFrame, order: str) -> Column:
    """The order column as a number, for cutting alone; it may round, but never turns an order round."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(order).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(order).cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(order).cast("double")
    raise TypeError(f"{order}: a scan's order is a date, a timestamp or a number")


def _may_be_large(df: DataFrame, most: int) -> bool:
    if most < MOST:
        return True
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= SMALL_BYTES
    except ValueError:
        # Estimates of joins multiply; one of over 4,300 digits can't be read, and is large.
        return True


def any_large(df: DataFrame, by: list[str], most: int = MOST) -> bool:
    """Whether a group has more than ``most`` rows."""
    return _may_be_large(df, most) and bool(df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).limit(1).count())


def segment_cuts(df: DataFrame, by: list[str], order: str, most: int = MOST) -> tuple[DataFrame, int] | None:
    """For each group of more than ``most`` rows the places that cut it into even segments.

    The frame (by, _cuts) and the number of its cuts, or None where no group is that large.
    The places come from a mergeable quantile sketch, so no task holds a group. Rows of
    one group that share their place stay together.
    """
    if not _may_be_large(df, most):
        return None
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    found = sizes.agg(F.max("_n").alias("top"), F.count(F.lit(1)).alias("groups")).first()
    if not found["groups"]:
        return None
    parts = min(SEGMENTS, math.ceil(found["top"] / most))
    sizes = F.broadcast(sizes) if found["groups"] <= BROADCAST_ROWS else sizes
    placed = match_keys(df.select(*by, _place(df, order).alias("_place")), sizes, by, "inner")
    each = F.ceil(parts / F.least(F.lit(parts), F.ceil(F.first("_n") / most)))
    every = F.percentile_approx("_place", F.array(*[F.lit(i / parts) for i in range(1, parts)]), 20 * parts)
    drawn = placed.groupBy(*by).agg(every.alias("_all"), each.alias("_each"))
    kept = F.array_distinct(F.filter("_all", lambda c, i: (i + 1) % F.col("_each") == 0))
    return cut_lineage(drawn.select(*by, kept.alias("_cuts"))), found["groups"] * parts


def segmented(df: DataFrame, by: list[str], order: str, cuts: tuple[DataFrame, int]) -> DataFrame:
    """Adds _seg, the number of the row's segment in its group, and _large, whether the group is cut."""
    frame, size = cuts
    tagged = match_keys(df, F.broadcast(frame) if size <= BROADCAST_ROWS else frame, by)
    below = F.size(F.filter("_cuts", lambda c: c < _place(df, order)))
    return tagged.withColumn("_large", F.col("_cuts").isNotNull()).withColumn("_seg", F.when(F.col("_large"), below).otherwise(0)).drop("_cuts")


def _over(fn: str, col: str) -> Column:
    return F.last(col, ignorenulls=True) if fn == "last" else {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[fn](col)


def _joined(fn: str, carry: Column, here: Column) -> Column:
    if fn == "sum":
        return F.coalesce(carry + here, carry, here)
    if fn == "count":
        return F.coalesce(carry, F.lit(0)) + here
    if fn == "last":
        return F.coalesce(here, carry)
    return (F.least if fn == "min" else F.greatest)(carry, here)


def scan(
    df: DataFrame, by: list[str], order: str, steps: dict[str, tuple[str, Column]],
    descending: bool = False, ties: tuple[str, ...] = (), most: int = MOST,
) -> DataFrame:
    """Running results inside each group, the row itself included.

    ``steps`` names each result with a function (sum, count, min, max, or last for the
    last known value) and what it runs over; count counts known values. Rows follow
    ``order``, nulls first (last if ``descending``), then ``ties`` in ascending order
    (numbers, if ``descending``).
    Null keys form a group. Names that start with an underscore are reserved.
    """
    sources = {f"_v{i}": value for i, (_, value) in enumerate(steps.values())}
    plan = [(name, fn, f"_v{i}", f"_c{i}") for i, (name, (fn, _)) in enumerate(steps.items())]
    direction = F.col(order).desc() if descending else F.col(order).asc()
    cuts = segment_cuts(df, by, order, most)
    rows = df.withColumns(sources) if cuts is None else segmented(df.withColumns(sources), by, order, cuts)
    parts = by if cuts is None else [*by, "_seg"]
    upto = Window.partitionBy(*parts).orderBy(direction, *ties).rowsBetween(Window.unboundedPreceding, 0)
    if cuts is None:
        return rows.withColumns({name: _over(fn, v).over(upto) for name, fn, v, _ in plan}).drop(*sources)
    at = F.struct(order, *[(-F.col(t) if descending else F.col(t)).alias(t) for t in ties])

    def handed_on(fn: str, v: str) -> Column:
        if fn != "last":
            return _over(fn, v)
        known = F.when(F.col(v).isNotNull(), at)
        return F.max_by(v, known) if not descending else F.min_by(v, known)

    totals = rows.filter("_large").groupBy(*parts).agg(*[handed_on(fn, v).alias(c) for _, fn, v, c in plan])
    seg = F.col("_seg").desc() if descending else F.col("_seg").asc()
    before = Window.partitionBy(*by).orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
    over = {c: (F.sum(c) if fn == "count" else _over(fn, c)).over(before) for _, fn, _, c in plan}
    carries = totals.select(*parts, *[e.alias(c) for c, e in over.items()])
    carries = F.broadcast(carries) if cuts[1] <= BROADCAST_ROWS else carries
    here = rows.withColumns({name: _over(fn, v).over(upto) for name, fn, v, _ in plan})
    met = match_keys(here, carries, parts)
    return met.withColumns({name: _joined(fn, F.col(c), F.col(name)) for name, fn, _, c in plan}).drop(
        *sources, *[c for *_, c in plan], "_seg", "_large"
    )


def numbered(df: DataFrame, by: list[str], order: str, name: str, ties: tuple[str, ...] = (), most: int = MOST) -> DataFrame:
    """Row number 1..n (long) inside each group; rows alike in ``order`` and ``ties`` are numbered in no stated order."""
    return scan(df, by, order, {name: ("count", F.lit(1))}, ties=ties, most=most)
