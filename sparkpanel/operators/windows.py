"""Time-series operators on panels.

A panel has one row per (entity, period). The partition of a window is then one
entity's calendar, so its size is bounded by the number of periods whatever the
volume of raw observations; raw data is aggregated to a panel first. Operators that run
along a whole series go through ``segments.scan``, which also cuts a series that is too
long for one task; ``most`` is its limit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from sparkpanel.operators.aggregates import attach
from sparkpanel.operators.segments import MOST, numbered, scan


def panel(by: list[str], time: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(time)


def dense_grid(df: DataFrame, by: list[str], time: str, step: str = "1 day") -> DataFrame:
    """Every entity with every date between the first and last date of the frame."""
    lim = df.agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    days = F.sequence(lim.select("lo").scalar(), lim.select("hi").scalar(), F.expr(f"INTERVAL {step}"))
    return df.select(*by).distinct().select(*by, F.explode(days).alias(time))


def lag_rows(df: DataFrame, by: list[str], order: str, cols: list[str], n: int, suffix: str | None = None) -> DataFrame:
    """Value n rows earlier (later for negative n)."""
    w = panel(by, order)
    tag = suffix if suffix is not None else f"_lag{n}"
    return df.withColumns({f"{c}{tag}": F.lag(c, n).over(w) for c in cols})


def lag_calendar(df: DataFrame, by: list[str], month: str, cols: list[str], n: int, suffix: str | None = None) -> DataFrame:
    """Value of the same day of the month exactly n months earlier, null across gaps.

    Rows are unique per (by, month). A day that the earlier month lacks has no match.
    """
    tag = suffix if suffix is not None else f"_m{n}"
    number, day = F.year(month) * 12 + F.month(month), F.dayofmonth(month)
    earlier = df.select(*by, (number + n).alias("_number"), day.alias("_day"), *[F.col(c).alias(f"{c}{tag}") for c in cols])
    return df.withColumns({"_number": number, "_day": day}).join(earlier, [*by, "_number", "_day"], "left").drop("_number", "_day")


def fill_group(df: DataFrame, by: list[str], order: str, col: str, name: str | None = None, most: int = MOST) -> DataFrame:
    """Fill from the previous row of the group, else two back, else one ahead."""
    point = F.when(F.col(col).isNotNull(), F.struct(F.col("_pos").alias("pos"), F.col(col).alias("v")))
    out = numbered(df, by, order, "_pos", most=most)
    out = scan(out, by, order, {"_back": ("last", point)}, most=most)
    out = scan(out, by, order, {"_ahead": ("last", point)}, descending=True, most=most)
    back = F.when(F.col("_pos") - F.col("_back.pos") <= 2, F.col("_back.v"))
    ahead = F.when(F.col("_ahead.pos") - F.col("_pos") <= 1, F.col("_ahead.v"))
    return out.withColumn(name or col, F.coalesce(F.col(col), back, ahead)).drop("_pos", "_back", "_ahead")


def broadcast_mean(df: DataFrame, by: list[str], cols: list[str], prefix: str) -> DataFrame:
    """Group means on every row: aggregated, then joined back."""
    means = df.groupBy(*by).agg(*[F.avg(c).alias(f"{prefix}{c}") for c in cols])
    return attach(df, means, by)


def running(df: DataFrame, by: list[str], order: str, col: str, fn: str = "sum", name: str | None = None, most: int = MOST) -> DataFrame:
    """Running sum, max, min or count of known values."""
    return scan(df, by, order, {name or f"run_{col}": (fn, F.col(col))}, most=most)


def _framed(agg: Column, col: str, w: WindowSpec, k: int) -> Column:
    return F.when(F.count(col).over(w) == k, agg.over(w))


def rolling_sum(df: DataFrame, by: list[str], order: str, col: str, k: int, name: str | None = None) -> DataFrame:
    """Trailing k-row sum, null until k known rows."""
    w = panel(by, order).rowsBetween(-(k - 1), 0)
    return df.withColumn(name or f"roll{k}_{col}", _framed(F.sum(col), col, w, k))


def median_ahead(col: str, k: int, w: WindowSpec) -> Column:
    """Median of this and the next k-1 values of an ordered window, null unless all are known."""
    values = [F.lead(col, i).over(w) if i else F.col(col) for i in range(k)]
    ranked = F.sort_array(F.array(*[v.cast("double") for v in values]))
    middle = ranked[k // 2] if k % 2 else (ranked[k // 2 - 1] + ranked[k // 2]) / 2
    return F.when(reduce(lambda a, v: a & v.isNotNull(), values[1:], values[0].isNotNull()), middle)


def rolling_median(df: DataFrame, by: list[str], order: str, col: str, k: int, name: str | None = None) -> DataFrame:
    """k-row median starting at the row, null in the last k-1 rows."""
    return df.withColumn(name or f"med{k}_{col}", median_ahead(col, k, panel(by, order)))


def run_length(cond: Column, pos: Column, w: WindowSpec) -> Column:
    """Number of consecutive rows up to this one that meet ``cond``; ``pos`` numbers the rows."""
    miss = F.when(~F.coalesce(cond, F.lit(False)), pos)
    return pos - F.coalesce(F.max(miss).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))


def longest_run(df: DataFrame, by: list[str], order: str, cond: Column, name: str = "longest", most: int = MOST) -> DataFrame:
    """Longest stretch of consecutive rows meeting ``cond`` per group, 0 when none."""
    rows = numbered(df.withColumn("_met", F.coalesce(cond, F.lit(False))), by, order, "_pos", most=most)
    runs = scan(rows, by, order, {"_miss": ("max", F.when(~F.col("_met"), F.col("_pos")))}, most=most)
    return runs.groupBy(*by).agg(F.max(F.col("_pos") - F.coalesce("_miss", F.lit(0))).alias(name))


def first_index(df: DataFrame, by: list[str], order: str, cond: Column, offset: int = 0, name: str = "first", most: int = MOST) -> DataFrame:
    """1-based position of the first row meeting ``cond``, plus ``offset``; null if never."""
    rows = numbered(df, by, order, "_pos", most=most)
    return rows.groupBy(*by).agg((F.min(F.when(cond, F.col("_pos"))) + offset).alias(name))


def state_change(df: DataFrame, by: list[str], order: str, cond: Column, name: str = "change") -> DataFrame:
    """1 where ``cond`` holds now and held not on the previous row."""
    w = panel(by, order)
    now = F.coalesce(cond, F.lit(False)).cast("int")
    marked = df.withColumn("_now", now)
    return marked.withColumn(
        name, ((F.col("_now") == 1) & (F.lag("_now").over(w) == 0)).cast("int")
    ).withColumn(name, F.coalesce(name, F.lit(0))).drop("_now")


def _neighbours_known(df: DataFrame, by: list[str], t: str, v: str, most: int = MOST) -> DataFrame:
    """Adds the known point at or before and at or after each row as structs."""
    point = F.when(F.col(v).isNotNull(), F.struct(F.col(t).alias("t"), F.col(v).alias("v")))
    back = scan(df, by, t, {"_lo": ("last", point)}, most=most)
    return scan(back, by, t, {"_hi": ("last", point)}, descending=True, most=most)


def _gap_days(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("double")


def interp_linear(df: DataFrame, by: list[str], t: str, v: str, name: str | None = None, most: int = MOST) -> DataFrame:
    """Linear fill between known dates per series, the ends carried outwards."""
    out = _neighbours_known(df, by, t, v, most)
    span = _gap_days(F.col("_hi.t"), F.col("_lo.t"))
    inner = F.col("_lo.v") + (F.col("_hi.v") - F.col("_lo.v")) * _gap_days(F.col(t), F.col("_lo.t")) / F.nullif(span, F.lit(0.0))
    return out.withColumn(
        name or v, F.coalesce(F.col(v), inner, F.col("_lo.v"), F.col("_hi.v"))
    ).drop("_lo", "_hi")


def interp_stine(df: DataFrame, by: list[str], t: str, v: str, name: str | None = None) -> DataFrame:
    """Stineman's consistently well-behaved interpolation per series, ends carried.

    Both axes are scaled by the range of the known points, so the unit of the values has
    no part in the result. Slopes at the known points come from the circle through a point
    and its two neighbours; an end slope is turned back where it would overshoot. Between
    points the value lies on Stineman's rational curve.
    """
    w = panel(by, t)
    whole = Window.partitionBy(*by)
    known = df.filter(F.col(v).isNotNull()).select(*by, t, F.col(v).alias("_y"))
    days = F.max(F.col(t)).over(whole), F.min(F.col(t)).over(whole)
    known = known.withColumns({
        "_sx": F.greatest(F.datediff(*days), F.lit(1)).cast("double"),
        "_sy": F.coalesce(F.nullif(F.max("_y").over(whole) - F.min("_y").over(whole), F.lit(0.0)), F.lit(1.0)),
    })
    known = known.withColumns({
        "_dl": _gap_days(F.col(t), F.lag(t).over(w)) / F.col("_sx"), "_el": (F.col("_y") - F.lag("_y").over(w)) / F.col("_sy"),
        "_dr": _gap_days(F.lead(t).over(w), F.col(t)) / F.col("_sx"), "_er": (F.lead("_y").over(w) - F.col("_y")) / F.col("_sy"),
    }).withColumns({"_sl": F.col("_el") / F.col("_dl"), "_sr": F.col("_er") / F.col("_dr")})
    left_sq = F.pow("_dl", F.lit(2.0)) + F.pow("_el", F.lit(2.0))
    right_sq = F.pow("_dr", F.lit(2.0)) + F.pow("_er", F.lit(2.0))
    known = known.withColumn("_mid", (F.col("_sl") * right_sq + F.col("_sr") * left_sq) / (left_sq + right_sq))

    def end(chord: Column, inner: Column) -> Column:
        """Slope at an end from the end chord and the next slope."""
        calm = ((chord >= 0) & (chord >= inner)) | ((chord <= 0) & (chord <= inner))
        both = F.abs(chord) + F.abs(chord - inner)
        turned = chord + F.abs(chord) * (chord - inner) / F.nullif(both, F.lit(0.0))
        return F.when(inner.isNull(), chord).when(calm, 2 * chord - inner).otherwise(F.coalesce(turned, chord))

    slope = F.coalesce(
        "_mid", F.when(F.col("_sl").isNull(), end(F.col("_sr"), F.lead("_mid").over(w))).otherwise(end(F.col("_sl"), F.lag("_mid").over(w))), F.lit(0.0)
    )
    points = known.withColumn("_yp", slope * F.col("_sy") / F.col("_sx")).select(*by, t, "_yp")
    base = df.join(points, [*by, t], "left")
    pt = F.when(F.col(v).isNotNull(), F.struct(F.col(t).alias("t"), F.col(v).alias("v"), F.col("_yp").alias("yp")))
    base = base.withColumn("_pt", pt)
    base = base.withColumn(
        "_lo", F.last("_pt", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("_hi", F.first("_pt", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    dx = _gap_days(F.col("_hi.t"), F.col("_lo.t"))
    s = (F.col("_hi.v") - F.col("_lo.v")) / F.nullif(dx, F.lit(0.0))
    a, b = _gap_days(F.col(t), F.col("_lo.t")), _gap_days(F.col(t), F.col("_hi.t"))
    chord = F.col("_lo.v") + s * a
    d1 = (F.col("_lo.yp") - s) * a
    d2 = (F.col("_hi.yp") - s) * b
    prod = d1 * d2
    curve = (
        F.when(prod > 0, chord + prod / F.nullif(d1 + d2, F.lit(0.0)))
        .when(prod < 0, chord + prod * (a + b) / ((d1 - d2) * F.nullif(dx, F.lit(0.0))))
        .otherwise(chord)
    )
    return base.withColumn(
        name or v, F.coalesce(F.col(v), curve, F.col("_lo.v"), F.col("_hi.v"))
    ).drop("_lo", "_hi", "_pt", "_yp")


def trend_days(df: DataFrame, day: str) -> DataFrame:
    """Days since the first date of the frame, and the square."""
    start = df.agg(F.min(day).alias("lo")).select("lo").scalar()
    return df.withColumn("trend", F.datediff(F.col(day), start)).withColumn(
        "trend2", F.col("trend").cast("bigint") * F.col("trend").cast("bigint")
    )


def deviation(df: DataFrame, by: list[str], col: str, legacy: bool = False) -> DataFrame:
    """Squared deviation from the group norm, split by sign, and their roots.

    ``legacy`` halves instead of taking the root, as published.
    """
    norm = df.groupBy(*by).agg(F.avg(col).alias("norm"))
    out = attach(df, norm, by)
    dev = F.col(col) - F.col("norm")
    out = out.withColumns({
        "pos_dev": F.when(dev > 0, dev * dev).otherwise(F.lit(0.0)),
        "neg_dev": F.when(dev < 0, dev * dev).otherwise(F.lit(0.0)),
    })
    root = (lambda c: F.col(c) / 2) if legacy else F.sqrt
    return out.withColumns({"pos_root": root("pos_dev"), "neg_root": root("neg_dev")})


def month_slots(df: DataFrame, by: list[str], day: str, value: str, months: dict[int, str], total: str) -> DataFrame:
    """One summed column per month of the season, and their total."""
    m = F.month(day)
    slots = [F.sum(F.when(m == num, F.col(value)).otherwise(F.lit(0.0))).alias(n) for num, n in months.items()]
    return df.groupBy(*by).agg(*slots).withColumn(total, sum((F.col(n) for n in months.values()), F.lit(0.0)))
