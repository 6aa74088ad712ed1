"""Exact k-nearest joins without comparing every pair.

Points of the right side are sorted into nested cubes on the unit sphere, where the
straight-line distance orders points as the great-circle distance does. Each distinct
left point keeps the cubes that can still hold one of its k nearest: a cube is dropped
when its closest corner is farther than the farthest corner of cubes already holding
k points. A step splits the surviving cubes that hold more than ``LEAF`` points by
four along each axis; the points of the last cubes are then compared. Work grows with
left points times a few dozen, wherever the points lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkpanel.functions.geodesy import geodesic_km, haversine_km
from sparkpanel.operators.skew import match_keys
from sparkpanel.session import cut_lineage

LEAF = 12
BITS = 20
STEP = 2
# Rows of the cube and point tables that are broadcast; above it Spark chooses the join.
BROADCAST_ROWS = 500_000
# Ellipsoid and sphere distances differ by less than 0.6 % either way.
ELLIPSOID_SLACK = 1.0125
_EPS = 1e-9
_AXES = ("x", "y", "z")


def _sphere(lat: str, lon: str) -> dict[str, Column]:
    la, lo = F.radians(F.col(lat)), F.radians(F.col(lon))
    return {"_x": F.cos(la) * F.cos(lo), "_y": F.cos(la) * F.sin(lo), "_z": F.sin(la)}


def _cell(level: Column) -> list[Column]:
    return [F.call_function("shiftright", F.col(f"_c{a}"), F.lit(BITS) - level).alias(f"_n{a}") for a in _AXES]


def _bounds(prefix: str) -> tuple[Column, Column]:
    """Least and greatest distance from the point to a box whose walls start with ``prefix``."""
    gaps, far = [], []
    for a in _AXES:
        lo, hi, here = F.col(f"{prefix}_min{a}"), F.col(f"{prefix}_max{a}"), F.col(f"_{a}")
        gap = F.greatest(F.lit(0.0), lo - here, here - hi)
        edge = F.greatest(F.abs(here - lo), F.abs(here - hi))
        gaps.append(gap * gap)
        far.append(edge * edge)
    return F.sqrt(gaps[0] + gaps[1] + gaps[2]), F.sqrt(far[0] + far[1] + far[2])


def _prune(state: DataFrame, point: list[str], want: int, slack: float) -> DataFrame:
    """Drop the cubes that lie beyond the reach within which ``want`` points are certain.

    The reach known from earlier levels goes first, as a plain filter.
    """
    within = F.col("_reach").isNull() | (F.col("_near") <= F.col("_reach") * slack + _EPS)
    # One cube with enough points bounds the search; else all cubes together do.
    everyone = Window.partitionBy(*point)
    single = F.min(F.when(F.col("_cnt") >= want, F.col("_far"))).over(everyone)
    joint = F.when(F.sum("_cnt").over(everyone) >= want, F.max("_far").over(everyone))
    return state.filter(within).withColumn("_now", F.coalesce(single, joint)).withColumn(
        "_reach", F.least("_reach", "_now")
    ).drop("_now").filter(within)


def nearest_join(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, k: int = 1, by: list[str] | None = None,
    left_xy: tuple[str, str] = ("lat", "lon"), right_xy: tuple[str, str] = ("lat", "lon"),
    exclude_self: bool = False, metric: str = "haversine", right_name: str = "near_id",
) -> DataFrame:
    """The k nearest right points of each left point: left_id, by, near_id, dist_km, rank.

    Left rows without coordinates or without a candidate stay, with nulls. With ``by``
    only points of the same group are candidates. Distances are compared
    to a millimetre and ties go to the smaller id. ``exclude_self`` skips the
    right point that carries the left id.
    """
    by = list(by or [])
    want = k + 1 if exclude_self else k
    slack = ELLIPSOID_SLACK if metric == "geodesic" else 1.0

    rp = right.select(
        *by, F.col(right_id).alias("_rid"), F.col(right_xy[0]).alias("_rla"), F.col(right_xy[1]).alias("_rlo")
    ).dropna(subset=["_rla", "_rlo"])
    # The points and the cube table are read once per level, so they are written out first.
    rp = cut_lineage(rp)
    same_spot = Window.partitionBy(*by, "_rla", "_rlo").orderBy("_rid")
    ids = rp.withColumn("_n", F.row_number().over(same_spot)).filter(F.col("_n") <= want).drop("_n")
    spots = rp.select(*by, "_rla", "_rlo").distinct().withColumns(_sphere("_rla", "_rlo"))
    box = spots.agg(
        F.count(F.lit(1)).alias("n"), *[f(f"_{a}").alias(f"{t}{a}") for a in _AXES for t, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    if box["n"] == 0:
        box = {"n": 0, **{f"{t}{a}": 0.0 for a in _AXES for t in ("lo", "hi")}}
    origin = {a: box[f"lo{a}"] for a in _AXES}
    extent = max(max(box[f"hi{a}"] - box[f"lo{a}"] for a in _AXES), 1e-9) * (1 + 1e-9)
    scale = 2**BITS / extent
    spots = spots.withColumns({
        f"_c{a}": F.least(F.lit(2**BITS - 1), F.floor((F.col(f"_{a}") - origin[a]) * scale)).cast("int") for a in _AXES
    })

    def cells(levels: list[int]) -> DataFrame:
        return spots.withColumn("_level", F.explode(F.lit(levels))).select(
            *by, "_rla", "_rlo", *[f"_{a}" for a in _AXES], "_level", *_cell(F.col("_level"))
        )

    cell = ["_level", "_nx", "_ny", "_nz"]
    all_levels = list(range(0, BITS + 1, STEP))
    # A cube is bounded by the box of its points, much tighter than its own walls.
    walls = [f"_{t}{a}" for a in _AXES for t in ("min", "max")]
    boxes = [f(f"_{a}").alias(f"_{t}{a}") for a in _AXES for t, f in (("min", F.min), ("max", F.max))]
    nodes = cut_lineage(cells(all_levels).groupBy(*by, *cell).agg(F.count(F.lit(1)).alias("_cnt"), *boxes))
    deepest = nodes.filter((F.col("_cnt") > LEAF) & (F.col("_level") < BITS)).agg(F.max("_level")).first()[0]
    steps = list(range(0, deepest + 1, STEP)) if deepest is not None else []
    small = box["n"] * (len(steps) + 1 + want) <= BROADCAST_ROWS

    # Distinct left points, spread over all shuffle partitions (the rows multiply below, so
    # adaptive coalescing by their small size would be wrong) and sorted once: broadcast
    # joins and the windows below keep that order and need no further shuffle or sort.
    # The hash leads the key because floating keys alone would be shuffled again.
    place = [*by, "_la", "_lo"]
    point = ["_h", *place]
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lp = left.select(*by, F.col(left_xy[0]).alias("_la"), F.col(left_xy[1]).alias("_lo")).dropna(subset=["_la", "_lo"])
    lp = lp.distinct().withColumn("_h", F.xxhash64(*place)).repartition(width, "_h")
    once = Window.partitionBy(*point).orderBy(*point)
    state = lp.withColumn("_once", F.row_number().over(once)).filter("_once = 1").select(*point).withColumns(_sphere("_la", "_lo"))
    here = [f"_{a}" for a in _AXES]
    unknown = F.lit(None).cast("double").alias("_reach")
    if steps and not by:
        # The first step of an ungrouped tree has at most 64 cubes.
        top = nodes.filter(F.col("_level") == STEP).collect()
        listed = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in (*cell, "_cnt", *walls)]) for r in top])
        state = state.select(*point, *here, F.explode(listed).alias("_kid"))
        near, far = _bounds("_kid.")
        state = state.select(*point, *here, *[F.col(f"_kid.{c}") for c in (*cell, "_cnt")], near.alias("_near"), far.alias("_far"), unknown)
        state = _prune(state, point, want, slack)
        rest = steps[1:]
    else:
        state = state.select(
            *point, *here, *[F.lit(0).alias(c) for c in cell], F.lit(1).cast("bigint").alias("_cnt"),
            F.lit(0.0).alias("_near"), F.lit(2.0).alias("_far"), unknown,
        )
        rest = steps
    for level in rest:
        parents = nodes.filter((F.col("_level") == level) & (F.col("_cnt") > LEAF)).select(*by, *cell)
        kids = nodes.filter(F.col("_level") == level + STEP).select(
            *by, F.lit(level).alias("_level"),
            *[F.shiftright(f"_n{a}", STEP).alias(f"_n{a}") for a in _AXES],
            F.struct(*cell, "_cnt", *walls).alias("_kid"),
        ).join(parents, [*by, *cell], "left_semi")
        # The second step of an ungrouped tree has at most 4096 cubes.
        if small or (not by and level <= STEP):
            kids = F.broadcast(kids)
        near, far = _bounds("_kid.")
        split = F.col("_kid").isNotNull()
        state = state.join(kids, [*by, *cell], "left").select(
            *point, *here, *[F.when(split, F.col(f"_kid.{c}")).otherwise(F.col(c)).alias(c) for c in (*cell, "_cnt")],
            F.when(split, near).otherwise(F.col("_near")).alias("_near"), F.when(split, far).otherwise(F.col("_far")).alias("_far"), "_reach",
        )
        state = _prune(state, point, want, slack)

    if small:
        ids = F.broadcast(ids)
    if not steps and not by and box["n"]:
        # A tree of one cube: at most LEAF points, listed in the plan.
        few = [F.struct(F.lit(r["_rla"]).alias("_rla"), F.lit(r["_rlo"]).alias("_rlo")) for r in spots.select("_rla", "_rlo").collect()]
        pairs = state.select(*point, F.explode(F.array(*few)).alias("_spot")).select(*point, "_spot.*")
    else:
        leaves = cells([*steps, steps[-1] + STEP] if steps else [0]).drop(*here)
        pairs = state.select(*point, *cell).join(F.broadcast(leaves) if small else leaves, [*by, *cell])
    pairs = pairs.select(
        *point, "_rla", "_rlo", F.round(haversine_km("_la", "_lo", "_rla", "_rlo"), 6).alias("_dist")
    )
    if metric == "geodesic" or want > 1:
        by_dist = Window.partitionBy(*point).orderBy("_dist")
        pairs = pairs.withColumn("_r", F.rank().over(by_dist))
    if metric == "geodesic":
        kth = F.max(F.when(F.col("_r") <= want, F.col("_dist"))).over(
            by_dist.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        pairs = pairs.withColumn("_kth", kth).filter(F.col("_dist") <= F.col("_kth") * slack + 1e-6)
        pairs = pairs.withColumn("_dist", F.round(geodesic_km("_la", "_lo", "_rla", "_rlo"), 6))
    elif want > 1:
        pairs = pairs.filter(F.col("_r") <= want)
    else:
        pairs = pairs.withColumn("_least", F.min("_dist").over(Window.partitionBy(*point))).filter(F.col("_dist") == F.col("_least"))
    hits = pairs.select(*point, "_rla", "_rlo", "_dist").join(ids, [*by, "_rla", "_rlo"])
    best = Window.partitionBy(*point).orderBy("_dist", "_rid")
    hits = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= want).select(
        *point, F.col("_rid").alias(right_name), F.col("_dist").alias("dist_km"), "rank"
    )
    rows = left.select(F.col(left_id), *by, F.col(left_xy[0]).alias("_la"), F.col(left_xy[1]).alias("_lo"))
    if not exclude_self:
        return rows.join(hits.drop("_h"), place, "left").select(left_id, *by, right_name, "dist_km", "rank")
    w = Window.partitionBy(left_id, *by).orderBy("rank")
    out = rows.join(hits.drop("_h"), place).drop("_la", "_lo").filter(F.col(right_name) != F.col(left_id))
    out = out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return match_keys(rows.select(left_id, *by), out, [left_id, *by])


def neighbours(df: DataFrame, id: str, k: int, xy: tuple[str, str] = ("lat", "lon"), metric: str = "haversine") -> DataFrame:
    """Ranked k nearest other points of each point."""
    return nearest_join(df, df, id, id, k=k, left_xy=xy, right_xy=xy, exclude_self=True, metric=metric, right_name="neighbour")
