"""Point-in-polygon joins and areas. Rings are ARRAY<STRUCT<x, y>> columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpanel.session import cut_lineage


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd test: an odd number of edges crossed to the right of the point."""
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))

    def crossed(a, b):
        straddles = (a["y"] > y) != (b["y"] > y)
        at = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / F.nullif(b["y"] - a["y"], F.lit(0.0))
        return F.when(straddles & (x < at), 1).otherwise(0)

    hits = F.zip_with(ring, nxt, crossed)
    return F.aggregate(hits, F.lit(0), lambda acc, h: acc + h) % 2 == 1


def ring_area(ring: str | Column) -> Column:
    """Shoelace area of a ring."""
    ring = F.col(ring) if isinstance(ring, str) else ring
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    terms = F.zip_with(ring, nxt, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)) / 2


def point_in_polygon(
    points: DataFrame, polys: DataFrame, xy: tuple[str, str] = ("lon", "lat"), ring: str = "ring"
) -> DataFrame:
    """Inner join of points with the polygons that contain them.

    Both sides are keyed by square cells. A polygon takes the power of four from its box
    side on as cell, so it touches four cells at most whatever the others' size; a point
    is looked up once for each cell size in use, a handful of powers. Points crowded in
    one cell make a large join key, which adaptive execution splits.
    """
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    boxed = polys.withColumns({
        "_x0": F.array_min(xs), "_x1": F.array_max(xs), "_y0": F.array_min(ys), "_y1": F.array_max(ys),
    })
    joined = _in_box(points, boxed, xy)
    return joined.filter(inside_ring(F.col(xy[0]), F.col(xy[1]), F.col(ring))).drop("_x0", "_x1", "_y0", "_y1", ring)


def _in_box(points: DataFrame, boxed: DataFrame, xy: tuple[str, str]) -> DataFrame:
    """Points with the boxes (_x0 to _x1, _y0 to _y1) that hold them, by square cells."""
    side = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"), F.lit(1e-9))
    boxed = boxed.withColumn("_level", F.ceil(F.log(side) / math.log(4)).cast("int")).filter("_level is not null")
    sizes = [r[0] for r in boxed.select("_level").distinct().collect()]

    def key(c: Column) -> Column:
        return F.floor(c / F.pow(F.lit(4.0), F.col("_level")))

    keyed = boxed.withColumn("_i", F.explode(F.sequence(key(F.col("_x0")), key(F.col("_x1"))))).withColumn(
        "_j", F.explode(F.sequence(key(F.col("_y0")), key(F.col("_y1"))))
    )
    x, y = F.col(xy[0]), F.col(xy[1])
    located = points.withColumn("_level", F.explode(F.lit(sizes).cast("array<int>"))).withColumns({"_i": key(x), "_j": key(y)})
    return located.join(keyed, ["_level", "_i", "_j"]).filter(
        x.between(F.col("_x0"), F.col("_x1")) & y.between(F.col("_y0"), F.col("_y1"))
    ).drop("_level", "_i", "_j")


def edge_table(rings: DataFrame, keys: list[str], ring: str = "ring") -> DataFrame:
    """One row per edge of each ring: keys, _ax, _ay, _bx, _by. Edges with a null end are left out."""
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    ends = rings.select(*keys, F.explode(F.zip_with(ring, nxt, lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("_e"))
    return ends.select(*keys, *[F.col(f"_e.{p}.{c}").cast("double").alias(f"_{p}{c}") for p in "ab" for c in "xy"]).dropna(
        subset=["_ax", "_ay", "_bx", "_by"])


def point_in_parts(
    points: DataFrame, rings: DataFrame, zone: str, part: str, xy: tuple[str, str] = ("lon", "lat"), ring: str = "ring"
) -> DataFrame:
    """Inner join of points with the zones that contain them, where a zone has any number of parts and holes.

    ``rings`` has one ring a row; the rings of a part are its outline and its holes. A
    point is in a part if it crosses its rings an odd number of times, and in a zone, once,
    if it is in one of its parts, which may overlap.

    A ring is never walked whole. Edges are rows, keyed by the strips of the part that they
    touch; a strip is three edges' mean rise high, so that a part has at most four rows
    an edge and a point meets about as many edges as its level has in the part. Distinct
    positions are tested, against the parts whose box holds them, and crossings are
    counted by position and part in the shuffle. Points and rings of null coordinates match
    nothing, as do null zones; a null part is a part of its own.
    """
    rings = rings.filter(F.col(zone).isNotNull()).select(F.col(zone).alias("_zone"), F.struct(F.col(part).alias("p")).alias("_part"), F.col(ring).alias("_ring"))
    # A level edge is never crossed.
    edges = cut_lineage(edge_table(rings, ["_zone", "_part"], "_ring").filter("_ay <> _by"))
    boxes = edges.groupBy("_zone", "_part").agg(
        F.min(F.least("_ax", "_bx")).alias("_x0"), F.max(F.greatest("_ax", "_bx")).alias("_x1"),
        F.min(F.least("_ay", "_by")).alias("_y0"), F.max(F.greatest("_ay", "_by")).alias("_y1"),
        (F.sum(F.abs(F.col("_by") - F.col("_ay"))) / (3 * F.count(F.lit(1)))).alias("_strip"),
    )
    boxes = cut_lineage(boxes)

    def strip(y: str | Column) -> Column:
        return F.floor(((F.col(y) if isinstance(y, str) else y) - F.col("_y0")) / F.col("_strip"))

    touched = F.sequence(strip(F.least("_ay", "_by")), strip(F.greatest("_ay", "_by")))
    strips = edges.join(boxes.select("_zone", "_part", "_y0", "_strip"), ["_zone", "_part"]).withColumn("_row", F.explode(touched)).drop("_y0", "_strip")
    spots = points.select(F.col(xy[0]).alias("_px"), F.col(xy[1]).alias("_py")).dropna().distinct()
    near = _in_box(spots, boxes, ("_px", "_py")).select("_px", "_py", "_zone", "_part", strip("_py").alias("_row"))
    x, y, ax, ay, bx, by = (F.col(c) for c in ("_px", "_py", "_ax", "_ay", "_bx", "_by"))
    crossed = ((ay > y) != (by > y)) & (x < ax + (y - ay) * (bx - ax) / (by - ay))
    hits = near.join(strips, ["_zone", "_part", "_row"]).filter(crossed)
    inside = hits.groupBy("_px", "_py", "_zone", "_part").agg(F.count(F.lit(1)).alias("_n")).filter("_n % 2 = 1")
    found = inside.select("_px", "_py", "_zone").distinct()
    out = points.drop(zone).join(found, (F.col(xy[0]) == F.col("_px")) & (F.col(xy[1]) == F.col("_py")))
    return out.drop("_px", "_py").withColumnRenamed("_zone", zone)


def parts_area(rings: DataFrame, zone: str, part: str, ring: str = "ring") -> DataFrame:
    """Area of each zone: of each part the largest ring less the others, summed over its parts as if none overlap."""
    each = rings.select(F.col(zone), F.col(part), ring_area(ring).alias("_area"))
    net = each.groupBy(zone, part).agg((2 * F.max("_area") - F.sum("_area")).alias("_net"))
    return net.groupBy(zone).agg(F.sum("_net").alias("area"))


def area_mean(
    pixels: DataFrame, polys: DataFrame, zone: str, value: str, time: list[str], xy=("lon", "lat"), part: str | None = None
) -> DataFrame:
    """Mean, min, max of the pixels inside each polygon per period.

    Containment is tested once per distinct pixel position, not once per day. With
    ``part`` the polygons are rings of parts with holes, as in ``point_in_parts``.
    """
    spots = pixels.select(*xy).distinct()
    inside = (point_in_polygon(spots, polys, xy) if part is None else point_in_parts(spots, polys, zone, part, xy)).select(*xy, zone)
    return pixels.join(inside, list(xy)).groupBy(zone, *time).agg(
        F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.count(value).alias("pixels")
    )
