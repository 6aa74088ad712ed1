"""Distances, nearest joins, polygons, price imputation and price panels."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sparkpanel.functions.geodesy import WGS84_A, WGS84_F, albers_constants, albers_xy, geodesic_km, haversine_km as haversine
from sparkpanel.operators import nearest
from sparkpanel.operators.aggregates import share, sum_strict
from sparkpanel.operators.polygons import area_mean, parts_area, point_in_parts, point_in_polygon, ring_area as area_of
from sparkpanel.operators.windows import dense_grid
from sparkpanel.plans import prices as pr
from sparkpanel.queries.base import (
    COORD_SQL, DENSE_SQL, KNOWN_SIGNAL, PRICE_SQL, hav_sql, lat, lat_sql, level_sql, lon, lon_sql, market_coords, month_start, price_obs,
    prices_dense, query, rounded, table,
)

# ---- distances

_CUST_SUPP = f"""cs AS (SELECT DISTINCT o_custkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
pair AS (SELECT *, {lat_sql('o_custkey')} AS a, {lon_sql('o_custkey')} AS b, {lat_sql('l_suppkey')} AS c, {lon_sql('l_suppkey')} AS d FROM cs)"""


def _trade_pairs(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    keys = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "l_suppkey").distinct()
    return keys.withColumns({"a": lat("o_custkey"), "b": lon("o_custkey"), "c": lat("l_suppkey"), "d": lon("l_suppkey")})


@query("haversine", f"WITH {_CUST_SUPP} SELECT o_custkey, l_suppkey, round({hav_sql('a', 'b', 'c', 'd')}, 6) AS km FROM pair")
def haversine_q(spark, sf):
    return _trade_pairs(spark, sf).select("o_custkey", "l_suppkey", F.round(haversine("a", "b", "c", "d"), 6).alias("km"))


def _vincenty_sql(source: str, keep: str, rounds: int = 12) -> str:
    """Unrolled inverse geodesic of the points (a, b) and (c, d) of ``source``: CTEs up to ``geo``, column km.

    Twelve rounds settle every pair of these few degrees; a pair of equal points has 0.
    """
    f, a = f"({WGS84_F!r}::DOUBLE)", f"({WGS84_A!r}::DOUBLE)"
    steps = [f"""v0 AS MATERIALIZED (SELECT {keep}, atan((1 - {f}) * tan(radians(a))) AS u1, atan((1 - {f}) * tan(radians(c))) AS u2,
        radians(d - b) AS dl, radians(d - b) AS lam FROM {source})"""]
    spot = """sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss,
        sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs, atan2(ss, cs) AS sg, CASE WHEN ss = 0 THEN 0.0::DOUBLE ELSE cos(u1) * cos(u2) * sin(lam) / ss END AS sa,
        1 - sa * sa AS c2, CASE WHEN c2 = 0 THEN 0.0::DOUBLE ELSE cs - 2 * sin(u1) * sin(u2) / c2 END AS mid"""
    for i in range(1, rounds + 1):
        steps.append(f"""v{i} AS MATERIALIZED (SELECT {keep}, u1, u2, dl, dl + (1 - cc) * {f} * sa * (sg + cc * ss * (mid + cc * cs * (2 * mid * mid - 1))) AS lam
          FROM (SELECT *, {f} / 16 * c2 * (4 + {f} * (4 - 3 * c2)) AS cc FROM (SELECT *, {spot} FROM v{i - 1})))""")
    b = f"((1 - {f}) * {a})"
    steps.append(f"""geo AS (SELECT {keep}, {b} * ba * (sg - bb * ss * (mid + bb / 4 * (cs * (2 * mid * mid - 1) - bb / 6 * mid * (4 * ss * ss - 3) * (4 * mid * mid - 3)))) / 1000 AS km
      FROM (SELECT *, 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q))) AS ba, q / 1024 * (256 + q * (-128 + q * (74 - 47 * q))) AS bb
        FROM (SELECT *, c2 * ({a} * {a} - {b} * {b}) / ({b} * {b}) AS q FROM (SELECT *, {spot} FROM v{rounds}))))""")
    return ", ".join(steps)


@query("geodesic", f"WITH {_CUST_SUPP}, {_vincenty_sql('pair', 'o_custkey, l_suppkey')} SELECT o_custkey, l_suppkey, round(km, 6) AS km FROM geo")
def geodesic(spark, sf):
    return _trade_pairs(spark, sf).select("o_custkey", "l_suppkey", F.round(geodesic_km("a", "b", "c", "d"), 6).alias("km"))


def _albers_sql() -> str:
    n, c, rho0, e2 = albers_constants(20.0, -23.0, 0.0)
    e = math.sqrt(e2)
    s = "sin(radians(lat))"
    q = f"(1 - {e2!r}) * ({s} / (1 - {e2!r} * {s} * {s}) - ln((1 - {e!r} * {s}) / (1 + {e!r} * {s})) / (2 * {e!r}))"
    rho, theta = f"{WGS84_A!r} * sqrt({c!r} - ({n!r}) * ({q})) / ({n!r})", f"({n!r}) * radians(lon - 25.0::DOUBLE)"
    return f"WITH {COORD_SQL} SELECT market, round({rho} * sin({theta}), 3) AS x_m, round({rho0!r} - {rho} * cos({theta}), 3) AS y_m FROM coords"


@query("albers", _albers_sql())
def albers(spark, sf):
    x, y = albers_xy("lat", "lon")
    return market_coords(spark, sf).select("market", F.round(x, 3).alias("x_m"), F.round(y, 3).alias("y_m"))


# ---- nearest joins

_NEAR = f"""{COORD_SQL}, cust AS (SELECT c_custkey, {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon FROM customer),
near AS (SELECT c_custkey, market, round({hav_sql('u.lat', 'u.lon', 'm.lat', 'm.lon')}, 6) AS dist_km FROM cust u CROSS JOIN coords m
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY dist_km, market) = 1)"""


def cust_points(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", lat("c_custkey").alias("lat"), lon("c_custkey").alias("lon"))


@query("nearest_market", f"WITH {_NEAR} SELECT * FROM near")
def nearest_market(spark, sf):
    return nearest.nearest_join(cust_points(spark, sf), market_coords(spark, sf), "c_custkey", "market", right_name="market").drop("rank")


def _ranked_sql(k: int) -> str:
    return f"""{COORD_SQL}, ranks AS (SELECT a.market, b.market AS neighbour, round({hav_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 6) AS dist_km,
    row_number() OVER (PARTITION BY a.market ORDER BY dist_km, b.market) AS rank FROM coords a JOIN coords b ON a.market <> b.market
    QUALIFY rank <= {k})"""


@query("neighbour_ranks", f"WITH {_ranked_sql(10)} SELECT market, neighbour, dist_km, CAST(rank AS INTEGER) AS rank FROM ranks")
def neighbour_ranks(spark, sf):
    return nearest.neighbours(market_coords(spark, sf), "market", 10)


@query("topk_neighbours", f"""WITH {COORD_SQL}, cust AS (SELECT c_custkey, {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon FROM customer)
  SELECT c_custkey, market, round({hav_sql('u.lat', 'u.lon', 'm.lat', 'm.lon')}, 6) AS dist_km,
    CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY dist_km, market) AS INTEGER) AS rank FROM cust u CROSS JOIN coords m QUALIFY rank <= 3""")
def topk_neighbours(spark, sf):
    return nearest.nearest_join(cust_points(spark, sf), market_coords(spark, sf), "c_custkey", "market", k=3, right_name="market")


_GEO_NEAR = f"""{COORD_SQL}, pair AS (SELECT c_custkey, market, {lat_sql('c_custkey')} AS a, {lon_sql('c_custkey')} AS b, lat AS c, lon AS d FROM customer CROSS JOIN coords)"""


@query("nearest_geodesic", f"""WITH {_GEO_NEAR}, {_vincenty_sql('pair', 'c_custkey, market')} SELECT c_custkey, market, CAST(round(CAST(round(km, 6) AS DECIMAL(18, 6)), 4) AS DOUBLE) AS dist_km FROM geo
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY round(km, 6), market) = 1""")
def nearest_geodesic(spark, sf):
    near = nearest.nearest_join(
        cust_points(spark, sf), market_coords(spark, sf), "c_custkey", "market", metric="geodesic", right_name="market")
    return rounded(near.drop("rank"), ["dist_km"], 4)


# ---- polygons: one concave five-cornered ring per nation on a 5 x 5 layout

_W, _H = 0.6, 1.6
_SHAPE = ((0.02, 0.03), (0.97, 0.05), (0.93, 0.96), (0.51, 0.47), (0.06, 0.94))


def zone_rings(spark, sf):
    x0 = F.lit(33.0) + (F.col("n_nationkey") % 5) * F.lit(_W)
    y0 = F.lit(-17.0) + F.floor(F.col("n_nationkey") / 5) * F.lit(_H)
    corners = [F.struct((x0 + dx * _W + 0.00137).alias("x"), (y0 + dy * _H + 0.00211).alias("y")) for dx, dy in _SHAPE]
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("zone"), F.array(*corners).alias("ring"))


_EDGES = ", ".join(
    f"({i}, {_SHAPE[i][0]}::DOUBLE, {_SHAPE[i][1]}::DOUBLE, {_SHAPE[(i + 1) % 5][0]}::DOUBLE, {_SHAPE[(i + 1) % 5][1]}::DOUBLE)" for i in range(5))
RING_SQL = f"""edges AS (SELECT n_nationkey AS zone,
    33.0::DOUBLE + (n_nationkey % 5) * {_W}::DOUBLE + ax * {_W}::DOUBLE + 0.00137::DOUBLE AS ax, -17.0::DOUBLE + (n_nationkey // 5) * {_H}::DOUBLE + ay * {_H}::DOUBLE + 0.00211::DOUBLE AS ay,
    33.0::DOUBLE + (n_nationkey % 5) * {_W}::DOUBLE + bx * {_W}::DOUBLE + 0.00137::DOUBLE AS bx, -17.0::DOUBLE + (n_nationkey // 5) * {_H}::DOUBLE + by_ * {_H}::DOUBLE + 0.00211::DOUBLE AS by_
  FROM nation CROSS JOIN (VALUES {_EDGES}) v(i, ax, ay, bx, by_))"""


def _inside_sql(points: str, key: str) -> str:
    return f"""(SELECT {key}, zone FROM {points} CROSS JOIN edges
      GROUP BY ALL HAVING sum(CASE WHEN (ay > lat) <> (by_ > lat) AND lon < ax + (lat - ay) * (bx - ax) / (by_ - ay) THEN 1 ELSE 0 END) % 2 = 1)"""


@query("pip_zone", f"WITH {RING_SQL}, cust AS (SELECT c_custkey, {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon FROM customer) SELECT c_custkey, zone FROM {_inside_sql('cust', 'c_custkey')}")
def pip_zone(spark, sf):
    return point_in_polygon(cust_points(spark, sf), zone_rings(spark, sf)).select("c_custkey", "zone")


@query("ring_area", f"WITH {RING_SQL} SELECT zone, round(abs(sum(ax * by_ - bx * ay)) / 2, 6) AS area FROM edges GROUP BY zone")
def ring_area(spark, sf):
    return zone_rings(spark, sf).select("zone", F.round(area_of("ring"), 6).alias("area"))


# Gridded daily values: shipments at the position of their part, valued by quantity.
@query("zonal_mean", f"""WITH {RING_SQL}, px AS (SELECT l_partkey, CAST(date_trunc('month', l_shipdate)::DATE AS VARCHAR) AS month, l_quantity, {lat_sql('l_partkey')} AS lat, {lon_sql('l_partkey')} AS lon FROM lineitem),
  spot AS (SELECT DISTINCT l_partkey, lat, lon FROM px), ins AS {_inside_sql('spot', 'l_partkey')}
  SELECT zone, month, round(avg(l_quantity), 6) AS mean, min(l_quantity) AS min, max(l_quantity) AS max, count(*) AS pixels FROM px JOIN ins USING (l_partkey) GROUP BY ALL""")
def zonal_mean(spark, sf):
    px = table(spark, sf, "lineitem").select(
        F.trunc(F.to_date("l_shipdate"), "month").cast("string").alias("month"), "l_quantity", lat("l_partkey").alias("lat"), lon("l_partkey").alias("lon"))
    return rounded(area_mean(px, zone_rings(spark, sf), "zone", "l_quantity", ["month"]), ["mean"])


# The same zones with a hole each, and a second part that overlaps the first one and the next zones.
_HOLE = ((0.15, 0.15), (0.85, 0.2), (0.5, 0.4))
_ISLE = ((0.4, 0.3), (1.45, 0.35), (1.3, 0.75), (0.45, 0.7))
_RINGS = ((1, _SHAPE), (1, _HOLE), (2, _ISLE))


def zone_parts(spark, sf):
    x0 = F.lit(33.0) + (F.col("n_nationkey") % 5) * F.lit(_W)
    y0 = F.lit(-17.0) + F.floor(F.col("n_nationkey") / 5) * F.lit(_H)
    rings = [
        F.struct(F.lit(part).alias("part"), F.array(*[
            F.struct((x0 + dx * _W + 0.00137).alias("x"), (y0 + dy * _H + 0.00211).alias("y")) for dx, dy in shape]).alias("ring"))
        for part, shape in _RINGS
    ]
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("zone"), F.explode(F.array(*rings)).alias("r")).select("zone", "r.*")


_PART_EDGES = ", ".join(
    f"({part}, {n}, {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)"
    for n, (part, shape) in enumerate(_RINGS) for a, b in zip(shape, shape[1:] + shape[:1]))
PART_SQL = f"""edges AS (SELECT n_nationkey AS zone, part, ring,
    33.0::DOUBLE + (n_nationkey % 5) * {_W}::DOUBLE + ax * {_W}::DOUBLE + 0.00137::DOUBLE AS ax, -17.0::DOUBLE + (n_nationkey // 5) * {_H}::DOUBLE + ay * {_H}::DOUBLE + 0.00211::DOUBLE AS ay,
    33.0::DOUBLE + (n_nationkey % 5) * {_W}::DOUBLE + bx * {_W}::DOUBLE + 0.00137::DOUBLE AS bx, -17.0::DOUBLE + (n_nationkey // 5) * {_H}::DOUBLE + by_ * {_H}::DOUBLE + 0.00211::DOUBLE AS by_
  FROM nation CROSS JOIN (VALUES {_PART_EDGES}) v(part, ring, ax, ay, bx, by_))"""


def _in_parts_sql(points: str, key: str) -> str:
    return f"""(SELECT DISTINCT {key}, zone FROM (SELECT {key}, zone, part FROM {points} CROSS JOIN edges
      GROUP BY ALL HAVING sum(CASE WHEN (ay > lat) <> (by_ > lat) AND lon < ax + (lat - ay) * (bx - ax) / (by_ - ay) THEN 1 ELSE 0 END) % 2 = 1))"""


@query("pip_parts", f"WITH {PART_SQL}, cust AS (SELECT c_custkey, {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon FROM customer) SELECT c_custkey, zone FROM {_in_parts_sql('cust', 'c_custkey')}")
def pip_parts(spark, sf):
    return point_in_parts(cust_points(spark, sf), zone_parts(spark, sf), "zone", "part").select("c_custkey", "zone")


@query("parts_area", f"""WITH {PART_SQL}, r AS (SELECT zone, part, ring, abs(sum(ax * by_ - bx * ay)) / 2 AS a FROM edges GROUP BY ALL),
  p AS (SELECT zone, part, 2 * max(a) - sum(a) AS a FROM r GROUP BY ALL) SELECT zone, round(sum(a), 6) AS area FROM p GROUP BY zone""")
def parts_area_q(spark, sf):
    return rounded(parts_area(zone_parts(spark, sf), "zone", "part"), ["area"])


@query("zonal_parts", f"""WITH {PART_SQL}, px AS (SELECT l_partkey, CAST(date_trunc('month', l_shipdate)::DATE AS VARCHAR) AS month, l_quantity, {lat_sql('l_partkey')} AS lat, {lon_sql('l_partkey')} AS lon FROM lineitem),
  spot AS (SELECT DISTINCT l_partkey, lat, lon FROM px), ins AS {_in_parts_sql('spot', 'l_partkey')}
  SELECT zone, month, round(avg(l_quantity), 6) AS mean, min(l_quantity) AS min, max(l_quantity) AS max, count(*) AS pixels FROM px JOIN ins USING (l_partkey) GROUP BY ALL""")
def zonal_parts(spark, sf):
    px = table(spark, sf, "lineitem").select(
        F.trunc(F.to_date("l_shipdate"), "month").cast("string").alias("month"), "l_quantity", lat("l_partkey").alias("lat"), lon("l_partkey").alias("lon"))
    return rounded(area_mean(px, zone_parts(spark, sf), "zone", "l_quantity", ["month"], part="part"), ["mean"])


@query("catchment_weights", f"""WITH {COORD_SQL}, {RING_SQL}, px AS (SELECT p_partkey, p_size, {lat_sql('p_partkey')} AS lat, {lon_sql('p_partkey')} AS lon FROM part),
  spots AS (SELECT lat, lon, sum(p_size) AS pop FROM px GROUP BY ALL), ins AS {_inside_sql('spots', 'lat, lon, pop')},
  nr AS (SELECT u.lat, u.lon, market, round({hav_sql('u.lat', 'u.lon', 'm.lat', 'm.lon')}, 6) AS dk FROM (SELECT DISTINCT lat, lon FROM ins) u CROSS JOIN coords m
    QUALIFY row_number() OVER (PARTITION BY u.lat, u.lon ORDER BY dk, market) = 1),
  parts AS (SELECT zone, market, sum(pop) AS pop FROM ins JOIN nr USING (lat, lon) GROUP BY ALL)
  SELECT zone, market, round(CAST(pop AS DOUBLE) / sum(pop) OVER (PARTITION BY zone), 6) AS weight FROM parts""")
def catchment_weights(spark, sf):
    px = table(spark, sf, "part").select("p_size", lat("p_partkey").alias("lat"), lon("p_partkey").alias("lon"))
    return rounded(pr.catchment_weights(px, zone_rings(spark, sf), market_coords(spark, sf), "zone", "p_size"), ["weight"])


# ---- prices

WEIGHT_SQL = """weights AS (SELECT s_suppkey AS market, s_nationkey AS zone, CASE WHEN count(*) OVER w = 1 THEN 1.0::DOUBLE ELSE coalesce(s_acctbal / nullif(sum(s_acctbal) OVER w, 0), 0) END AS weight
  FROM supplier WINDOW w AS (PARTITION BY s_nationkey))"""


def weights(spark, sf):
    supp = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("market"), F.col("s_nationkey").alias("zone"), "s_acctbal")
    return share(supp, ["zone"], "s_acctbal", "weight").select("market", "zone", "weight")


def _month_text(df):
    return df.withColumn("month", F.col("month").cast("string"))


@query("thin_flag", f"WITH {DENSE_SQL} SELECT market, commodity, CAST(month AS VARCHAR) AS month, CAST(price IS NULL AS INTEGER) AS thin FROM dense")
def thin_flag(spark, sf):
    return _month_text(pr.thin_flag(prices_dense(spark, sf)).drop("price"))


@query("thin_rate", """WITH w AS (SELECT l_suppkey AS market, CAST(date_trunc('week', l_shipdate) AS DATE) AS week, avg(l_extendedprice) AS price FROM lineitem GROUP BY ALL),
  g AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS week FROM (SELECT min(week) AS lo, max(week) AS hi FROM w)),
  d AS (SELECT m.market, g.week, w.price FROM (SELECT DISTINCT market FROM w) m CROSS JOIN g LEFT JOIN w ON w.market = m.market AND w.week = g.week)
  SELECT market, CAST(date_trunc('month', week)::DATE AS VARCHAR) AS month, round(avg(CASE WHEN price IS NULL THEN 1.0::DOUBLE ELSE 0 END), 6) AS thin_rate FROM d GROUP BY ALL""")
def thin_rate(spark, sf):
    weekly = table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("market"), F.trunc(F.to_date("l_shipdate"), "week").alias("week")).agg(F.avg("l_extendedprice").alias("price"))
    dense = dense_grid(weekly, ["market"], "week", "7 days").join(weekly, ["market", "week"], "left")
    dense = dense.withColumn("month", F.trunc("week", "month").cast("string"))
    return rounded(pr.thin_rate(dense, ["market", "month"]), ["thin_rate"])


FILL_SQL = f"""{DENSE_SQL}, {COORD_SQL}, lists AS (SELECT a.market, b.market AS donor, round({hav_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 6) AS dist_km FROM coords a JOIN coords b ON a.market <> b.market),
given AS (SELECT d.market, d.commodity, d.month, arg_min(o.price, (dist_km, donor)) AS price, arg_min(donor, (dist_km, donor)) AS donor
  FROM dense d JOIN lists USING (market) JOIN pobs o ON o.market = donor AND o.commodity = d.commodity AND o.month = d.month WHERE d.price IS NULL GROUP BY ALL)"""


@query("spatial_fill", f"""WITH {FILL_SQL} SELECT d.market, d.commodity, CAST(d.month AS VARCHAR) AS month, round(coalesce(d.price, g.price), 6) AS price, g.donor
  FROM dense d LEFT JOIN given g ON g.market = d.market AND g.commodity = d.commodity AND g.month = d.month""")
def spatial_fill(spark, sf):
    return rounded(_month_text(pr.spatial_fill(prices_dense(spark, sf), market_coords(spark, sf)).drop("dist_km")), ["price"])


def _cascade_sql(k: int) -> str:
    steps, prev = [], "dense"
    for i in range(1, k + 1):
        steps.append(f"""c{i} AS MATERIALIZED (SELECT p.market, p.commodity, p.month, coalesce(p.price, q.price) AS price FROM {prev} p
          LEFT JOIN ranks r ON r.market = p.market AND r.rank = {i} LEFT JOIN {prev} q ON q.market = r.neighbour AND q.commodity = p.commodity AND q.month = p.month)""")
        prev = f"c{i}"
    return ", ".join(steps)


# More rounds than any cell of the test tables needs; a round without gaps changes nothing.
_ROUNDS = 20


@query("spatial_fill_cascade", f"""WITH {DENSE_SQL}, {_ranked_sql(_ROUNDS)}, {_cascade_sql(_ROUNDS)} SELECT market, commodity, CAST(month AS VARCHAR) AS month, round(price, 6) AS price FROM c{_ROUNDS}""")
def spatial_fill_cascade(spark, sf):
    return rounded(_month_text(pr.spatial_fill(prices_dense(spark, sf), market_coords(spark, sf), "cascade", 10)), ["price"])


def _growing_sql(k: int) -> str:
    steps, prev = [], "dense"
    for i in range(1, k + 1):
        steps.append(f"""m{i} AS MATERIALIZED (SELECT p.market, p.commodity, p.month, coalesce(p.price, g.price) AS price FROM {prev} p LEFT JOIN (
          SELECT d.market, d.commodity, d.month, quantile_cont(o.price, 0.5) AS price FROM {prev} d JOIN ranks r ON r.market = d.market AND r.rank <= {i}
            JOIN {prev} o ON o.market = r.neighbour AND o.commodity = d.commodity AND o.month = d.month WHERE d.price IS NULL AND o.price IS NOT NULL GROUP BY ALL) g
          ON g.market = p.market AND g.commodity = p.commodity AND g.month = p.month)""")
        prev = f"m{i}"
    return ", ".join(steps)


@query("spatial_fill_growing", f"""WITH {DENSE_SQL}, {_ranked_sql(_ROUNDS)}, {_growing_sql(_ROUNDS)} SELECT market, commodity, CAST(month AS VARCHAR) AS month, round(price, 6) AS price FROM m{_ROUNDS}""")
def spatial_fill_growing(spark, sf):
    return rounded(_month_text(pr.spatial_fill(prices_dense(spark, sf), market_coords(spark, sf), "growing", 10)), ["price"])


@query("spatial_fill_median", f"""WITH {DENSE_SQL}, {_ranked_sql(5)}, g AS (SELECT d.market, d.commodity, d.month, quantile_cont(o.price, 0.5) AS price
    FROM dense d JOIN ranks r USING (market) JOIN pobs o ON o.market = r.neighbour AND o.commodity = d.commodity AND o.month = d.month WHERE d.price IS NULL GROUP BY ALL)
  SELECT d.market, d.commodity, CAST(d.month AS VARCHAR) AS month, round(coalesce(d.price, g.price), 6) AS price
  FROM dense d LEFT JOIN g ON g.market = d.market AND g.commodity = d.commodity AND g.month = d.month""")
def spatial_fill_median(spark, sf):
    return rounded(_month_text(pr.spatial_fill_median(prices_dense(spark, sf), market_coords(spark, sf), 5)), ["price"])


@query("missing_by_k", f"""WITH {DENSE_SQL}, {_ranked_sql(6)}, f AS (SELECT d.market, d.commodity, d.month, min(r.rank) AS k FROM dense d JOIN ranks r USING (market)
    JOIN pobs o ON o.market = r.neighbour AND o.commodity = d.commodity AND o.month = d.month WHERE d.price IS NULL GROUP BY ALL)
  SELECT CAST(s.k AS INTEGER) AS k, (SELECT count(*) FROM dense WHERE price IS NULL) - (SELECT count(*) FROM f WHERE f.k <= s.k) AS missing FROM range(1, 7) s(k)""")
def missing_by_k(spark, sf):
    return pr.missing_by_k(prices_dense(spark, sf), market_coords(spark, sf), 6)


# A series of fewer months is too thin to be used; the nearest customer's stands in for it.
_MONTHS = 8
_ORDERED = f"""months AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY ALL),
  ordered AS (SELECT * FROM months QUALIFY count(*) OVER (PARTITION BY o_custkey) >= {_MONTHS})"""


@query("donor_fill", f"""WITH {_ORDERED}, cust AS (SELECT c_custkey AS o_custkey, {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon FROM customer),
  h AS (SELECT * FROM cust WHERE o_custkey IN (SELECT o_custkey FROM ordered)), l AS (SELECT * FROM cust WHERE o_custkey NOT IN (SELECT o_custkey FROM ordered)),
  d AS (SELECT l.o_custkey, h.o_custkey AS donor, round({hav_sql('l.lat', 'l.lon', 'h.lat', 'h.lon')}, 6) AS dk FROM l CROSS JOIN h QUALIFY row_number() OVER (PARTITION BY l.o_custkey ORDER BY dk, h.o_custkey) = 1)
  SELECT o_custkey, CAST(month AS VARCHAR) AS month, n, o_custkey AS donor FROM ordered
  UNION ALL SELECT d.o_custkey, CAST(month AS VARCHAR), n, d.donor FROM d JOIN ordered o ON o.o_custkey = d.donor""")
def donor_fill(spark, sf):
    months = table(spark, sf, "orders").groupBy(
        "o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    enough = months.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("_m")).filter(F.col("_m") >= _MONTHS)
    series = months.join(enough, "o_custkey", "left_semi")
    return _month_text(pr.donor_fill(series, cust_points(spark, sf).withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"))


@query("weighted_price", f"""WITH {PRICE_SQL}, {WEIGHT_SQL} SELECT zone, commodity, CAST(month AS VARCHAR) AS month, round(sum(price * weight), 6) AS weighted, round(avg(price), 6) AS plain
  FROM pobs JOIN weights USING (market) GROUP BY ALL""")
def weighted_price(spark, sf):
    joined = price_obs(spark, sf).join(weights(spark, sf), "market")
    both = joined.groupBy("zone", "commodity", "month").agg(
        sum_strict(F.col("price") * F.col("weight")).alias("weighted"), F.avg("price").alias("plain"))
    return rounded(_month_text(both), ["weighted", "plain"])


@query("zone_price_join", f"""WITH {DENSE_SQL}, {WEIGHT_SQL} SELECT zone, commodity, CAST(month AS VARCHAR) AS month,
  round(CASE WHEN count(price) = count(*) THEN sum(price * weight) END, 6) AS zone_price FROM dense JOIN weights USING (market) GROUP BY ALL""")
def zone_price_join(spark, sf):
    return rounded(_month_text(pr.zone_price(prices_dense(spark, sf), weights(spark, sf))), ["zone_price"])


@query("point_price", f"""WITH {PRICE_SQL}, {_NEAR} SELECT c_custkey, market, dist_km, commodity, CAST(month AS VARCHAR) AS month, round(price, 6) AS price FROM near JOIN pobs USING (market)""")
def point_price(spark, sf):
    return rounded(_month_text(pr.point_price(cust_points(spark, sf), market_coords(spark, sf), price_obs(spark, sf), "c_custkey")), ["price"])


_ASKED = "asked AS (SELECT DISTINCT o_custkey AS c_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)"


def asked_months(spark, sf):
    """The months in which a customer ordered."""
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), month_start("o_orderdate").alias("month"))


@query("point_price_asked", f"""WITH {PRICE_SQL}, {_NEAR}, {_ASKED} SELECT c_custkey, market, dist_km, commodity, CAST(month AS VARCHAR) AS month, round(price, 6) AS price
  FROM asked JOIN near USING (c_custkey) LEFT JOIN pobs USING (market, month)""")
def point_price_asked(spark, sf):
    found = pr.point_price(cust_points(spark, sf), market_coords(spark, sf), price_obs(spark, sf), "c_custkey", asked_months(spark, sf))
    return rounded(_month_text(found), ["price"])


_KINDS = {"PROMO": "maize", "LARGE": "rice", "SMALL": "nuts", "MEDIUM": "beans"}


@query("price_panel", f"""WITH {FILL_SQL}, full_ AS (SELECT d.market, d.commodity, d.month, coalesce(d.price, g.price) AS price, CAST(d.price IS NULL AS INTEGER) AS thin
    FROM dense d LEFT JOIN given g ON g.market = d.market AND g.commodity = d.commodity AND g.month = d.month), {WEIGHT_SQL},
  z AS (SELECT zone, commodity, month, CASE WHEN count(price) = count(*) THEN sum(price * weight) END AS price, sum(thin * weight) AS thin FROM full_ JOIN weights USING (market) GROUP BY ALL),
  c AS (SELECT market, month, {', '.join(f"max(price) FILTER (commodity = '{v}') AS clust_{n}_price, max(thin) FILTER (commodity = '{v}') AS clust_{n}_mktthin" for v, n in _KINDS.items())} FROM full_ GROUP BY ALL),
  l AS (SELECT zone, month, {', '.join(f"max(price) FILTER (commodity = '{v}') AS lhz_{n}_price, max(thin) FILTER (commodity = '{v}') AS lhz_{n}_mktthin" for v, n in _KINDS.items())} FROM z GROUP BY ALL)
  SELECT c.market, zone, CAST(c.month AS VARCHAR) AS month, {', '.join(f"round(clust_{n}_price, 6) AS clust_{n}_price, clust_{n}_mktthin, round(lhz_{n}_price, 6) AS lhz_{n}_price, round(lhz_{n}_mktthin, 6) AS lhz_{n}_mktthin" for n in _KINDS.values())}
  FROM c JOIN weights USING (market) JOIN l USING (zone, month)""")
def price_panel(spark, sf):
    dense = prices_dense(spark, sf, list(_KINDS))
    filled = pr.spatial_fill(dense, market_coords(spark, sf)).withColumn("thin", F.col("donor").isNotNull().cast("int")).drop("donor", "dist_km")
    w = weights(spark, sf)
    clust = pr.price_panel(filled, ["market", "month"], _KINDS, "price", "clust")
    lhz = pr.price_panel(pr.zone_price_thin(filled, w), ["zone", "month"], _KINDS, "price", "lhz")
    out = clust.join(w.select("market", "zone"), "market").join(lhz, ["zone", "month"])
    return rounded(_month_text(out), [f"{p}_{n}_price" for p in ("clust", "lhz") for n in _KINDS.values()] + [f"lhz_{n}_mktthin" for n in _KINDS.values()])


# A coarse source: one station per supplier nation and a national row, monthly.
def station_frame(spark, sf, asked=None, signal=None):
    supp = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("market"), F.col("s_nationkey").cast("string").alias("station"))
    obs = price_obs(spark, sf).join(supp, "market")
    rows = obs.groupBy(F.col("station").alias("market"), "commodity", "month").agg(F.avg("price").alias("price"))
    national = obs.groupBy("commodity", "month").agg(F.avg("price").alias("price")).withColumn("market", F.lit("national"))
    coords = market_coords(spark, sf).join(supp, "market").groupBy(F.col("station").alias("market")).agg(
        F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon"))
    stations = pr.dense_prices(rows.unionByName(national), ["PROMO"])
    return pr.station_price(stations, coords, cust_points(spark, sf), "c_custkey", "PROMO", "national", asked, signal)


@query("station_price")
def station_price(spark, sf):
    return rounded(_month_text(station_frame(spark, sf)), ["price", "price_lag"])


@query("station_price_known", f"""WITH RECURSIVE {PRICE_SQL}, {COORD_SQL}, {_ASKED},
  st AS (SELECT s_suppkey AS supp, CAST(s_nationkey AS VARCHAR) AS station FROM supplier),
  sobs AS (SELECT station, commodity, month, avg(price) AS price FROM pobs JOIN st ON supp = market GROUP BY ALL),
  stations AS (SELECT s.station, t.month, o.price FROM (SELECT DISTINCT station FROM sobs) s
    CROSS JOIN (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM sobs) t
    LEFT JOIN sobs o ON o.station = s.station AND o.month = t.month AND o.commodity = 'PROMO'),
  {level_sql('stations', 'station', KNOWN_SIGNAL)},
  full_ AS (SELECT station, month, coalesce(price, smooth) AS price FROM numbered JOIN backward USING (station, i)),
  places AS (SELECT station, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon FROM coords JOIN st ON supp = market GROUP BY ALL),
  cust AS (SELECT c_custkey, {lat_sql('c_custkey')} AS lat, {lon_sql('c_custkey')} AS lon FROM customer),
  nearest AS (SELECT c_custkey, station, round({hav_sql('cust.lat', 'cust.lon', 'p.lat', 'p.lon')}, 6) AS dk FROM cust CROSS JOIN places p
    QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY dk, station) = 1)
  SELECT c_custkey, station AS market, CAST(a.month AS VARCHAR) AS month, round(f.price, 6) AS price, round(b.price, 6) AS price_lag
  FROM asked a JOIN nearest USING (c_custkey) LEFT JOIN full_ f USING (station, month) LEFT JOIN full_ b ON b.station = nearest.station AND f.month = b.month + INTERVAL 1 MONTH""")
def station_price_known(spark, sf):
    return rounded(_month_text(station_frame(spark, sf, asked_months(spark, sf), KNOWN_SIGNAL)), ["price", "price_lag"])
