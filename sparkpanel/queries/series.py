"""Lags, fills, rolling and running statistics, runs, interpolation, as-of and interval joins."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkpanel.functions.calendar import crop_year_number, season_day as season_day_of
from sparkpanel.operators import joins, windows
from sparkpanel.operators.clean import group_mean_fill as mean_fill
from sparkpanel.operators.state_space import fill_local_level, level_deviance, local_level_fit
from sparkpanel.plans import seasons as sea
from sparkpanel.queries.base import (
    DENSE_SQL, KNOWN_SIGNAL, NATION_MONTH_SQL, RAIN_OBS_SQL, RAIN_SQL, SEASON_RAIN_SQL, level_sql, nation_month, prices_dense, query,
    CROP_YEAR_SQL, rain_daily, rain_obs, rounded, season_rain, ship_days, table,
)


def _text(df, *cols):
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


SERIES = ["market", "commodity"]
# The prices present are irregular in time.
_SEEN = "seen AS (SELECT * FROM dense WHERE price IS NOT NULL)"


def _seen(spark, sf):
    return prices_dense(spark, sf).filter("price IS NOT NULL")


@query("lag_rows", f"""WITH {DENSE_SQL}, {_SEEN} SELECT market, commodity, CAST(month AS VARCHAR) AS month,
  round(lag(price, 1) OVER w, 6) AS price_lag1, round(lag(price, 3) OVER w, 6) AS price_lag3, round(lag(price, 12) OVER w, 6) AS price_lag12
  FROM seen WINDOW w AS (PARTITION BY market, commodity ORDER BY month)""")
def lag_rows(spark, sf):
    df = _seen(spark, sf)
    for n in (1, 3, 12):
        df = windows.lag_rows(df, SERIES, "month", ["price"], n)
    return rounded(_text(df.drop("price"), "month"), ["price_lag1", "price_lag3", "price_lag12"])


@query("lag_calendar", f"""WITH {DENSE_SQL}, {_SEEN} SELECT a.market, a.commodity, CAST(a.month AS VARCHAR) AS month, round(a.price, 6) AS price, round(b.price, 6) AS price_m1, round(c.price, 6) AS price_m12
  FROM seen a LEFT JOIN seen b ON b.market = a.market AND b.commodity = a.commodity AND b.month + INTERVAL 1 MONTH = a.month
  LEFT JOIN seen c ON c.market = a.market AND c.commodity = a.commodity AND c.month + INTERVAL 12 MONTH = a.month""")
def lag_calendar(spark, sf):
    seen = _seen(spark, sf)
    one = windows.lag_calendar(seen, SERIES, "month", ["price"], 1)
    year = windows.lag_calendar(seen, SERIES, "month", ["price"], 12).drop("price")
    return rounded(_text(one.join(year, [*SERIES, "month"]), "month"), ["price", "price_m1", "price_m12"])


@query("fill_group", f"""WITH {DENSE_SQL}, q AS (SELECT *, date_trunc('quarter', month) AS qtr FROM dense),
  f AS (SELECT *, coalesce(price, lag(price, 1) OVER w, lag(price, 2) OVER w) AS filled FROM q WINDOW w AS (PARTITION BY market, commodity, qtr ORDER BY month))
  SELECT market, commodity, CAST(month AS VARCHAR) AS month, round(coalesce(filled, lead(filled) OVER (PARTITION BY market, commodity, qtr ORDER BY month)), 6) AS price FROM f""")
def fill_group(spark, sf):
    df = prices_dense(spark, sf).withColumn("qtr", F.trunc("month", "quarter"))
    out = windows.fill_group(df, [*SERIES, "qtr"], "month", "price").select(*SERIES, "month", "price")
    return rounded(_text(out, "month"), ["price"])


@query("broadcast_mean", """SELECT c_custkey, round(avg(c_acctbal) OVER (PARTITION BY c_nationkey, c_mktsegment), 6) AS "TA_c_acctbal" FROM customer""")
def broadcast_mean(spark, sf):
    out = windows.broadcast_mean(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"], ["c_acctbal"], "TA_")
    return rounded(out.select("c_custkey", "TA_c_acctbal"), ["TA_c_acctbal"])


@query("running_sum", f"""WITH {RAIN_OBS_SQL} SELECT entity, CAST(day AS VARCHAR) AS day, sum(rain) OVER w AS run_rain, max(rain) OVER w AS max_rain
  FROM robs WINDOW w AS (PARTITION BY entity, year(day) ORDER BY day)""")
def running_sum(spark, sf):
    df = rain_obs(spark, sf).withColumn("y", F.year("day"))
    df = windows.running(df, ["entity", "y"], "day", "rain")
    return _text(windows.running(df, ["entity", "y"], "day", "rain", "max", "max_rain").select("entity", "day", "run_rain", "max_rain"), "day")


@query("roll_sum5", f"""WITH {RAIN_SQL}, r AS (SELECT entity, day, CASE WHEN count(rain) OVER w = 5 THEN sum(rain) OVER w END AS roll5_rain
    FROM rain WINDOW w AS (PARTITION BY entity ORDER BY day ROWS 4 PRECEDING))
  SELECT entity, CAST(day AS VARCHAR) AS day, roll5_rain FROM r""")
def roll_sum5(spark, sf):
    out = windows.rolling_sum(rain_daily(spark, sf), ["entity"], "day", "rain", 5).select("entity", "day", "roll5_rain")
    return _text(out, "day")


@query("roll_median5", f"""WITH {SEASON_RAIN_SQL}, r AS (SELECT entity, cropyear, day, CASE WHEN count(rain) OVER w = 5 THEN quantile_cont(rain, 0.5) OVER w END AS med5_rain
    FROM tagged WINDOW w AS (PARTITION BY entity, cropyear ORDER BY day ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING))
  SELECT entity, cropyear, CAST(day AS VARCHAR) AS day, med5_rain FROM r""")
def roll_median5(spark, sf):
    tagged = season_rain(spark, sf)
    out = windows.rolling_median(tagged, ["entity", "cropyear"], "day", "rain", 5)
    return _text(out.select("entity", "cropyear", "day", "med5_rain"), "day")


@query("dry_spell", f"""WITH {RAIN_SQL}, i AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY day)
    - row_number() OVER (PARTITION BY entity, rain = 0 ORDER BY day) AS island FROM rain),
  s AS (SELECT entity, island, count(*) AS len FROM i WHERE rain = 0 GROUP BY entity, island)
  SELECT e.entity, coalesce(max(len), 0) AS longest FROM (SELECT DISTINCT entity FROM rain) e LEFT JOIN s USING (entity) GROUP BY e.entity""")
def dry_spell(spark, sf):
    return windows.longest_run(rain_daily(spark, sf), ["entity"], "day", F.col("rain") == 0).withColumn(
        "longest", F.col("longest").cast("bigint"))


@query("first_rain", f"""WITH {SEASON_RAIN_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY entity, cropyear ORDER BY day) AS pos FROM tagged)
  SELECT entity, cropyear, CAST(min(pos) FILTER (rain > 40) + 2 AS INTEGER) AS first FROM n GROUP BY entity, cropyear""")
def first_rain(spark, sf):
    tagged = season_rain(spark, sf)
    return windows.first_index(tagged, ["entity", "cropyear"], "day", F.col("rain") > 40, 2)


@query("season_day", f"""WITH {RAIN_OBS_SQL} SELECT entity, CAST(day AS VARCHAR) AS day,
  CAST(CASE month(day) WHEN 10 THEN day(day) WHEN 11 THEN day(day) + 31 WHEN 12 THEN day(day) + 61 WHEN 1 THEN day(day) + 92 WHEN 2 THEN day(day) + 123 END AS INTEGER) AS sday,
  CAST(CASE month(day) WHEN 10 THEN day(day) WHEN 11 THEN day(day) + 31 WHEN 12 THEN day(day) + 61 WHEN 1 THEN day(day) + 92 WHEN 2 THEN day(day) + 120 END AS INTEGER) AS sday_legacy,
  CAST(row_number() OVER (PARTITION BY entity, year(day), month(day) ORDER BY day) AS INTEGER) AS daymo FROM robs""")
def season_day(spark, sf):
    w = Window.partitionBy("entity", F.year("day"), F.month("day")).orderBy("day")
    return _text(rain_obs(spark, sf).select(
        "entity", "day", season_day_of("day").alias("sday"), season_day_of("day", legacy=True).alias("sday_legacy"),
        F.row_number().over(w).alias("daymo")), "day")


@query("state_change", f"""WITH {RAIN_SQL}, l AS (SELECT *, lag(rain) OVER (PARTITION BY entity ORDER BY day) AS before FROM rain)
  SELECT entity, CAST(year(day) AS INTEGER) AS y, CAST(sum(CASE WHEN rain > 0 AND before = 0 THEN 1 ELSE 0 END) AS BIGINT) AS wet_starts FROM l GROUP BY ALL""")
def state_change(spark, sf):
    df = windows.state_change(rain_daily(spark, sf), ["entity"], "day", F.col("rain") > 0, "wet")
    return df.groupBy("entity", F.year("day").alias("y")).agg(F.sum("wet").alias("wet_starts"))


@query("interp_linear", f"""WITH {DENSE_SQL}, {_SEEN},
  k AS (SELECT o.market, o.commodity, o.month, o.price,
      max(CASE WHEN price IS NOT NULL THEN month END) OVER (PARTITION BY market, commodity ORDER BY month) AS t0,
      min(CASE WHEN price IS NOT NULL THEN month END) OVER (PARTITION BY market, commodity ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS t1 FROM dense o)
  SELECT k.market, k.commodity, CAST(k.month AS VARCHAR) AS month, round(CASE WHEN k.price IS NOT NULL THEN k.price
      WHEN a.price IS NULL THEN b.price WHEN b.price IS NULL THEN a.price
      ELSE a.price + (b.price - a.price) * CAST(k.month - t0 AS DOUBLE) / CAST(t1 - t0 AS DOUBLE) END, 6) AS price
  FROM k LEFT JOIN seen a ON a.market = k.market AND a.commodity = k.commodity AND a.month = t0 LEFT JOIN seen b ON b.market = k.market AND b.commodity = k.commodity AND b.month = t1""")
def interp_linear(spark, sf):
    return rounded(_text(windows.interp_linear(prices_dense(spark, sf), SERIES, "month", "price"), "month"), ["price"])


_STINE = f"""{DENSE_SQL}, {_SEEN},
  k0 AS (SELECT market, commodity, month AS t, price AS y, CAST(greatest(max(month) OVER s - min(month) OVER s, 1) AS DOUBLE) AS sx,
      coalesce(nullif(max(price) OVER s - min(price) OVER s, 0), 1.0::DOUBLE) AS sy FROM seen WINDOW s AS (PARTITION BY market, commodity)),
  k1 AS (SELECT *, CAST(t - lag(t) OVER w AS DOUBLE) / sx AS dl, (y - lag(y) OVER w) / sy AS el, CAST(lead(t) OVER w - t AS DOUBLE) / sx AS dr, (lead(y) OVER w - y) / sy AS er
      FROM k0 WINDOW w AS (PARTITION BY market, commodity ORDER BY t)),
  k2 AS (SELECT *, el / dl AS sl, er / dr AS sr, (el / dl * (dr * dr + er * er) + er / dr * (dl * dl + el * el)) / (dl * dl + el * el + dr * dr + er * er) AS mid FROM k1),
  k3 AS (SELECT *, coalesce(sl, sr) AS ch, CASE WHEN sl IS NULL THEN lead(mid) OVER w ELSE lag(mid) OVER w END AS nb FROM k2 WINDOW w AS (PARTITION BY market, commodity ORDER BY t)),
  k4 AS (SELECT market, commodity, t, y, sy / sx * coalesce(mid, CASE WHEN nb IS NULL THEN ch WHEN (ch >= 0 AND ch >= nb) OR (ch <= 0 AND ch <= nb) THEN 2 * ch - nb
      ELSE coalesce(ch + abs(ch) * (ch - nb) / nullif(abs(ch) + abs(ch - nb), 0), ch) END, 0.0) AS yp FROM k3),
  p AS (SELECT d.market, d.commodity, d.month, d.price,
      max(CASE WHEN d.price IS NOT NULL THEN d.month END) OVER (PARTITION BY d.market, d.commodity ORDER BY d.month) AS t0,
      min(CASE WHEN d.price IS NOT NULL THEN d.month END) OVER (PARTITION BY d.market, d.commodity ORDER BY d.month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS t1 FROM dense d),
  q AS (SELECT p.*, a.y AS y0, a.yp AS yp0, b.y AS y1, b.yp AS yp1, CAST(t1 - t0 AS DOUBLE) AS dx, CAST(p.month - t0 AS DOUBLE) AS u, CAST(p.month - t1 AS DOUBLE) AS v,
      (b.y - a.y) / nullif(CAST(t1 - t0 AS DOUBLE), 0) AS s FROM p LEFT JOIN k4 a ON a.market = p.market AND a.commodity = p.commodity AND a.t = t0
      LEFT JOIN k4 b ON b.market = p.market AND b.commodity = p.commodity AND b.t = t1),
  r AS (SELECT *, y0 + s * u AS chord, (yp0 - s) * u AS d1, (yp1 - s) * v AS d2 FROM q)"""


@query("interp_stine", f"""WITH {_STINE} SELECT market, commodity, CAST(month AS VARCHAR) AS month, round(coalesce(price, CASE WHEN d1 * d2 > 0 THEN chord + d1 * d2 / nullif(d1 + d2, 0)
    WHEN d1 * d2 < 0 THEN chord + d1 * d2 * (u + v) / ((d1 - d2) * nullif(dx, 0)) ELSE chord END, y0, y1), 6) AS price FROM r""")
def interp_stine(spark, sf):
    return rounded(_text(windows.interp_stine(prices_dense(spark, sf), SERIES, "month", "price"), "month"), ["price"])


@query("fill_kalman")
def fill_kalman(spark, sf):
    return rounded(_text(fill_local_level(prices_dense(spark, sf), SERIES, "month", "price"), "month"), ["filled"])


@query("fill_kalman_known", f"""WITH RECURSIVE {DENSE_SQL}, {level_sql('dense', 'market, commodity', KNOWN_SIGNAL)}
  SELECT market, commodity, CAST(month AS VARCHAR) AS month, round(coalesce(price, smooth), 6) AS filled FROM numbered JOIN backward USING (market, commodity, i)""")
def fill_kalman_known(spark, sf):
    filled = fill_local_level(prices_dense(spark, sf), SERIES, "month", "price", signal=KNOWN_SIGNAL)
    return rounded(_text(filled, "month"), ["filled"])


@query("level_optimum", f"""WITH {DENSE_SQL} SELECT market, commodity, count(price) AS n_known, true AS likeliest FROM dense GROUP BY ALL HAVING count(price) > 2""")
def level_optimum(spark, sf):
    # The fitted signal against its neighbours and a row of others, by a filter that is written in SQL functions.
    fits = local_level_fit(prices_dense(spark, sf), SERIES, "month", "price").filter("n_known > 2")
    values, angle = F.transform("steps", lambda s: s["value"]), F.asin(F.sqrt("signal"))
    beside = [F.greatest(angle - 0.005, F.lit(0.0)), F.least(angle + 0.005, F.lit(math.pi / 2))]
    angles = F.array(*beside, *[F.lit(math.pi / 2 * i / 8) for i in range(9)])
    others = F.transform(angles, lambda a: level_deviance(values, F.pow(F.sin(a), 2)))
    likeliest = level_deviance(values, F.col("signal")) <= F.array_min(others) + 1e-7
    return fits.select(*SERIES, "n_known", likeliest.alias("likeliest"))


@query("trend_days", """SELECT o_orderkey, CAST(o_orderdate::DATE - (SELECT min(o_orderdate)::DATE FROM orders) AS INTEGER) AS trend,
  CAST(pow(o_orderdate::DATE - (SELECT min(o_orderdate)::DATE FROM orders), 2) AS BIGINT) AS trend2 FROM orders""")
def trend_days(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return windows.trend_days(df, "day").select("o_orderkey", "trend", "trend2")


@query("rain_deviation", f"""WITH {SEASON_RAIN_SQL}, t AS (SELECT entity, cropyear, sum(rain) AS total FROM tagged GROUP BY ALL),
  d AS (SELECT *, total - avg(total) OVER (PARTITION BY entity) AS dev, avg(total) OVER (PARTITION BY entity) AS norm FROM t)
  SELECT entity, cropyear, total, round(norm, 5) AS norm, round(CASE WHEN dev > 0 THEN dev * dev ELSE 0 END, 5) AS pos_dev, round(CASE WHEN dev < 0 THEN dev * dev ELSE 0 END, 5) AS neg_dev,
    round(sqrt(CASE WHEN dev > 0 THEN dev * dev ELSE 0 END), 5) AS pos_root, round(sqrt(CASE WHEN dev < 0 THEN dev * dev ELSE 0 END), 5) AS neg_root FROM d""")
def rain_deviation(spark, sf):
    total = sea.season_total(season_rain(spark, sf), ["entity"], "rain").withColumnRenamed("raincytot", "total")
    return rounded(windows.deviation(total, ["entity"], "total"), ["norm", "pos_dev", "neg_dev", "pos_root", "neg_root"], 5)


_SLOTS = {10: "rain_Oct", 11: "rain_Nov", 12: "rain_Dec", 1: "rain_Jan", 2: "rain_Feb", 3: "rain_Mar", 4: "rain_Apr"}


@query("month_slots", f"""WITH {RAIN_OBS_SQL}, r AS (SELECT *, {CROP_YEAR_SQL} AS cropyr FROM robs),
  m AS (SELECT entity, cropyr, {', '.join(f"sum(CASE WHEN month(day) = {k} THEN rain ELSE 0 END) AS {v}" for k, v in _SLOTS.items())} FROM r GROUP BY ALL)
  SELECT *, {' + '.join(_SLOTS.values())} AS rain_cytot FROM m""")
def month_slots(spark, sf):
    df = rain_obs(spark, sf).withColumn("cropyr", crop_year_number("day", *sea.crop_years(ship_days(spark, sf), "day")))
    return windows.month_slots(df, ["entity", "cropyr"], "day", "rain", _SLOTS, "rain_cytot")


@query("group_mean_fill", """WITH h AS (SELECT o_orderkey, o_custkey, year(o_orderdate) AS y, CASE WHEN o_totalprice > 100000 THEN ln(o_totalprice) END AS v FROM orders)
  SELECT o_orderkey, round(coalesce(v, avg(v) OVER (PARTITION BY o_custkey, y)), 6) AS v FROM h""")
def group_mean_fill(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"), F.when(F.col("o_totalprice") > 100000, F.log("o_totalprice")).alias("v"))
    return rounded(mean_fill(df, ["o_custkey", "y"], ["v"]).select("o_orderkey", "v"), ["v"])


# Phase snapshots 1-3 per nation at the irregular months where orders are many or few.
PHASE_SQL = f"""{NATION_MONTH_SQL}, snaps AS (SELECT zone, month, CAST(CASE WHEN value > 12.2 THEN 1 WHEN value > 12.0 THEN 2 ELSE 3 END AS INTEGER) AS phase
  FROM nm WHERE month(month) IN (1, 4, 7, 10) AND NOT (year(month) = 1998 AND month(month) = 7))"""


def phases(spark, sf):
    m = F.month("month")
    nm = nation_month(spark, sf).filter(m.isin(1, 4, 7, 10) & ~((F.year("month") == 1998) & (m == 7)))
    return nm.select("zone", "month", F.when(F.col("value") > 12.2, 1).when(F.col("value") > 12.0, 2).otherwise(3).alias("phase"))


@query("asof_phase", f"""WITH {PHASE_SQL} SELECT o.o_orderkey, c_nationkey AS zone, s.phase FROM orders o JOIN customer ON o_custkey = c_custkey
  ASOF LEFT JOIN snaps s ON s.zone = c_nationkey AND s.month <= CAST(o.o_orderdate AS DATE)""")
def asof_phase(spark, sf):
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("zone"))
    left = table(spark, sf, "orders").join(cust, "o_custkey").select("o_orderkey", "zone", F.to_date("o_orderdate").alias("month"))
    return joins.asof_join(left, phases(spark, sf), "month", ["zone"], ["phase"]).select("o_orderkey", "zone", "phase")


@query("asof_next_phase", f"""WITH {PHASE_SQL} SELECT o.o_orderkey, c_nationkey AS zone, s.phase FROM orders o JOIN customer ON o_custkey = c_custkey
  ASOF LEFT JOIN snaps s ON s.zone = c_nationkey AND s.month >= CAST(o.o_orderdate AS DATE)""")
def asof_next_phase(spark, sf):
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("zone"))
    left = table(spark, sf, "orders").join(cust, "o_custkey").select("o_orderkey", "zone", F.to_date("o_orderdate").alias("month"))
    return joins.asof_join(left, phases(spark, sf), "month", ["zone"], ["phase"], "forward").select("o_orderkey", "zone", "phase")


@query("season_interval", """WITH s AS (SELECT CAST(y AS INTEGER) AS cropyear, make_date(y, 3, 1) AS s, make_date(y + 1, 7, 1) AS e FROM (SELECT unnest(range(year(min(l_shipdate)) - 1, year(max(l_shipdate)) + 1)) AS y FROM lineitem))
  SELECT l_suppkey, cropyear, count(*) AS n, sum(l_quantity) AS qty FROM lineitem JOIN s ON CAST(l_shipdate AS DATE) BETWEEN s.s AND s.e GROUP BY ALL""")
def season_interval(spark, sf):
    # Sixteen-month windows overlap, so a shipment can count in two seasons.
    cal = sea.seasons_spanning(ship_days(spark, sf), "day", "03-01", "07-01", 1)
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", F.to_date("l_shipdate").alias("day"))
    return sea.season_join(li, "day", cal).groupBy("l_suppkey", "cropyear").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))
