"""Season statistics of the daily rain and temperature stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.plans import seasons as sea
from sparkpanel.queries.base import CROP_YEAR_SQL, RAIN_SQL, SEASON_RAIN_SQL, SEASON_SQL, query, rain_daily, rain_obs, rounded, season_rain, seasons, ship_days, table
from sparkpanel.session import cut_lineage

FLOOD_ZONES = (4, 10, 15)


# Extremes of shipped quantity per supplier nation and day, shifted to kelvin.
def _zone_days(spark, sf):
    supp = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("zone"))
    return table(spark, sf, "lineitem").join(supp, "l_suppkey").groupBy("zone", F.to_date("l_shipdate").alias("day"))


def _extremes():
    return F.max("l_quantity") + sea.KELVIN, F.min("l_quantity") + sea.KELVIN


def temp_daily(spark, sf):
    return _zone_days(spark, sf).agg(F.round(sea.celsius_mean(*_extremes()), 6).alias("tmean"))


TEMP_SQL = """temp AS (
  SELECT s_nationkey AS zone, CAST(l_shipdate AS DATE) AS day,
    round((max(l_quantity) + 273.15::DOUBLE + (min(l_quantity) + 273.15::DOUBLE)) / 2 - 273.15::DOUBLE, 6) AS tmean
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"""

# Medians of five ahead, onset position and dry runs per entity and season.
STATS_SQL = SEASON_RAIN_SQL + """,
num AS (
  SELECT *, row_number() OVER w AS pos,
    CASE WHEN count(rain) OVER five = 5 THEN quantile_cont(rain, 0.5) OVER five END AS med,
    row_number() OVER w - row_number() OVER (PARTITION BY entity, cropyear, rain = 0 ORDER BY day) AS island
  FROM tagged WINDOW w AS (PARTITION BY entity, cropyear ORDER BY day),
    five AS (PARTITION BY entity, cropyear ORDER BY day ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
spells AS (SELECT entity, cropyear, max(len) AS len FROM (
  SELECT entity, cropyear, island, count(*) AS len FROM num WHERE rain = 0 GROUP BY ALL) GROUP BY ALL),
stats AS (
  SELECT n.entity, n.cropyear, sum(rain) AS raincytot, CAST(min(pos) FILTER (med > 2.2) + 2 AS INTEGER) AS day1rain,
    CAST(coalesce(max(len), 0) AS INTEGER) AS maxdaysnorain, max(rain) AS rainmax
  FROM num n LEFT JOIN spells s ON s.entity = n.entity AND s.cropyear = n.cropyear GROUP BY n.entity, n.cropyear)"""


@query("season_total", f"WITH {SEASON_RAIN_SQL} SELECT entity, cropyear, sum(rain) AS raincytot FROM tagged GROUP BY ALL")
def season_total(spark, sf):
    return sea.season_total(season_rain(spark, sf), ["entity"], "rain")


@query("season_max", f"WITH {SEASON_RAIN_SQL} SELECT entity, cropyear, max(rain) AS rainmax FROM tagged GROUP BY ALL")
def season_max(spark, sf):
    return sea.season_max(season_rain(spark, sf), ["entity"], "rain")


@query("season_onset", f"WITH {STATS_SQL} SELECT entity, cropyear, day1rain FROM stats")
def season_onset(spark, sf):
    return sea.season_onset(season_rain(spark, sf), ["entity"], "day", "rain")


@query("season_dry_spell", f"WITH {STATS_SQL} SELECT entity, cropyear, maxdaysnorain FROM stats")
def season_dry_spell(spark, sf):
    return sea.dry_spell(season_rain(spark, sf), ["entity"], "day", "rain")


_CROPYR = CROP_YEAR_SQL


@query("season_onset_legacy", f"""WITH {RAIN_SQL}, f AS (SELECT *, {_CROPYR} AS cropyr, count(rain) OVER w AS n, sum(rain) OVER w AS five,
    sum(CASE WHEN rain = 0 THEN 1 ELSE 0 END) OVER w AS dry FROM rain WINDOW w AS (PARTITION BY entity ORDER BY day ROWS 4 PRECEDING))
  SELECT entity, cropyr, CAST(coalesce(min(CASE month(day) WHEN 10 THEN day(day) WHEN 11 THEN day(day) + 31 WHEN 12 THEN day(day) + 61
    WHEN 1 THEN day(day) + 92 WHEN 2 THEN day(day) + 120 END) FILTER (n = 5 AND five > 10 AND dry < 3), 999) AS INTEGER) AS day1rain FROM f GROUP BY ALL""")
def season_onset_legacy(spark, sf):
    return sea.onset_five_day(rain_daily(spark, sf), ["entity"], "day", "rain", *sea.crop_years(ship_days(spark, sf), "day"))


@query("dry_spell_legacy", f"""WITH {RAIN_SQL}, d AS (SELECT *, {_CROPYR} AS cropyr, CASE WHEN rain = 0 THEN 1 ELSE 0 END AS dry FROM rain),
  l AS (SELECT *, lag(dry) OVER (PARTITION BY entity ORDER BY day) AS was FROM d),
  s AS (SELECT *, sum(CASE WHEN (was = 1 AND dry = 0) OR month(day) BETWEEN 4 AND 9 THEN 1 ELSE 0 END) OVER (PARTITION BY entity, cropyr ORDER BY day) AS spell FROM l)
  SELECT entity, cropyr, CAST(max(n) AS BIGINT) AS maxdaysnorain FROM (SELECT entity, cropyr, spell, sum(dry) AS n FROM s GROUP BY ALL) GROUP BY ALL""")
def dry_spell_legacy(spark, sf):
    obs = cut_lineage(rain_obs(spark, sf))
    return sea.observed_dry_spell_legacy(obs, ["entity"], "day", "rain", *sea.crop_years(obs, "day"))


@query("mean_temp", f"""WITH {TEMP_SQL}, {SEASON_SQL} SELECT zone, cropyear, round(avg(tmean), 6) AS tmean FROM temp JOIN seasons ON day BETWEEN s AND e GROUP BY ALL""")
def mean_temp(spark, sf):
    days = _zone_days(spark, sf)
    hi, lo = _extremes()
    paired = sea.mean_temp(days.agg(hi.alias("tmax")), days.agg(lo.alias("tmin")), ["zone", "day"])
    daily = rounded(paired, ["tmean"])
    return rounded(sea.temp_stats(sea.season_join(daily, "day", seasons(spark, sf)), ["zone"]).drop("gdd", "heatdays"), ["tmean"])


@query("degree_days", f"""WITH {TEMP_SQL}, {SEASON_SQL} SELECT zone, cropyear, count(*) FILTER (tmean > 8 AND tmean < 30) AS gdd, count(*) FILTER (tmean >= 30) AS heatdays
  FROM temp JOIN seasons ON day BETWEEN s AND e GROUP BY ALL""")
def degree_days(spark, sf):
    return sea.temp_stats(sea.season_join(temp_daily(spark, sf), "day", seasons(spark, sf)), ["zone"]).drop("tmean")


@query("flood_exposure", f"""WITH {SEASON_RAIN_SQL}, m AS (SELECT s_nationkey AS zone, cropyear, max(rain) AS rainmax FROM tagged JOIN supplier ON entity = s_suppkey GROUP BY ALL)
  SELECT zone, cropyear AS "FS_year", CASE WHEN zone IN {FLOOD_ZONES} THEN rainmax ELSE 0 END AS floodmax FROM m""")
def flood_exposure(spark, sf):
    supp = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_nationkey").alias("zone"))
    per_zone = season_rain(spark, sf).join(supp, "entity").groupBy("zone", "cropyear").agg(F.max("rain").alias("rainmax"))
    return sea.flood_exposure(per_zone, "zone", FLOOD_ZONES)


def season_table(spark, sf):
    zones = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_nationkey").alias("zone"))
    obs = cut_lineage(rain_obs(spark, sf))
    return sea.season_panel(obs, temp_daily(spark, sf), sea.seasons_spanning(obs, "day"), "entity", "zone", zones, flood_zones=FLOOD_ZONES, observed=True)


PANEL_SQL = f"""{STATS_SQL}, {TEMP_SQL},
heat AS (SELECT zone, cropyear + 1 AS y, avg(tmean) AS tmean, count(*) FILTER (tmean > 8 AND tmean < 30) AS gdd,
  count(*) FILTER (tmean >= 30) AS heatdays FROM temp JOIN seasons ON day BETWEEN s AND e GROUP BY ALL),
located AS (SELECT st.*, s_nationkey AS zone FROM stats st LEFT JOIN supplier ON st.entity = s_suppkey),
flood AS (SELECT zone, y, CASE WHEN zone IN {FLOOD_ZONES} THEN top ELSE 0 END AS floodmax
  FROM (SELECT zone, cropyear AS y, max(rainmax) AS top FROM located GROUP BY ALL)),
season_tab AS (SELECT l.zone, CAST(l.cropyear + 1 AS INTEGER) AS FS_year, l.entity, raincytot, day1rain, maxdaysnorain, rainmax, tmean, gdd, heatdays, floodmax
  FROM located l LEFT JOIN heat h ON h.zone = l.zone AND h.y = l.cropyear + 1 LEFT JOIN flood f ON f.zone = l.zone AND f.y = l.cropyear + 1)"""


@query("season_panel", f"WITH {PANEL_SQL} SELECT * REPLACE (round(tmean, 6) AS tmean) FROM season_tab")
def season_panel(spark, sf):
    return rounded(season_table(spark, sf), ["tmean"])
