"""Household scores and the household and cluster panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.operators.aggregates import collapse_mean
from sparkpanel.operators.joins import asof_join
from sparkpanel.operators.windows import lag_rows
from sparkpanel.plans import panel, scores
from sparkpanel.plans.prices import dense_prices, spatial_fill, zone_price_thin
from sparkpanel.queries.base import ORACLES, lat, lat_sql, market_coords, price_obs, query, rounded, table
from sparkpanel.queries.market import FILL_SQL, WEIGHT_SQL, weights
from sparkpanel.queries.series import PHASE_SQL, phases
from sparkpanel.queries.weather import PANEL_SQL, season_table
from sparkpanel.session import cut_lineage


def food_items(lines):
    """Item rows per household: ten food groups by part, days 0 to 8 by quantity."""
    return lines.select(
        F.col("l_orderkey").alias("hh"), (F.col("l_partkey") % 10 + 1).cast("int").alias("code"),
        (F.col("l_quantity").cast("int") % 9).alias("days"),
    )


GROUP_SQL = """grp AS (SELECT hh, g, max(d) AS d FROM (
  SELECT l_orderkey AS hh, CASE WHEN l_partkey % 10 < 2 THEN 'AB' ELSE chr(CAST(65 + l_partkey % 10 AS INTEGER)) END AS g,
    CASE WHEN CAST(l_quantity AS INTEGER) % 9 = 8 THEN 7 ELSE CAST(l_quantity AS INTEGER) % 9 END AS d FROM lineitem) GROUP BY hh, g),
fcs AS (SELECT hh, sum(d * CASE g WHEN 'AB' THEN 2 WHEN 'C' THEN 3 WHEN 'D' THEN 1 WHEN 'E' THEN 4 WHEN 'F' THEN 1 WHEN 'G' THEN 4
  WHEN 'H' THEN 0.5::DOUBLE WHEN 'I' THEN 0.5::DOUBLE ELSE 0 END) AS FCS,
  count(*) FILTER (g NOT IN ('I', 'J') AND d >= 1) AS HDDS FROM grp GROUP BY hh)"""


def lettered(spark, sf):
    return scores.letter_groups(food_items(table(spark, sf, "lineitem")), "code", "group")


@query("fcs", f'WITH {GROUP_SQL} SELECT hh, FCS AS "FCS" FROM fcs')
def fcs(spark, sf):
    return scores.food_consumption_score(lettered(spark, sf), "hh", "group", "days")


@query("hdds", f'WITH {GROUP_SQL} SELECT hh, HDDS AS "HDDS" FROM fcs')
def hdds(spark, sf):
    return scores.dietary_diversity(lettered(spark, sf), "hh", "group", "days")


def coping(spark, sf):
    """Five answers 0 to 7 per order; the last is missing for low priority orders."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", (k % 8).alias("h02a"), (c % 8).alias("h02b"), (k * 7 % 8).alias("h02c"), (c * 3 % 8).alias("h02d"),
        F.when(F.col("o_orderpriority") != "5-LOW", (k + c) % 8).alias("h02e"))


_ANSWERS = ["h02a", "h02b", "h02c", "h02d", "h02e"]
_COPING = """cop AS (SELECT o_orderkey, o_orderkey % 8 + o_custkey % 8 + 2 * (o_orderkey * 7 % 8) + 2 * (o_custkey * 3 % 8)
  + 2 * CASE WHEN o_orderpriority <> '5-LOW' THEN (o_orderkey + o_custkey) % 8 END AS s FROM orders)"""


@query("rcsi", f"""WITH {_COPING} SELECT o_orderkey, CASE WHEN s IS NOT NULL THEN least(s, 42) END AS "rCSI", least(coalesce(s, 42), 42) AS "rCSI_stata" FROM cop""")
def rcsi(spark, sf):
    out = scores.coping_index(coping(spark, sf), _ANSWERS)
    return scores.coping_index(out, _ANSWERS, name="rCSI_stata", stata_missing=True).select("o_orderkey", "rCSI", "rCSI_stata")


@query("mahfp", """WITH m AS (SELECT o_custkey AS hh, max(CASE WHEN c_acctbal > 0 THEN 1 ELSE 2 END) AS gate, count(DISTINCT month(o_orderdate)) FILTER (o_totalprice < 150000) AS marks
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey)
  SELECT hh, CAST(12 - CASE WHEN gate = 1 THEN marks ELSE 0 END AS INTEGER) AS "MAHFP" FROM m""")
def mahfp(spark, sf):
    # A month is marked when the customer had a small order in it.
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_acctbal") > 0, 1).otherwise(2).alias("gate"))
    small = F.col("o_totalprice") < 150000
    marks = [F.max(F.when(small & (F.month("o_orderdate") == m), "X")).alias(f"m{m:02d}") for m in range(1, 13)]
    wide = table(spark, sf, "orders").join(cust, "o_custkey").groupBy(F.col("o_custkey").alias("hh")).agg(F.max("gate").alias("gate"), *marks)
    return scores.months_adequate(wide, [f"m{m:02d}" for m in range(1, 13)], "gate").select("hh", "MAHFP")


@query("top_reasons", """WITH u AS (SELECT 'first' AS question, CAST(l_linenumber AS BIGINT) AS reason FROM lineitem UNION ALL SELECT 'second', l_partkey % 9 + 1 FROM lineitem),
  c AS (SELECT question, reason, count(*) AS n FROM u GROUP BY ALL)
  SELECT question, reason, n, CAST(row_number() OVER (PARTITION BY question ORDER BY n DESC, reason) AS INTEGER) AS rank FROM c QUALIFY rank <= 3""")
def top_reasons(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_linenumber").cast("bigint").alias("first"), (F.col("l_partkey") % 9 + 1).alias("second"))
    return scores.rank_reasons(li, ["first", "second"])


_CODES = scores.ASSET_CODES


def asset_items(lines):
    codes = F.array(*[F.lit(c) for c in _CODES])
    return lines.select(
        F.col("l_orderkey").alias("hh"), F.get(codes, (F.col("l_partkey") % 6).cast("int")).alias("code"),
        (F.col("l_quantity").cast("int") % 3).alias("qty"))


@query("asset_dummies", "SELECT l_orderkey AS hh, " + ", ".join(
    f"CAST(coalesce(sum(CAST(l_quantity AS INTEGER) % 3) FILTER (l_partkey % 6 = {i}), 0) <> 0 AS INTEGER) AS asset_{c}" for i, c in enumerate(_CODES)
) + " FROM lineitem GROUP BY l_orderkey")
def asset_dummies(spark, sf):
    return scores.asset_dummies(asset_items(table(spark, sf, "lineitem")), "hh", "code", "qty")


@query("asset_index")
def asset_index(spark, sf):
    wide = asset_dummies(spark, sf)
    cols = [f"asset_{c}" for c in _CODES]
    out = scores.asset_index(wide, cols, "rotated")
    return rounded(scores.asset_index(out, cols, "unrotated", rotate=False).select("hh", "rotated", "unrotated"), ["rotated", "unrotated"])


# The largest component: the correlations squared again and again leave its vector alone.
_N = len(_CODES)
_EACH = f"range(1, {_N + 1})"


@query("asset_component", f"""WITH RECURSIVE d AS ({ORACLES['asset_dummies']}), z AS (SELECT hh, [{', '.join(f'asset_{c}' for c in _CODES)}] AS z FROM d),
  c AS (SELECT i, j, corr(z[i], z[j]) AS v FROM z, {_EACH} a(i), {_EACH} b(j) GROUP BY i, j), lines AS (SELECT i, list(v ORDER BY j) AS r FROM c GROUP BY i),
  r AS (SELECT list(r ORDER BY i) AS r FROM lines),
  power AS (SELECT 0 AS k, r AS m FROM r
    UNION ALL SELECT k + 1, list_transform({_EACH}, lambda i: list_transform({_EACH}, lambda j: list_sum(list_transform({_EACH}, lambda l: m[i][l] * m[l][j]))
      / list_sum(list_transform({_EACH}, lambda g: list_sum(list_transform({_EACH}, lambda l: m[g][l] * m[l][g])))))) FROM power WHERE k < 24),
  top AS (SELECT m, list_transform({_EACH}, lambda i: m[i][i]) AS diag, list_position(diag, list_max(diag)) AS big, list_transform({_EACH}, lambda i: m[i][big] / sqrt(m[big][big])) AS v FROM power WHERE k = 24),
  w AS (SELECT v, list_sum(list_transform({_EACH}, lambda i: v[i] * list_sum(list_transform({_EACH}, lambda j: r[i][j] * v[j])))) AS size FROM top, r),
  s AS (SELECT i, avg(z[i]) AS mean, stddev_samp(z[i]) AS sd FROM z, {_EACH} a(i) GROUP BY i)
  SELECT hh, round(sum((z[i] - mean) / sd * v[i] / sqrt(size)), 6) AS score FROM z, s, w GROUP BY hh""")
def asset_component(spark, sf):
    wide = asset_dummies(spark, sf)
    out = scores.asset_index(wide, [f"asset_{c}" for c in _CODES], "score", rotate=False)
    return rounded(out.select("hh", "score"), ["score"])


@query("land_share", """SELECT p_partkey, CASE WHEN p_size IN (20, 30) THEN 0.6::DOUBLE WHEN p_size = 14 THEN 1 ELSE 0 END AS percent_ag,
  CAST(p_size IN (5, 6, 7) AS INTEGER) AS terrain_rough, 0 AS terrain_published, CAST(p_size = 2 AS INTEGER) AS moderate FROM part""")
def land_share(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", scores.land_share("p_size").alias("percent_ag"), scores.terrain_rough("p_size", (5, 6, 7)).alias("terrain_rough"),
        scores.terrain_rough("p_size", (5, 6, 7), strict_reference=True).alias("terrain_published"),
        scores.nutrient_flags("p_size")["nutri_moderate_constraint"].alias("moderate"))


@query("region_fill", f"""WITH b AS (SELECT c_custkey AS ea_id, {lat_sql('c_custkey')} AS lat, CASE WHEN o_orderstatus = 'P' THEN '' WHEN c_nationkey < 9 THEN 'South' WHEN c_nationkey < 17 THEN 'Central' ELSE 'North' END AS region,
    CAST(year(o_orderdate) AS INTEGER) AS FS_year FROM orders JOIN customer ON o_custkey = c_custkey),
  k AS (SELECT ea_id, FS_year, min(nullif(region, '')) AS label, avg(lat) AS lat FROM b GROUP BY ALL),
  l AS (SELECT min(lat) AS lo, (max(lat) - min(lat)) / 3 AS w FROM k WHERE label IS NULL)
  SELECT ea_id, FS_year AS "FS_year", coalesce(label, CASE WHEN lat <= lo + w THEN 'South' WHEN lat <= lo + w * 2 THEN 'Central' ELSE 'North' END) AS region FROM k, l""")
def region_fill(spark, sf):
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("ea_id"), "c_nationkey")
    n = F.col("c_nationkey")
    region = F.when(F.col("o_orderstatus") == "P", "").when(n < 9, "South").when(n < 17, "Central").otherwise("North")
    base = table(spark, sf, "orders").withColumnRenamed("o_custkey", "ea_id").join(cust, "ea_id").select(
        "ea_id", F.year("o_orderdate").alias("FS_year"), region.alias("region"), lat("ea_id").alias("lat"))
    return scores.region_fill(base, ["ea_id", "FS_year"], "region", "lat")


# ---- household master: orders as households, customers as clusters, nations as zones

HH_SQL = f"""{GROUP_SQL}, {_COPING},
hhb AS (SELECT o.o_orderkey AS case_id, o_custkey AS ea_id, c_nationkey AS zone, concat(c_nationkey, '_', c_mktsegment) AS TA_names, r_name AS region,
    CAST(year(o_orderdate) AS INTEGER) AS FS_year, CAST((o_custkey + year(o_orderdate)) % 12 + 1 AS INTEGER) AS FS_month,
    make_date(year(o_orderdate), (o_custkey + year(o_orderdate)) % 12 + 1, 1) AS month, FCS, HDDS, CASE WHEN s IS NOT NULL THEN least(s, 42) END AS rCSI,
    1 + o.o_orderkey % 9 AS hhsize, 20 + o.o_orderkey * 7 % 50 AS hh_age, o.o_orderkey % 2 AS hh_gender,
    CAST(o_orderstatus = 'F' AS INTEGER) AS roof_natural_inverse, o.o_orderkey % 4 AS number_celphones, o_custkey * 13 % 2000 AS elevation,
    o_custkey * 29 % 100 AS dist_road, o_custkey * 31 % 50 AS dist_admarc, c_acctbal / 10000 AS percent_ag, CAST(o_custkey % 3 = 1 AS INTEGER) AS nutri
  FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN fcs ON fcs.hh = o.o_orderkey LEFT JOIN cop ON cop.o_orderkey = o.o_orderkey)"""


def households(spark, sf):
    cust = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key, ea = F.col("o_orderkey"), F.col("o_custkey")
    year = F.year("o_orderdate")
    month = ((ea + year) % 12 + 1).cast("int")
    cope = scores.coping_index(coping(spark, sf), _ANSWERS).select(F.col("o_orderkey").alias("case_id"), "rCSI")
    base = table(spark, sf, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
        key.alias("case_id"), ea.alias("ea_id"), F.col("c_nationkey").alias("zone"), F.concat_ws("_", "c_nationkey", "c_mktsegment").alias("TA_names"),
        F.col("r_name").alias("region"), year.alias("FS_year"), month.alias("FS_month"), F.make_date(year, month, F.lit(1)).alias("month"),
        (1 + key % 9).alias("hhsize"), (20 + key * 7 % 50).alias("hh_age"), (key % 2).alias("hh_gender"),
        (F.col("o_orderstatus") == "F").cast("int").alias("roof_natural_inverse"), (key % 4).alias("number_celphones"), (ea * 13 % 2000).alias("elevation"),
        (ea * 29 % 100).alias("dist_road"), (ea * 31 % 50).alias("dist_admarc"), (F.col("c_acctbal") / 10000).alias("percent_ag"), (ea % 3 == 1).cast("int").alias("nutri"))
    out = base.join(household_items(spark, sf), "case_id", "left").join(cope, "case_id", "left")
    # The status one snapshot before the one in force, as of the interview month.
    before = lag_rows(phases(spark, sf), ["zone"], "month", ["phase"], 1, "1").withColumnRenamed("phase1", "IPC1")
    return asof_join(out, before, "month", ["zone"], ["IPC1"])


def household_items(spark, sf):
    """Food scores and rotated asset index of each household with items.

    Item rows are dealt out by household once, for both groupings and for what joins them.
    """
    dealt = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity").repartition("l_orderkey")
    assets = scores.asset_dummies(asset_items(dealt), "hh", "code", "qty")
    food = scores.food_scores(scores.letter_groups(food_items(dealt), "code", "group"), "hh", "group", "days")
    # A full join reads what was dealt out once. Items without a household count for the index, but none joins them.
    wide = cut_lineage(assets.join(food, "hh", "full"))
    return scores.asset_index(wide, [f"asset_{c}" for c in _CODES], "asset").select(F.col("hh").alias("case_id"), "FCS", "HDDS", "asset")


# Prices of one commodity on its own grid, gaps from the nearest market, averaged by market weight.
ZONE_PRICE_SQL = f"""{FILL_SQL.replace('ON l_partkey = p_partkey GROUP BY', "ON l_partkey = p_partkey WHERE p_type = 'PROMO' GROUP BY")}, {WEIGHT_SQL},
zp AS (SELECT zone, d.month, CASE WHEN count(coalesce(d.price, g.price)) = count(*) THEN sum(coalesce(d.price, g.price) * weight) END AS maize,
    sum(CAST(d.price IS NULL AND g.price IS NOT NULL AS INTEGER) * weight) AS maize_mktthin
  FROM dense d LEFT JOIN given g ON g.market = d.market AND g.commodity = d.commodity AND g.month = d.month JOIN weights w ON w.market = d.market GROUP BY ALL)"""


def zone_prices(spark, sf):
    one = dense_prices(price_obs(spark, sf).filter("commodity = 'PROMO'"))
    filled = spatial_fill(one, market_coords(spark, sf)).withColumn("thin", F.col("donor").isNotNull().cast("int"))
    out = zone_price_thin(filled.drop("donor", "dist_km"), weights(spark, sf))
    return out.select("zone", "month", F.col("price").alias("maize"), F.col("thin").alias("maize_mktthin"))


_WEATHER = ["raincytot", "day1rain", "maxdaysnorain", "floodmax", "tmean", "gdd", "heatdays"]
ZONE_SEASON_SQL = f"""{PANEL_SQL}, zs AS (SELECT zone, FS_year, {', '.join(f'avg({c}) AS {c}' for c in _WEATHER)} FROM season_tab GROUP BY ALL)"""


def zone_seasons(spark, sf):
    return collapse_mean(season_table(spark, sf).select("zone", "FS_year", *_WEATHER), ["zone", "FS_year"])


MASTER_SQL = f"""{HH_SQL}, {ZONE_PRICE_SQL}, {ZONE_SEASON_SQL}, {PHASE_SQL},
prior AS (SELECT zone, month, lag(phase) OVER (PARTITION BY zone ORDER BY month) AS IPC1 FROM snaps),
hhp AS (SELECT h.*, IPC1 FROM hhb h ASOF LEFT JOIN prior s ON s.zone = h.zone AND s.month <= h.month),
master AS (SELECT h.*, p.maize AS maize_current, p.maize_mktthin AS maize_mktthin_current, q.maize AS maize_lag, q.maize_mktthin AS maize_mktthin_lag,
    {', '.join(_WEATHER)} FROM hhp h LEFT JOIN zp p ON p.zone = h.zone AND p.month = h.month LEFT JOIN zp q ON q.zone = h.zone AND q.month + INTERVAL 1 MONTH = h.month
  LEFT JOIN zs ON zs.zone = h.zone AND zs.FS_year = h.FS_year WHERE p.maize IS NOT NULL AND raincytot IS NOT NULL)"""


def master(spark, sf):
    return panel.hh_panel(households(spark, sf), zone_prices(spark, sf), zone_seasons(spark, sf), ["zone"], ["zone", "FS_year"],
                          required=["zone", "maize_current", "raincytot"])


@query("hh_panel", f"""WITH {MASTER_SQL} SELECT case_id, ea_id, zone, TA_names AS "TA_names", region, FS_year AS "FS_year", FS_month AS "FS_month",
  FCS AS "FCS", HDDS AS "HDDS", rCSI AS "rCSI", IPC1 AS "IPC1", round(maize_current, 6) AS maize_current, round(maize_lag, 6) AS maize_lag, round(maize_mktthin_current, 6) AS maize_mktthin_current, round(raincytot, 6) AS raincytot,
  round(day1rain, 6) AS day1rain, round(maxdaysnorain, 6) AS maxdaysnorain, round(floodmax, 6) AS floodmax, round(tmean, 6) AS tmean FROM master""")
def hh_panel(spark, sf):
    cols = ["maize_current", "maize_lag", "maize_mktthin_current", "raincytot", "day1rain", "maxdaysnorain", "floodmax", "tmean"]
    return rounded(master(spark, sf).select(
        "case_id", "ea_id", "zone", "TA_names", "region", "FS_year", "FS_month", "FCS", "HDDS", "rCSI", "IPC1", *cols), cols)


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_TA = ["maize_current", "maize_mktthin_current", "raincytot", "day1rain", "maxdaysnorain", "floodmax", "tmean", "gdd", "heatdays"]


def clusters(spark, sf, wanted=()):
    """The cluster panel; with ``wanted`` at least these of its columns."""
    hh = master(spark, sf).drop("case_id", "month")
    return panel.cluster_panel(hh, "ea_id", "FS_year", "FS_month", ["TA_names", "zone", "region"], "TA_names", _TA, "region", REGIONS, wanted=wanted)


def _q(n: int, m: str = "FS_month") -> str:
    return f"CAST({m} BETWEEN {3 * n - 2} AND {3 * n} AS INTEGER)"


CLUSTER_SQL = f"""{MASTER_SQL},
cl AS (SELECT ea_id, FS_year, any_value(TA_names) AS TA_names, any_value(zone) AS zone, any_value(region) AS region, avg(FS_month) AS FS_month,
    avg(FCS) AS FCS, CASE WHEN avg(FCS) > 0 THEN ln(avg(FCS)) END AS logFCS, avg(HDDS) AS HDDS, avg(rCSI) AS rCSI, avg(raincytot) / 1000 AS raincytot, avg(elevation) / 1000 AS elevation,
    avg(maize_current) AS maize_current, avg(maize_mktthin_current) AS maize_mktthin_current, avg(IPC1) AS IPC1, avg(day1rain) AS day1rain, avg(hhsize) AS hhsize, avg(hh_age) AS hh_age FROM master GROUP BY ea_id, FS_year),
cl2 AS (SELECT *, avg(maize_current) OVER w AS TA_maize_current, avg(raincytot) OVER w AS TA_raincytot, avg(day1rain) OVER w AS TA_day1rain FROM cl WINDOW w AS (PARTITION BY TA_names, FS_year))"""

_CL = ["FCS", "logFCS", "HDDS", "rCSI", "IPC1", "raincytot", "elevation", "maize_current", "maize_mktthin_current", "day1rain", "hhsize", "hh_age", "TA_maize_current", "TA_raincytot", "TA_day1rain"]


@query("cluster_panel", f"""WITH {CLUSTER_SQL} SELECT ea_id, FS_year AS "FS_year", TA_names AS "TA_names", zone, region, {', '.join(f'round({c}, 6) AS "{c}"' for c in _CL)},
  {', '.join(f'{_q(n)} AS quarter{n}' for n in range(1, 5))}, CAST(FS_month = 7 AS INTEGER) AS month7, {', '.join(f'CAST(region = {chr(39)}{r}{chr(39)} AS INTEGER) AS "region_{r}"' for r in REGIONS)},
  {', '.join(f'{_q(n)} * CAST(region = {chr(39)}ASIA{chr(39)} AS INTEGER) AS "quarter{n}_region_ASIA"' for n in range(1, 5))} FROM cl2""")
def cluster_panel(spark, sf):
    cols = ["ea_id", "FS_year", "TA_names", "zone", "region", *_CL, *[f"quarter{n}" for n in range(1, 5)], "month7",
            *[f"region_{r}" for r in REGIONS], *[f"quarter{n}_region_ASIA" for n in range(1, 5)]]
    return rounded(clusters(spark, sf, cols).select(*cols), _CL)


# ---- the panels with what households leave out: answers from the cluster's other households, regions from labels or latitude

_FILLED = ["number_celphones", "hh_age", "dist_road", "elevation"]
_AREAS = ["South", "Central", "North"]
GAP_SQL = MASTER_SQL.replace("prior AS (", f"""gap AS (SELECT * REPLACE (CASE WHEN case_id % 5 > 1 THEN number_celphones END AS number_celphones, CASE WHEN case_id % 7 > 2 THEN hh_age END AS hh_age,
    CASE WHEN case_id % 4 = 1 THEN dist_road END AS dist_road, CASE WHEN ea_id % 6 > 0 THEN elevation END AS elevation,
    CASE WHEN case_id % 8 <> 1 THEN '' WHEN zone < 9 THEN 'South' WHEN zone < 17 THEN 'Central' ELSE 'North' END AS region) FROM hhb),
hhf AS (SELECT * REPLACE ({', '.join(f"coalesce(CAST({c} AS DOUBLE), avg({c}) OVER (PARTITION BY ea_id, FS_year, FS_month)) AS {c}" for c in _FILLED)}) FROM gap),
place AS (SELECT ea_id, FS_year, min(nullif(region, '')) AS label, avg({lat_sql('ea_id')}) AS la FROM gap GROUP BY ALL),
lim AS (SELECT min(la) AS lo, (max(la) - min(la)) / 3 AS width FROM place WHERE label IS NULL),
region_of AS (SELECT ea_id, FS_year, coalesce(label, CASE WHEN la <= lo + width THEN 'South' WHEN la <= lo + width * 2 THEN 'Central' ELSE 'North' END) AS region FROM place, lim),
prior AS (""", 1).replace("FROM hhb h ASOF", "FROM hhf h ASOF")


def gappy(spark, sf):
    """Households that leave out answers, and regions."""
    key, ea, zone = F.col("case_id"), F.col("ea_id"), F.col("zone")
    area = F.when(zone < 9, "South").when(zone < 17, "Central").otherwise("North")
    return households(spark, sf).withColumns({
        "number_celphones": F.when(key % 5 > 1, F.col("number_celphones")), "hh_age": F.when(key % 7 > 2, F.col("hh_age")),
        "dist_road": F.when(key % 4 == 1, F.col("dist_road")), "elevation": F.when(ea % 6 > 0, F.col("elevation")),
        "region": F.when(key % 8 == 1, area).otherwise(""),
    })


def master_filled(spark, sf, hh):
    return panel.hh_panel(hh, zone_prices(spark, sf), zone_seasons(spark, sf), ["zone"], ["zone", "FS_year"],
                          required=["zone", "maize_current", "raincytot"], fill=_FILLED, fill_by=["ea_id", "FS_year", "FS_month"])


@query("hh_panel_filled", f"""WITH {GAP_SQL} SELECT case_id, ea_id, FS_year AS "FS_year", FS_month AS "FS_month", {', '.join(f'round({c}, 6) AS {c}' for c in _FILLED)}, round(maize_current, 6) AS maize_current FROM master""")
def hh_panel_filled(spark, sf):
    out = master_filled(spark, sf, gappy(spark, sf)).select("case_id", "ea_id", "FS_year", "FS_month", *_FILLED, "maize_current")
    return rounded(out, [*_FILLED, "maize_current"])


@query("cluster_panel_filled", f"""WITH {GAP_SQL}, cl AS (SELECT ea_id, FS_year, avg(FCS) AS FCS, avg(FS_month) AS FS_month, avg(number_celphones) AS number_celphones, avg(hh_age) AS hh_age, avg(dist_road) AS dist_road,
    avg(elevation) / 1000 AS elevation FROM master GROUP BY ALL)
  SELECT ea_id, FS_year AS "FS_year", region, {', '.join(f'round({c}, 6) AS "{c}"' for c in ['FCS', *_FILLED])}, {', '.join(f"CAST(region = '{r}' AS INTEGER) AS \"region_{r}\"" for r in _AREAS)},
    {', '.join(f"{_q(1)} * CAST(region = '{r}' AS INTEGER) AS \"quarter1_region_{r}\"" for r in _AREAS)} FROM cl LEFT JOIN region_of USING (ea_id, FS_year)""")
def cluster_panel_filled(spark, sf):
    # The stage holds what the panel's columns come from.
    hh = cut_lineage(gappy(spark, sf).select("ea_id", "zone", "TA_names", "region", "FS_year", "FS_month", "month", "FCS", *_FILLED))
    region_of = scores.region_fill(hh.withColumn("lat", lat("ea_id")), ["ea_id", "FS_year"], "region", "lat", tuple(_AREAS))
    rows = master_filled(spark, sf, hh).drop("month")
    cols = ["ea_id", "FS_year", "region", "FCS", *_FILLED, *[f"region_{r}" for r in _AREAS], *[f"quarter1_region_{r}" for r in _AREAS]]
    out = panel.cluster_panel(rows, "ea_id", "FS_year", "FS_month", ["TA_names", "zone", "region"], "TA_names", _TA, "region", _AREAS, region_of=region_of, wanted=cols)
    return rounded(out.select(*cols), ["FCS", *_FILLED])
