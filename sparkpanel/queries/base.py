"""Registry, table access and the stand-in frames the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkpanel.functions.calendar import month_start
from sparkpanel.operators.windows import dense_grid
from sparkpanel.plans.prices import dense_prices
from sparkpanel.plans.seasons import season_grid, seasons_spanning
from sparkpanel.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rnd(col: str | Column, digits: int = 6) -> Column:
    return F.round(col, digits)


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def lat(key: str) -> Column:
    return F.lit(-17.0) + (F.col(key) * 37 % 800) / F.lit(100.0)


def lon(key: str) -> Column:
    return F.lit(33.0) + (F.col(key) * 53 % 300) / F.lit(100.0)


def lat_sql(key: str) -> str:
    return f"(-17.0::DOUBLE + ({key} * 37 % 800) / 100.0::DOUBLE)"


def lon_sql(key: str) -> str:
    return f"(33.0::DOUBLE + ({key} * 53 % 300) / 100.0::DOUBLE)"


def hav_sql(la1: str, lo1: str, la2: str, lo2: str) -> str:
    return (
        f"2 * 6371.0088::DOUBLE * asin(least(1.0::DOUBLE, sqrt(pow(sin((radians({la2}) - radians({la1})) / 2), 2) + "
        f"cos(radians({la1})) * cos(radians({la2})) * pow(sin((radians({lo2}) - radians({lo1})) / 2), 2))))"
    )


# Daily rain stand-in: shipped quantity per supplier and day, 0 on days without shipment.
def rain_obs(spark: SparkSession, sf: str) -> DataFrame:
    # A day of an entity has about one line: sums before the shuffle would only fill memory.
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("entity"), F.to_date("l_shipdate").alias("day"), "l_quantity")
    return lines.repartition("entity", "day").groupBy("entity", "day").agg(F.sum("l_quantity").alias("rain"))


def rain_daily(spark: SparkSession, sf: str) -> DataFrame:
    # One row per entity and day, read for entities, limits and values: written once.
    obs = cut_lineage(rain_obs(spark, sf))
    grid = dense_grid(obs, ["entity"], "day")
    return grid.join(obs, ["entity", "day"], "left").withColumn("rain", F.coalesce("rain", F.lit(0.0)))


RAIN_OBS_SQL = """robs AS (
  SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS rain
  FROM lineitem GROUP BY ALL)"""

RAIN_SQL = RAIN_OBS_SQL + """,
rdays AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT min(day) AS lo, max(day) AS hi FROM robs)),
rain AS (
  SELECT e.entity, d.day, coalesce(o.rain, 0) AS rain
  FROM (SELECT DISTINCT entity FROM robs) e CROSS JOIN rdays d LEFT JOIN robs o ON o.entity = e.entity AND o.day = d.day)"""


def ship_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"))


def seasons(spark: SparkSession, sf: str) -> DataFrame:
    """Every October to May season that a shipment can lie in."""
    return seasons_spanning(ship_days(spark, sf), "day")


def season_rain(spark: SparkSession, sf: str) -> DataFrame:
    """Rain of every entity on every season day, with the crop year."""
    obs = cut_lineage(rain_obs(spark, sf))
    return season_grid(obs, ["entity"], "day", seasons_spanning(obs, "day"), "rain")


SEASON_SQL = """seasons AS (
  SELECT CAST(y AS INTEGER) AS cropyear, make_date(y, 10, 1) AS s, make_date(y + 1, 5, 1) AS e
  FROM (SELECT unnest(range(year(min(l_shipdate)) - 1, year(max(l_shipdate)) + 1)) AS y FROM lineitem))"""
#: Number of the May-April crop year, from the year before the first shipment.
CROP_YEAR_SQL = """CAST(year(day) - (SELECT year(min(l_shipdate)) - 1 FROM lineitem) + CASE WHEN month(day) >= 5 THEN 1 ELSE 0 END AS INTEGER)"""

SEASON_RAIN_SQL = RAIN_SQL + ", " + SEASON_SQL + """,
tagged AS (SELECT r.*, cropyear FROM rain r JOIN seasons ON day BETWEEN s AND e)"""


# Price stand-in: mean log unit price per supplier, part type and month.
def price_obs(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select(
        "l_partkey", F.col("l_suppkey").alias("market"), month_start("l_shipdate").alias("month"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"),
    )
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("commodity"))
    return items.join(parts, "l_partkey").groupBy("market", "commodity", "month").agg(F.avg(F.log("unit")).alias("price"))


def prices_dense(spark: SparkSession, sf: str, commodities=None) -> DataFrame:
    return dense_prices(price_obs(spark, sf), commodities)


PRICE_SQL = """pobs AS (
  SELECT l_suppkey AS market, p_type AS commodity, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         avg(ln(l_extendedprice / l_quantity)) AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""

DENSE_SQL = PRICE_SQL + """,
pmonths AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
  FROM (SELECT min(month) AS lo, max(month) AS hi FROM pobs)),
dense AS (
  SELECT m.market, c.commodity, t.month, o.price
  FROM (SELECT DISTINCT market FROM pobs) m CROSS JOIN (SELECT DISTINCT commodity FROM pobs) c CROSS JOIN pmonths t
  LEFT JOIN pobs o ON o.market = m.market AND o.commodity = c.commodity AND o.month = t.month)"""


def market_coords(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("market"), lat("s_suppkey").alias("lat"), lon("s_suppkey").alias("lon")
    )


COORD_SQL = f"coords AS (SELECT s_suppkey AS market, {lat_sql('s_suppkey')} AS lat, {lon_sql('s_suppkey')} AS lon FROM supplier)"


# Monthly panel stand-in: mean log order total per customer nation and month.
def nation_month(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return table(spark, sf, "orders").join(cust, "o_custkey").groupBy(
        F.col("c_nationkey").alias("zone"), month_start("o_orderdate").alias("month")
    ).agg(F.round(F.avg(F.log("o_totalprice")), 6).alias("value"), F.count(F.lit(1)).alias("n"))


NATION_MONTH_SQL = """nm AS (
  SELECT c_nationkey AS zone, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         round(avg(ln(o_totalprice)), 6) AS value, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


#: Share of the level in the variances where a query gives it instead of fitting it.
KNOWN_SIGNAL = 0.3


def level_sql(source: str, keys: str, signal: float) -> str:
    """numbered (rows with their place i) and backward (smoothed level), for a query WITH RECURSIVE: a local-level model, step by step."""
    q, h = f"{signal}::DOUBLE", f"{1 - signal}::DOUBLE"
    return f"""numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY month) AS i FROM {source}),
forward AS (SELECT {keys}, i, price AS level, CASE WHEN price IS NOT NULL THEN {h} END AS spread FROM numbered WHERE i = 1
  UNION ALL SELECT {', '.join(f'n.{k.strip()}' for k in keys.split(','))}, n.i,
    CASE WHEN n.price IS NULL THEN f.level WHEN f.level IS NULL THEN n.price ELSE f.level + (f.spread + {q}) / (f.spread + {q} + {h}) * (n.price - f.level) END,
    CASE WHEN n.price IS NULL THEN f.spread + {q} WHEN f.level IS NULL THEN {h} ELSE (f.spread + {q}) * {h} / (f.spread + {q} + {h}) END
  FROM forward f JOIN numbered n ON {' AND '.join(f'n.{k.strip()} = f.{k.strip()}' for k in keys.split(','))} AND n.i = f.i + 1),
passed AS MATERIALIZED (SELECT * FROM forward),
backward AS (SELECT {keys}, i, level AS smooth FROM passed QUALIFY i = max(i) OVER (PARTITION BY {keys})
  UNION ALL SELECT {', '.join(f'p.{k.strip()}' for k in keys.split(','))}, p.i, CASE WHEN p.level IS NULL THEN b.smooth ELSE p.level + p.spread / (p.spread + {q}) * (b.smooth - p.level) END
  FROM backward b JOIN passed p ON {' AND '.join(f'p.{k.strip()} = b.{k.strip()}' for k in keys.split(','))} AND p.i = b.i - 1)"""
