"""Projections, joins, aggregates, sorts, set operations and reshapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkpanel.functions.calendar import crop_year_number, month_from_abbrev, month_start, quarter_flags, rain_season_flag, yyyymm
from sparkpanel.functions.strings import guarded_number, last_token, normalise_name, tail_chars
from sparkpanel.operators import aggregates as agg
from sparkpanel.operators import clean, dedup, joins, reshape
from sparkpanel.operators.skew import group_median
from sparkpanel.plans import panel
from sparkpanel.queries.base import NATION_MONTH_SQL, nation_month, query, rnd, rounded, table
from sparkpanel.sources import io


# ---- projections and filters

@query("sel_prefix", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def sel_prefix(spark, sf):
    return clean.select_prefix(table(spark, sf, "nation"), [], "n_")


@query("scale_log", """SELECT o_orderkey, round(o_totalprice / 1000.0::DOUBLE, 6) AS total_k,
  round(ln(o_totalprice), 6) AS log_total FROM orders""")
def scale_log(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", rnd(F.col("o_totalprice") / 1000).alias("total_k"), rnd(F.log("o_totalprice")).alias("log_total")
    )


@query("filt_in", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
  WHERE l_returnflag IN ('A', 'R') AND l_linestatus NOT IN ('O') AND l_quantity BETWEEN 10 AND 20 AND l_shipdate IS NOT NULL""")
def filt_in(spark, sf):
    return table(spark, sf, "lineitem").filter(
        F.col("l_returnflag").isin("A", "R") & ~F.col("l_linestatus").isin("O")
        & F.col("l_quantity").between(10, 20) & F.col("l_shipdate").isNotNull()
    ).select("l_orderkey", "l_linenumber", "l_quantity")


_HOLES = "SELECT c_custkey, nullif(c_nationkey, 3) AS nation, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer"


def _holes(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nation"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"),
    )


@query("complete_cases", f"SELECT * FROM ({_HOLES}) WHERE nation IS NOT NULL AND bal IS NOT NULL")
def complete_cases(spark, sf):
    return clean.complete_cases(_holes(spark, sf), ["nation", "bal"])


@query("recode", """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
  WHEN o_orderpriority = '3-MEDIUM' THEN 'mid' ELSE 'low' END AS grade FROM orders""")
def recode(spark, sf):
    table_ = {"1-URGENT": "high", "2-HIGH": "high", "3-MEDIUM": "mid"}
    return clean.recode(table(spark, sf, "orders"), "o_orderpriority", table_, "grade", "low").select("o_orderkey", "grade")


@query("null_sentinels", """SELECT p_partkey, CASE WHEN p_size NOT IN (1, 50) THEN p_size END AS p_size,
  CASE WHEN p_type <> 'PROMO' THEN p_type END AS p_type FROM part""")
def null_sentinels(spark, sf):
    return clean.null_sentinels(table(spark, sf, "part"), {"p_size": [1, 50], "p_type": ["PROMO"]}).select(
        "p_partkey", "p_size", "p_type"
    )


@query("clip", "SELECT c_custkey, CASE WHEN c_acctbal IS NULL THEN NULL ELSE least(greatest(c_acctbal, 0.0::DOUBLE), 5000.0::DOUBLE) END AS c_acctbal FROM customer")
def clip(spark, sf):
    return clean.clip(table(spark, sf, "customer"), "c_acctbal", 0.0, 5000.0).select("c_custkey", "c_acctbal")


@query("zscore", """SELECT c_custkey, round((c_acctbal - m) / s, 6) AS c_acctbal_z
  FROM customer, (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS s FROM customer)""")
def zscore(spark, sf):
    return rounded(clean.zscore(table(spark, sf, "customer"), ["c_acctbal"]), ["c_acctbal_z"]).select("c_custkey", "c_acctbal_z")


@query("override", """SELECT c.c_custkey, coalesce(s.s_acctbal, c.c_acctbal) AS c_acctbal
  FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey AND s.s_acctbal > 0""")
def override(spark, sf):
    patch = table(spark, sf, "supplier").filter("s_acctbal > 0").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal")
    )
    return clean.override(table(spark, sf, "customer"), ["c_custkey"], patch).select("c_custkey", "c_acctbal")


@query("tail_subset", """SELECT l_orderkey, l_linenumber, round(ln(l_quantity), 6) AS v, 'logFCS' AS measure FROM lineitem WHERE ln(l_quantity) < ln(42.0::DOUBLE)
  UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, 'HDDS' FROM lineitem WHERE l_quantity < 6
  UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, 'rCSI' FROM lineitem WHERE l_quantity > 4""")
def tail_subset(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("v"))
    logs = clean.tail(li.withColumn("v", F.log("v")), "v", "logFCS").withColumn("v", rnd("v"))
    parts = [logs.withColumn("measure", F.lit("logFCS"))]
    parts += [clean.tail(li, "v", m).withColumn("measure", F.lit(m)) for m in ("HDDS", "rCSI")]
    return reshape.union_by_name(*parts)


@query("across", """SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand FROM part""")
def across(spark, sf):
    return clean.across(table(spark, sf, "part"), ["p_name", "p_brand"], F.upper).select("p_partkey", "p_name", "p_brand")


@query("calendar", """SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS yyyymm,
  CAST(CASE WHEN month(o_orderdate) BETWEEN 1 AND 3 THEN 1 ELSE 0 END AS INTEGER) AS quarter1,
  CAST(CASE WHEN month(o_orderdate) BETWEEN 4 AND 6 THEN 1 ELSE 0 END AS INTEGER) AS quarter2,
  CAST(CASE WHEN month(o_orderdate) BETWEEN 7 AND 9 THEN 1 ELSE 0 END AS INTEGER) AS quarter3,
  CAST(CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS quarter4,
  CAST(CASE WHEN month(o_orderdate) BETWEEN 5 AND 6 THEN 1 ELSE 0 END AS INTEGER) AS strict_quarter2,
  CAST(least((SELECT year(max(o_orderdate)) - year(min(o_orderdate)) FROM orders), greatest(1, year(o_orderdate) - (SELECT year(min(o_orderdate)) FROM orders) + CASE WHEN month(o_orderdate) >= 5 THEN 1 ELSE 0 END)) AS INTEGER) AS cropyr,
  CAST(CASE WHEN month(o_orderdate) > 9 OR month(o_orderdate) < 5 THEN 1 ELSE 0 END AS INTEGER) AS rainseason,
  CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week,
  CAST(month(o_orderdate) AS INTEGER) AS abbrev_month,
  CAST(date_trunc('month', o_orderdate)::DATE AS VARCHAR) AS month_start
  FROM orders""")
def calendar(spark, sf):
    d, m = F.to_date("o_orderdate"), F.month("o_orderdate")
    orders = table(spark, sf, "orders")
    # The first and the last crop year of the table take what lies beyond them.
    lim = orders.agg(F.year(F.min("o_orderdate")).alias("lo"), F.year(F.max("o_orderdate")).alias("hi"))
    first, last = lim.select("lo").scalar(), lim.select("hi").scalar()
    return orders.select(
        "o_orderkey", yyyymm("o_orderdate").alias("yyyymm"),
        *[c.alias(n) for n, c in quarter_flags(m).items()],
        quarter_flags(m, strict_reference=True)["quarter2"].alias("strict_quarter2"),
        crop_year_number("o_orderdate", first, last - first).alias("cropyr"), rain_season_flag("o_orderdate").alias("rainseason"),
        F.weekofyear("o_orderdate").alias("iso_week"),
        month_from_abbrev(F.date_format("o_orderdate", "MMM")).alias("abbrev_month"),
        month_start(d).cast("string").alias("month_start"),
    )


@query("name_scalars", """SELECT p_partkey, upper(trim(regexp_replace(p_name, '[.\\s]+', ' ', 'g'))) AS norm,
  trim(split_part(p_name, ' ', -1)) AS last_word, right(p_brand, 2) AS brand_end,
  CASE WHEN upper(p_type) = 'PROMO' THEN 'SALE' ELSE upper(p_type) END AS type_alias FROM part""")
def name_scalars(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", normalise_name("p_name").alias("norm"), last_token("p_name", " ").alias("last_word"),
        tail_chars("p_brand", 2).alias("brand_end"), normalise_name("p_type", {"PROMO": "SALE"}).alias("type_alias"),
    )


# ---- joins

@query("join_left", """SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 3""")
def join_left(spark, sf):
    cust, nat = table(spark, sf, "customer"), table(spark, sf, "nation").filter("n_regionkey < 3")
    return table(spark, sf, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        nat, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).select("o_orderkey", "c_name", "n_name")


_SUPP_MONTH = """sm AS (SELECT l_suppkey AS supp, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_returnflag AS flag,
  sum(l_quantity) AS qty FROM lineitem GROUP BY ALL)"""


def _supp_month(spark, sf, flag):
    return table(spark, sf, "lineitem").filter(F.col("l_returnflag") == flag).groupBy(
        F.col("l_suppkey").alias("supp"), month_start("l_shipdate").alias("month")
    ).agg(F.sum("l_quantity").alias(f"qty_{flag}"))


@query("join_natural", f"""WITH {_SUPP_MONTH} SELECT a.supp, CAST(a.month AS VARCHAR) AS month, a.qty AS qty_A, b.qty AS qty_R
  FROM (SELECT * FROM sm WHERE flag = 'A') a LEFT JOIN (SELECT * FROM sm WHERE flag = 'R') b ON a.supp = b.supp AND a.month = b.month""")
def join_natural(spark, sf):
    return joins.natural_join(_supp_month(spark, sf, "A"), _supp_month(spark, sf, "R")).withColumn("month", F.col("month").cast("string"))


@query("join_full", f"""WITH {_SUPP_MONTH} SELECT coalesce(a.supp, b.supp) AS supp, CAST(coalesce(a.month, b.month) AS VARCHAR) AS month,
  a.qty AS qty_A, b.qty AS qty_N
  FROM (SELECT * FROM sm WHERE flag = 'A') a FULL JOIN (SELECT * FROM sm WHERE flag = 'N') b ON a.supp = b.supp AND a.month = b.month""")
def join_full(spark, sf):
    return joins.full_join(_supp_month(spark, sf, "A"), _supp_month(spark, sf, "N"), ["supp", "month"]).withColumn(
        "month", F.col("month").cast("string"))


@query("join_inner", """SELECT l_orderkey, l_linenumber, l_quantity, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE p_size <= 10""")
def join_inner(spark, sf):
    small = table(spark, sf, "part").filter("p_size <= 10").select("p_partkey", "p_brand")
    return table(spark, sf, "lineitem").join(small, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_quantity", "p_brand")


@query("merge_flag", """WITH a AS (SELECT o_orderkey, o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'),
  b AS (SELECT c_custkey AS k, c_mktsegment FROM customer WHERE c_acctbal >= 0)
  SELECT coalesce(a.k, b.k) AS k, o_orderkey, c_mktsegment,
    CAST(CASE WHEN b.k IS NULL THEN 1 WHEN a.k IS NULL THEN 2 ELSE 3 END AS INTEGER) AS merge_mark
  FROM a FULL JOIN b ON a.k = b.k""")
def merge_flag(spark, sf):
    a = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey", F.col("o_custkey").alias("k"))
    b = table(spark, sf, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    return joins.merge_flag(a, b, ["k"], "merge_mark")


@query("merge_m1", "SELECT o_orderkey, c_mktsegment, c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def merge_m1(spark, sf):
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    return joins.merge_checked(table(spark, sf, "orders"), cust, ["o_custkey"], "m:1").select("o_orderkey", "c_mktsegment", "c_acctbal")


@query("merge_mm", """WITH l AS (SELECT c_nationkey AS k, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn,
    count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer),
  r AS (SELECT s_nationkey AS k, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn,
    count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier),
  sizes AS (SELECT k, max(nl) AS nl, max(nr) AS nr FROM (SELECT k, n AS nl, NULL AS nr FROM l UNION ALL SELECT k, NULL, n FROM r) GROUP BY k),
  pos AS (SELECT k, nl, nr, unnest(range(1, greatest(coalesce(nl, 0), coalesce(nr, 0)) + 1)) AS p FROM sizes)
  SELECT pos.k, c_custkey, s_suppkey FROM pos LEFT JOIN l ON l.k = pos.k AND l.rn = least(p, nl) LEFT JOIN r ON r.k = pos.k AND r.rn = least(p, nr)""")
def merge_mm(spark, sf):
    l = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), "c_custkey")
    r = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"), "s_suppkey")
    return joins.merge_mm(l, r, ["k"], ["c_custkey"], ["s_suppkey"])


@query("anti_keys", """SELECT DISTINCT o_custkey AS k, 'left' AS side FROM orders WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)
  UNION ALL SELECT DISTINCT s_suppkey, 'right' FROM supplier WHERE s_suppkey NOT IN (SELECT o_custkey FROM orders)""")
def anti_keys(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    return joins.unmatched(a, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k")), ["k"])


# ---- aggregates

@query("collapse_mean", """SELECT c_nationkey, round(avg(c_custkey), 6) AS c_custkey, round(avg(c_acctbal), 6) AS c_acctbal
  FROM customer GROUP BY ALL""")
def collapse_mean(spark, sf):
    return rounded(agg.collapse_mean(table(spark, sf, "customer"), ["c_nationkey"]), ["c_custkey", "c_acctbal"])


@query("collapse_mixed", """SELECT l_suppkey, l_returnflag, round(avg(l_discount), 6) AS l_discount, sum(l_quantity) AS l_quantity,
  max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY ALL""")
def collapse_mixed(spark, sf):
    spec = {"mean": ["l_discount"], "sum": ["l_quantity"], "max": ["l_extendedprice"]}
    return rounded(agg.collapse(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], spec), ["l_discount"])


@query("sum_strict", """SELECT l_suppkey, l_linenumber, CASE WHEN count(nullif(l_quantity, 7)) = count(*) THEN sum(nullif(l_quantity, 7)) END AS qty
  FROM lineitem GROUP BY ALL""")
def sum_strict(spark, sf):
    li = clean.null_sentinels(table(spark, sf, "lineitem"), {"l_quantity": [7.0]})
    return li.groupBy("l_suppkey", "l_linenumber").agg(agg.sum_strict("l_quantity").alias("qty"))


@query("count_where", """SELECT l_suppkey, max(l_quantity) AS hi, min(l_quantity) AS lo, count(*) FILTER (l_quantity > 25) AS n_over
  FROM lineitem GROUP BY ALL""")
def count_where(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.max("l_quantity").alias("hi"), F.min("l_quantity").alias("lo"), F.count_if(F.col("l_quantity") > 25).alias("n_over"))


@query("month_median", """SELECT CAST(date_trunc('month', l_shipdate)::DATE AS VARCHAR) AS month, round(quantile_cont(l_extendedprice, 0.5), 6) AS median
  FROM lineitem GROUP BY ALL""")
def month_median(spark, sf):
    li = table(spark, sf, "lineitem").select(month_start("l_shipdate").cast("string").alias("month"), "l_extendedprice")
    return rounded(group_median(li, ["month"], "l_extendedprice"), ["median"])


@query("mode_strict", """WITH c AS (SELECT l_suppkey, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL),
  m AS (SELECT *, max(n) OVER (PARTITION BY l_suppkey) AS top FROM c)
  SELECT l_suppkey, CASE WHEN count(*) = 1 THEN max(l_quantity) END AS mode FROM m WHERE n = top GROUP BY l_suppkey""")
def mode_strict(spark, sf):
    return agg.mode_strict(table(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity")


@query("table1_profile", """WITH u AS (SELECT l_returnflag, 'l_quantity' AS var, l_quantity AS v FROM lineitem
    UNION ALL SELECT l_returnflag, 'l_extendedprice', l_extendedprice FROM lineitem UNION ALL SELECT l_returnflag, 'l_discount', l_discount FROM lineitem)
  SELECT l_returnflag, var, round(avg(v), 4) AS mean, round(quantile_cont(v, 0.5), 4) AS median, round(stddev_samp(v), 4) AS sd, min(v) AS min, max(v) AS max
  FROM u GROUP BY ALL""")
def table1_profile(spark, sf):
    return rounded(agg.profile(table(spark, sf, "lineitem"), ["l_returnflag"], ["l_quantity", "l_extendedprice", "l_discount"]),
                   ["mean", "median", "sd"], 4)


@query("freq_tab", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def freq_tab(spark, sf):
    return agg.freq(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query("cross_tab", """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "o_orderstatus_F",
  count(*) FILTER (o_orderstatus = 'O') AS "o_orderstatus_O", count(*) FILTER (o_orderstatus = 'P') AS "o_orderstatus_P" FROM orders GROUP BY ALL""")
def cross_tab(spark, sf):
    return agg.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("n_distinct", "SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY ALL")
def n_distinct(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts"))


@query("null_census", f"""WITH h AS ({_HOLES}) SELECT 'c_custkey' AS "column", count(*) - count(c_custkey) AS nulls FROM h
  UNION ALL SELECT 'nation', count(*) - count(nation) FROM h UNION ALL SELECT 'bal', count(*) - count(bal) FROM h""")
def null_census(spark, sf):
    return agg.null_census(_holes(spark, sf))


@query("row_total", """SELECT p_partkey, round(coalesce(nullif(p_size, 7), 0) + coalesce(p_retailprice, 0), 6) AS total,
  round((coalesce(nullif(p_size, 7), 0) + coalesce(p_retailprice, 0)) / (CASE WHEN p_size = 7 THEN 0 ELSE 1 END + 1), 6) AS mean FROM part""")
def row_total(spark, sf):
    df = clean.null_sentinels(table(spark, sf, "part"), {"p_size": [7]})
    cols = ["p_size", "p_retailprice"]
    return df.select("p_partkey", rnd(agg.row_total(cols)).alias("total"), rnd(agg.row_mean(cols)).alias("mean"))


@query("pop_share", """WITH t AS (SELECT s_suppkey, s_nationkey, s_acctbal, sum(s_acctbal) OVER (PARTITION BY s_nationkey) AS tot,
    count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier)
  SELECT s_suppkey, s_nationkey, round(CASE WHEN n = 1 THEN 1.0 WHEN tot = 0 THEN 0.0 ELSE s_acctbal / tot END, 6) AS share FROM t""")
def pop_share(spark, sf):
    return rounded(agg.share(table(spark, sf, "supplier"), ["s_nationkey"], "s_acctbal"), ["share"]).select("s_suppkey", "s_nationkey", "share")


@query("r2_pair", "SELECT l_suppkey, round(pow(corr(l_extendedprice, l_quantity), 2), 3) AS r2 FROM lineitem GROUP BY ALL")
def r2_pair(spark, sf):
    return agg.r2(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_suppkey"])


@query("multi_level", """WITH b AS (SELECT n_regionkey AS region, c_nationkey AS zone, c_custkey AS clust, CAST(year(o_orderdate) AS INTEGER) AS FS_year, ln(o_totalprice) AS log_total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
  SELECT 'region' AS level, region, CAST(NULL AS INTEGER) AS zone, CAST(NULL AS BIGINT) AS clust, FS_year, round(avg(log_total), 6) AS log_total FROM b GROUP BY region, FS_year
  UNION ALL SELECT 'zone', NULL, zone, NULL, FS_year, round(avg(log_total), 6) FROM b GROUP BY zone, FS_year
  UNION ALL SELECT 'clust', NULL, NULL, clust, FS_year, round(avg(log_total), 6) FROM b GROUP BY clust, FS_year""")
def multi_level(spark, sf):
    cust = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    base = table(spark, sf, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("n_regionkey").alias("region"), F.col("c_nationkey").alias("zone"), F.col("c_custkey").alias("clust"),
        F.year("o_orderdate").alias("FS_year"), F.log("o_totalprice").alias("log_total"))
    levels = {"region": ["region"], "zone": ["zone"], "clust": ["clust"]}
    return rounded(agg.multi_level(base, levels, ["FS_year"], ["log_total"]), ["log_total"])


# ---- sorts, deduplication, top-k

@query("sort_multi", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer ORDER BY c_nationkey, c_acctbal DESC, c_custkey")
def sort_multi(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal").orderBy(
        "c_nationkey", F.desc("c_acctbal"), "c_custkey")


@query("distinct_cols", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_cols(spark, sf):
    return table(spark, sf, "part").select("p_brand", "p_type").distinct()


@query("first_per_key", """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def first_per_key(spark, sf):
    return dedup.first_per_key(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice")


@query("dup_split", """SELECT o_orderkey, o_custkey, CASE WHEN count(*) OVER (PARTITION BY o_custkey, year(o_orderdate)) = 1 THEN 'unique' ELSE 'several' END AS kind FROM orders""")
def dup_split(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"))
    one, many = dedup.dup_split(o, ["o_custkey", "y"])
    return one.withColumn("kind", F.lit("unique")).unionByName(many.withColumn("kind", F.lit("several"))).drop("y")


@query("argmin", """SELECT l_partkey, arg_min(l_suppkey, (l_extendedprice, l_suppkey)) AS l_suppkey, min(l_extendedprice) AS l_extendedprice
  FROM lineitem GROUP BY ALL""")
def argmin(spark, sf):
    return dedup.argmin(table(spark, sf, "lineitem"), ["l_partkey"], "l_suppkey", "l_extendedprice", "l_suppkey")


# ---- set operations and reshapes

@query("union_by_name", """SELECT c_custkey AS id, c_acctbal AS bal, c_mktsegment AS seg FROM customer
  UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""")
def union_by_name(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    return reshape.union_by_name(a, table(spark, sf, "supplier").select(F.col("s_acctbal").alias("bal"), F.col("s_suppkey").alias("id")))


@query("key_diff", """(SELECT DISTINCT c_custkey AS k, 'first' AS only_in FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier))
  UNION ALL (SELECT DISTINCT s_suppkey, 'second' FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer))""")
def key_diff(spark, sf):
    a, b = reshape.key_diff(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k")), ["k"])
    return a.withColumn("only_in", F.lit("first")).unionByName(b.withColumn("only_in", F.lit("second")))


@query("unpivot", """SELECT o_orderkey, 'o_totalprice' AS variable, o_totalprice AS value FROM orders
  UNION ALL SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS DOUBLE) FROM orders""")
def unpivot(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey"))
    return reshape.melt(o, ["o_orderkey"])


@query("pivot", f"""WITH {_SUPP_MONTH} SELECT supp, CAST(month AS VARCHAR) AS month, max(qty) FILTER (flag = 'A') AS "q_A",
  max(qty) FILTER (flag = 'N') AS "q_N", max(qty) FILTER (flag = 'R') AS "q_R" FROM sm GROUP BY ALL""")
def pivot(spark, sf):
    long = table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("supp"), month_start("l_shipdate").cast("string").alias("month"), F.col("l_returnflag").alias("flag")
    ).agg(F.sum("l_quantity").alias("qty"))
    return reshape.widen(long, ["supp", "month"], "flag", "qty", ["A", "N", "R"], "q_")


@query("transpose", """WITH t AS (SELECT l_returnflag AS f, sum(l_quantity) AS qty, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY ALL)
  SELECT 'qty' AS name, max(qty) FILTER (f = 'A') AS "f_A", max(qty) FILTER (f = 'N') AS "f_N", max(qty) FILTER (f = 'R') AS "f_R" FROM t
  UNION ALL SELECT 'n', max(n) FILTER (f = 'A'), max(n) FILTER (f = 'N'), max(n) FILTER (f = 'R') FROM t""")
def transpose(spark, sf):
    t = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("f")).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).cast("double").alias("n"))
    return reshape.transpose(t, "f", ["qty", "n"], ["A", "N", "R"], "name", "f_")


@query("split_key", """SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS rank, split_part(o_orderpriority, '-', 2) AS word FROM orders""")
def split_key(spark, sf):
    return reshape.split_key(table(spark, sf, "orders"), "o_orderpriority", ["rank", "word"], "-").select("o_orderkey", "rank", "word")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("dummies", "SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INTEGER) AS \"c_mktsegment_{s}\"" for s in _SEGMENTS) + " FROM customer")
def dummies(spark, sf):
    return reshape.dummies(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment").drop("c_mktsegment")


@query("interact", """SELECT p_partkey, p_size * CAST(p_type = 'PROMO' AS INTEGER) AS "p_size_promo", p_retailprice * CAST(p_type = 'PROMO' AS INTEGER) AS "p_retailprice_promo" FROM part""")
def interact(spark, sf):
    p = table(spark, sf, "part").withColumn("promo", (F.col("p_type") == "PROMO").cast("int"))
    return reshape.interact(p, ["p_size", "p_retailprice"], ["promo"]).select("p_partkey", "p_size_promo", "p_retailprice_promo")


@query("composite_key", f"WITH {NATION_MONTH_SQL} SELECT concat_ws('_', zone, CAST(month AS VARCHAR)) AS key, n FROM nm")
def composite_key(spark, sf):
    return nation_month(spark, sf).select(reshape.composite_key("zone", "month").alias("key"), "n")


# ---- stacking and guarded casts

# Survey rounds with columns of their own: open orders have no price, closed ones no priority.
@query("append_years", """SELECT o_orderkey, o_orderstatus, NULL AS o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, NULL FROM orders WHERE o_orderstatus <> 'O'""")
def append_years(spark, sf):
    orders = table(spark, sf, "orders")
    rounds = [
        orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        orders.filter("o_orderstatus <> 'O'").select("o_orderkey", "o_orderstatus", "o_totalprice"),
    ]
    return io.append_years(rounds).select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


# One file of monthly prices for each return flag; a market and month that several give keeps the lowest.
@query("merge_monthly", """SELECT market, month, min(price) AS price FROM (
    SELECT l_suppkey AS market, CAST(date_trunc('month', l_shipdate)::DATE AS VARCHAR) AS month, l_returnflag, max(l_extendedprice) AS price FROM lineitem GROUP BY ALL) GROUP BY ALL""")
def merge_monthly(spark, sf):
    prices = table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("market"), month_start("l_shipdate").cast("string").alias("month"), "l_returnflag"
    ).agg(F.max("l_extendedprice").alias("price"))
    files = [prices.filter(F.col("l_returnflag") == f).drop("l_returnflag") for f in ("A", "N", "R")]
    return io.merge_monthly(files, ["market", "month"], "price")


@query("guarded_cast", """SELECT o_orderkey, TRY_CAST(trim(substr(o_orderpriority, 1, 1)) AS INTEGER) AS rank, TRY_CAST(trim(o_orderpriority) AS DOUBLE) AS none FROM orders""")
def guarded_cast(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", guarded_number(F.substring("o_orderpriority", 1, 1), "int").alias("rank"), guarded_number("o_orderpriority").alias("none"))


@query("drop_first", """SELECT o_orderkey, o_custkey FROM orders
  WHERE date_trunc('month', o_orderdate) > (SELECT min(date_trunc('month', o_orderdate)) FROM orders)""")
def drop_first(spark, sf):
    # Rows have no position: those of the first month are told by their date.
    orders = table(spark, sf, "orders").withColumn("month", month_start("o_orderdate"))
    first = orders.agg(F.min("month").alias("month")).select("month").scalar()
    return orders.filter(F.col("month") > first).select("o_orderkey", "o_custkey")


@query("column_bind", """WITH a AS (SELECT l_returnflag, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY ALL),
  b AS (SELECT l_returnflag, count(*) AS n, min(l_quantity) AS least FROM lineitem GROUP BY ALL) SELECT a.l_returnflag, mean, n, least FROM a JOIN b USING (l_returnflag)""")
def column_bind(spark, sf):
    # Results of equal length stand side by side by their key, never by their order.
    by_flag = table(spark, sf, "lineitem").groupBy("l_returnflag")
    means = by_flag.agg(F.round(F.avg("l_quantity"), 6).alias("mean"))
    return means.join(by_flag.agg(F.count(F.lit(1)).alias("n"), F.min("l_quantity").alias("least")), "l_returnflag")


@query("split_region", """SELECT c_custkey, r_name AS region, CASE WHEN r_name = 'EUROPE' THEN 'test' ELSE 'train' END AS part
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def split_region(spark, sf):
    places = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = table(spark, sf, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("r_name").alias("region"))
    train, test = panel.split_region(customers, "region", "EUROPE")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
