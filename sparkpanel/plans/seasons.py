"""Daily weather to season statistics per entity and crop year."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkpanel.functions.calendar import crop_year_number, season_day
from sparkpanel.operators.aggregates import attach, sum_strict
from sparkpanel.operators.windows import median_ahead, panel, run_length
from sparkpanel.session import cut_lineage

# Onset threshold (mm), degree bounds (Celsius), zero Celsius in kelvin.
ONSET_MM = 2.2
GROW_LOW, HEAT_FROM = 8.0, 30.0
KELVIN = 273.15


def season_calendar(
    spark: SparkSession, first: int, last: int, start: str = "10-01", end: str = "05-01",
    end_shift: int = 1, shift_from: int | None = None,
) -> DataFrame:
    """Seasons (cropyear, start, end), both ends included.

    ``end_shift`` years lie between start and end; with ``shift_from`` only for
    crop years from that one on, so that later windows are long and overlap.
    """
    year = F.col("id").cast("int")
    shift = F.lit(end_shift) if shift_from is None else F.when(year >= shift_from, end_shift).otherwise(0)
    return spark.range(first, last + 1).select(
        year.alias("cropyear"),
        F.to_date(F.concat_ws("-", year, F.lit(start))).alias("start"),
        F.to_date(F.concat_ws("-", year + shift, F.lit(end))).alias("end"),
    )


def unimodal_seasons(spark: SparkSession, first: int, last: int) -> DataFrame:
    return season_calendar(spark, first, last)


def bimodal_seasons(spark: SparkSession, first: int, last: int) -> DataFrame:
    return season_calendar(spark, first, last, "03-01", "07-01", 1, 2010)


def seasons_spanning(
    df: DataFrame, date: str, start: str = "10-01", end: str = "05-01", end_shift: int = 1, shift_from: int | None = None
) -> DataFrame:
    """Calendar of every season that a date of the frame can lie in, from its first and last date."""
    lim = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    year = F.col("cropyear")
    shift = F.lit(end_shift) if shift_from is None else F.when(year >= shift_from, end_shift).otherwise(0)
    return lim.select(F.explode(F.sequence(F.year("lo") - end_shift, F.year("hi"))).alias("cropyear")).select(
        "cropyear", F.to_date(F.concat_ws("-", year, F.lit(start))).alias("start"),
        F.to_date(F.concat_ws("-", year + shift, F.lit(end))).alias("end"),
    )


def crop_years(df: DataFrame, date: str) -> tuple[Column, Column]:
    """Year before the first date and the number of May-April crop years up to the last, as scalars."""
    lim = df.agg((F.year(F.min(date)) - 1).alias("first"), (F.year(F.max(date)) - F.year(F.min(date)) + 2).alias("n"))
    return lim.select("first").scalar(), lim.select("n").scalar()


def season_grid(obs: DataFrame, by: list[str], date: str, seasons: DataFrame, value: str) -> DataFrame:
    """Every entity with every season day inside the dates of ``obs``: value (0 where absent) and cropyear.

    The days outside the seasons never become rows.
    """
    lim = obs.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    days = seasons.select(F.explode(F.sequence("start", "end")).alias(date), "cropyear").filter(
        F.col(date).between(lim.select("lo").scalar(), lim.select("hi").scalar()))
    # A calendar: some thousand days, held as one list.
    listed = days.agg(F.collect_list(F.struct(date, "cropyear")).alias("d")).select("d").scalar()
    grid = obs.select(*by).distinct().select(*by, F.explode(listed).alias("_d")).select(*by, "_d.*")
    return grid.join(obs, [*by, date], "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def season_join(df: DataFrame, date: str, seasons: DataFrame) -> DataFrame:
    """Tag rows with the crop years whose interval holds the date.

    Seasons are listed day by day, a calendar of some thousand rows, so the interval
    join is an equi join; a date inside two seasons yields two rows.
    """
    days = seasons.select(F.explode(F.sequence("start", "end")).alias(date), "cropyear")
    return df.join(days, date)


def season_stats(
    tagged: DataFrame, by: list[str], date: str, rain: str, k: int = 5, threshold: float = ONSET_MM
) -> DataFrame:
    """Total, onset day, longest dry spell and daily maximum per (entity, crop year).

    All windows share one partitioning and order, which the final aggregate reuses.
    """
    keys = [*by, "cropyear"]
    w = panel(keys, date)
    rows = tagged.withColumns({
        "_pos": F.row_number().over(w), "_med": median_ahead(rain, k, w),
    })
    rows = rows.withColumn("_dry", run_length(F.col(rain) == 0, F.col("_pos"), w))
    onset = F.min(F.when(F.col("_med") > threshold, F.col("_pos"))) + 2
    return rows.groupBy(*keys).agg(
        sum_strict(rain).alias("raincytot"),
        onset.alias("day1rain"),
        F.max("_dry").alias("maxdaysnorain"),
        F.max(rain).alias("rainmax"),
    )


def _dry_runs(wet: DataFrame, keys: list[str]) -> DataFrame:
    """Adds _gap, the days without rain right before the row; rows have the place _pos of their day among ``keys``."""
    return wet.withColumn("_gap", F.col("_pos") - F.coalesce(F.lag("_pos").over(panel(keys, "_pos")), F.lit(0)) - 1)


def observed_season_stats(
    obs: DataFrame, by: list[str], date: str, rain: str, seasons: DataFrame, k: int = 5, threshold: float = ONSET_MM
) -> DataFrame:
    """``season_stats`` of the ``season_grid`` of ``obs``, from the days with rain alone.

    ``obs`` is unique per (by, date). Days without a row are dry and never become rows: dry
    spells are what lies between wet days, and the median of k (odd) days exceeds a threshold
    that isn't negative where (k + 1) / 2 of them do.
    """
    if k % 2 == 0 or threshold < 0:
        return season_stats(season_grid(obs, by, date, seasons, rain), by, date, rain, k, threshold)
    lim = obs.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    days = seasons.select(F.explode(F.sequence("start", "end")).alias(date), "cropyear").filter(
        F.col(date).between(lim.select("lo").scalar(), lim.select("hi").scalar()))
    # A calendar: some thousand days.
    days = cut_lineage(days.withColumn("_pos", F.row_number().over(panel(["cropyear"], date))))
    sizes = days.groupBy("cropyear").agg(F.count(F.lit(1)).cast("int").alias("_days"))
    wet = obs.withColumn(rain, F.coalesce(rain, F.lit(0.0))).filter(F.col(rain) != 0).dropna(subset=by)
    keys = [*by, "cropyear"]
    wet = _dry_runs(wet.join(F.broadcast(days), date), keys)
    # The first k days of which enough exceed it end on one that does: days that do are told apart by place.
    wet = wet.withColumn("_high", F.when(F.col(rain) > threshold, F.col("_pos")))
    others, part = (k + 1) // 2 - 1, ", ".join(f"`{c}`" for c in keys)
    earliest = F.expr(f"lag(_high, {others}) ignore nulls over (partition by {part} order by _pos)") if others else F.col("_high")
    found = wet.withColumn("_start", F.when(F.col("_high") - earliest < k, F.greatest(F.lit(1), F.col("_pos") - (k - 1)))).groupBy(*keys).agg(
        F.sum(rain).alias("_sum"), F.min("_start").alias("_first"), F.max("_gap").alias("_gap"), F.max("_pos").alias("_last"),
        F.max(rain).alias("_top"), F.count(F.lit(1)).alias("_wet"))
    grid = attach(obs.select(*by).distinct().crossJoin(F.broadcast(sizes)), found, keys)
    top = F.when(F.col("_wet") == F.col("_days"), F.col("_top")).otherwise(F.greatest(F.lit(0.0), "_top"))
    return grid.select(
        *keys, F.coalesce("_sum", F.lit(0.0)).alias("raincytot"), F.when(F.col("_days") >= k, F.col("_first") + 2).alias("day1rain"),
        F.greatest("_gap", F.col("_days") - F.coalesce("_last", F.lit(0))).alias("maxdaysnorain"), top.alias("rainmax"))


def season_total(tagged: DataFrame, by: list[str], rain: str) -> DataFrame:
    return tagged.groupBy(*by, "cropyear").agg(sum_strict(rain).alias("raincytot"))


def season_max(tagged: DataFrame, by: list[str], rain: str) -> DataFrame:
    return tagged.groupBy(*by, "cropyear").agg(F.max(rain).alias("rainmax"))


def season_onset(tagged: DataFrame, by: list[str], date: str, rain: str, k: int = 5, threshold: float = ONSET_MM) -> DataFrame:
    """1-based first day whose k-day median exceeds the threshold, plus 2; null if never."""
    return season_stats(tagged, by, date, rain, k, threshold).select(*by, "cropyear", "day1rain")


def dry_spell(tagged: DataFrame, by: list[str], date: str, rain: str) -> DataFrame:
    return season_stats(tagged, by, date, rain).select(*by, "cropyear", "maxdaysnorain")


def onset_five_day(
    daily: DataFrame, by: list[str], date: str, rain: str, first_year: int | Column, n_years: int | Column, legacy: bool = True
) -> DataFrame:
    """Earlier onset rule: trailing five-day sum above 10 with under 3 dry days; 999 = never."""
    w = panel(by, date).rowsBetween(-4, 0)
    full = F.count(rain).over(w) == 5
    hit = full & (F.sum(rain).over(w) > 10) & (F.sum((F.col(rain) == 0).cast("int")).over(w) < 3)
    day = F.when(hit, season_day(date, legacy))
    rows = daily.withColumn("_day", day).withColumn("cropyr", crop_year_number(date, first_year, n_years))
    return rows.groupBy(*by, "cropyr").agg(F.coalesce(F.min("_day"), F.lit(999)).alias("day1rain"))


def dry_spell_legacy(
    daily: DataFrame, by: list[str], date: str, rain: str, first_year: int | Column, n_years: int | Column
) -> DataFrame:
    """Earlier spell rule: dry days counted between spell starts within a crop year.

    A dry day after a dry day and every April-September day raise the spell number;
    the number of dry days per spell is counted and the largest kept.
    """
    w = panel(by, date)
    dry = (F.col(rain) == 0).cast("int")
    rows = daily.withColumn("cropyr", crop_year_number(date, first_year, n_years)).withColumn("_dry", dry)
    starts = ((F.lag("_dry").over(w) == 1) & (F.col("_dry") == 0)) | F.month(date).between(4, 9)
    rows = rows.withColumn("_new", F.coalesce(starts, F.lit(False)).cast("int"))
    in_year = panel([*by, "cropyr"], date).rowsBetween(Window.unboundedPreceding, 0)
    spells = rows.withColumn("_spell", F.sum("_new").over(in_year))
    counts = spells.groupBy(*by, "cropyr", "_spell").agg(F.sum("_dry").alias("_days"))
    return counts.groupBy(*by, "cropyr").agg(F.max("_days").alias("maxdaysnorain"))


def observed_dry_spell_legacy(
    obs: DataFrame, by: list[str], date: str, rain: str, first_year: int | Column, n_years: int | Column
) -> DataFrame:
    """``dry_spell_legacy`` of all days between the first and the last date of ``obs``, from the days with rain alone.

    ``obs`` is unique per (by, date); days without a row are dry. Spells of October to March are
    what lies between wet days, and the first goes on from that of 30 September; every other
    day of April to September is a spell of its own.
    """
    lim = obs.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    days = lim.select(F.explode(F.sequence("lo", "hi")).alias(date)).withColumn("cropyr", crop_year_number(date, first_year, n_years))
    month = F.month(date)
    summer = month.between(4, 9)
    winter = F.when(~summer | ((month == 9) & (F.dayofmonth(date) == 30)), F.year(F.add_months(date, 6)))
    # A calendar: some thousand days. Winters are numbered by the year they end in.
    days = days.withColumns({"_summer": summer, "_winter": winter})
    days = cut_lineage(days.withColumn("_pos", F.row_number().over(panel(["cropyr", "_winter"], date))))
    part = ["cropyr", "_winter"]
    sizes = days.groupBy(*part).agg(F.count(F.lit(1)).cast("int").alias("_days"), F.count_if("_summer").alias("_open"))
    wet = obs.withColumn(rain, F.coalesce(rain, F.lit(0.0))).filter(F.col(rain) != 0).dropna(subset=by)
    wet = _dry_runs(wet.join(F.broadcast(days), date), [*by, *part])
    found = wet.groupBy(*by, *part).agg(F.max("_gap").alias("_gap"), F.max("_pos").alias("_last"), F.count_if("_summer").alias("_wet"))
    grid = attach(obs.select(*by).distinct().crossJoin(F.broadcast(sizes)), found, [*by, *part])
    longest = F.when(F.col("_winter").isNotNull(), F.greatest("_gap", F.col("_days") - F.coalesce("_last", F.lit(0)))).otherwise(0)
    alone = (F.col("_open") > F.coalesce("_wet", F.lit(0))).cast("int")
    return grid.groupBy(*by, "cropyr").agg(F.max(F.greatest(longest, alone)).cast("long").alias("maxdaysnorain"))


def celsius_mean(tmax: Column, tmin: Column) -> Column:
    return (tmax + tmin) / 2 - KELVIN


def mean_temp(tmax: DataFrame, tmin: DataFrame, on: list[str]) -> DataFrame:
    """Daily mean in Celsius from kelvin extremes, paired by key."""
    return tmax.join(tmin, on).withColumn("tmean", celsius_mean(F.col("tmax"), F.col("tmin")))


def temp_stats(tagged: DataFrame, by: list[str], temp: str = "tmean") -> DataFrame:
    """Season mean, days between 8 and 30 degrees, days at 30 degrees or more."""
    t = F.col(temp)
    return tagged.groupBy(*by, "cropyear").agg(
        F.avg(t).alias("tmean"),
        F.count_if((t > GROW_LOW) & (t < HEAT_FROM)).alias("gdd"),
        F.count_if(t >= HEAT_FROM).alias("heatdays"),
    )


def flood_exposure(season: DataFrame, zone: str, flood_zones: Iterable, rainmax: str = "rainmax") -> DataFrame:
    """Season maximum in the listed flood zones, 0 elsewhere; FS_year is the crop year itself."""
    exposed = F.when(F.col(zone).isin(list(flood_zones)), F.col(rainmax)).otherwise(F.lit(0.0))
    return season.select(zone, F.col("cropyear").alias("FS_year"), exposed.alias("floodmax"))


def season_panel(
    tagged_rain: DataFrame, daily_temp: DataFrame, seasons: DataFrame, by: str, zone: str, zones: DataFrame,
    date: str = "day", rain: str = "rain", flood_zones: Iterable = (), observed: bool = False,
) -> DataFrame:
    """Season table keyed (entity, FS_year): entity rain statistics, zone temperature and floods.

    ``tagged_rain`` has the season days with their crop year; if ``observed``, the days with
    rain instead, whatever their season. ``zones`` maps entity to zone. FS_year is crop year + 1, floods use the crop year.
    """
    # Small beside the daily rows and read for entities and for zone maxima: written once.
    stats = observed_season_stats(tagged_rain, [by], date, rain, seasons) if observed else season_stats(tagged_rain, [by], date, rain)
    rain_stats = cut_lineage(stats)
    entity = rain_stats.join(zones, by, "left").withColumn("FS_year", F.col("cropyear") + 1).drop("cropyear")
    heat = temp_stats(season_join(daily_temp, date, seasons), [zone]).withColumn(
        "FS_year", F.col("cropyear") + 1
    ).drop("cropyear")
    zone_max = rain_stats.join(zones, by, "left").groupBy(zone, "cropyear").agg(F.max("rainmax").alias("rainmax"))
    flood = flood_exposure(zone_max, zone, flood_zones)
    return entity.join(heat, [zone, "FS_year"], "left").join(flood, [zone, "FS_year"], "left")
