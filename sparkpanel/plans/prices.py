"""Market prices: thinness, imputation from neighbours, zone and point prices, panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkpanel.operators.aggregates import share, sum_strict, weighted_agg
from sparkpanel.operators.nearest import BROADCAST_ROWS, nearest_join, neighbours
from sparkpanel.operators.polygons import point_in_polygon
from sparkpanel.operators.state_space import fill_local_level
from sparkpanel.operators.windows import lag_calendar
from sparkpanel.session import cut_lineage

CELL = ["market", "commodity", "month"]


def dense_prices(obs: DataFrame, commodities: Sequence[str] | None = None) -> DataFrame:
    """Every market with every commodity in every month of the frame; absent cells null.

    ``obs`` is unique per (market, commodity, month); its cells are written once, as they
    are read for markets, limits and values. The grid is made by exploding the short lists
    of commodities and months on each market. With ``commodities`` it has these alone.
    """
    obs = cut_lineage(obs)
    lists = obs.agg(F.min("month").alias("lo"), F.max("month").alias("hi"), F.collect_set("commodity").alias("cs"))
    months = F.sequence(lists.select("lo").scalar(), lists.select("hi").scalar(), F.expr("INTERVAL 1 MONTH"))
    kinds = lists.select("cs").scalar() if commodities is None else F.lit(list(commodities))
    # A market is a small row that becomes many: by their size alone all would be one task's.
    width = int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grid = (
        obs.select("market").distinct().repartition(width)
        .select("market", F.explode(kinds).alias("commodity"))
        .select("market", "commodity", F.explode(months).alias("month"))
    )
    return grid.join(obs, CELL, "left")


def thin_flag(dense: DataFrame) -> DataFrame:
    """1 where the market has no price in the month."""
    return dense.withColumn("thin", F.col("price").isNull().cast("int"))


def thin_rate(weekly: DataFrame, by: list[str], price: str = "price") -> DataFrame:
    """Missing weeks over weeks of the month."""
    return weekly.groupBy(*by).agg(F.avg(F.col(price).isNull().cast("double")).alias("thin_rate"))


def spatial_fill(
    dense: DataFrame, coords: DataFrame, mode: str = "nearest_observed", k_max: int = 10
) -> DataFrame:
    """Missing cells from the nearest market with a price in the same month.

    ``nearest_observed`` looks as far as needed; ``k_max`` only sizes the shortlist tried
    first. ``cascade`` walks the ranked neighbours 1, 2, ...; in each round a missing cell
    copies what that neighbour held before the round, so filled cells can donate in later
    rounds. ``growing`` takes in round k the median of what the k nearest held before it.
    Both go on until no cell is left that any market of its month could fill, which is
    the smallest k with the fewest gaps; ``k_max`` is how many neighbours are ranked at once.
    """
    if mode == "nearest_observed":
        return _fill_nearest(dense, coords, k_max)
    return _fill_in_rounds(dense, coords, mode == "growing", k_max)


def _fill_in_rounds(dense: DataFrame, coords: DataFrame, growing: bool, k_max: int) -> DataFrame:
    """What the rounds of a cascade or a growing fill leave, from the open cells alone.

    ``dense`` is read for the cells held in months with gaps and for the result, whatever
    the number of rounds. Markets whose cells the first ``k_max`` neighbours leave open
    get lists four times as long, the others are done.
    """
    dense = cut_lineage(dense)
    kind = ["commodity", "month"]
    known, gaps = dense.filter(F.col("price").isNotNull()), dense.filter(F.col("price").isNull())
    # Months of a commodity that have both gaps and prices to fill them from.
    counts = dense.groupBy(*kind).agg(F.count("price").alias("_known"), F.count(F.lit(1)).alias("_all"))
    mixed = cut_lineage(counts.filter("_known > 0 AND _known < _all").select(*kind))
    if mixed.isEmpty():
        return dense
    rest = gaps.select(*CELL).join(mixed, kind, "left_semi")
    held = known.select(*CELL, "price").join(mixed, kind, "left_semi").withColumn("round", F.lit(0))
    filled, reach, last = None, 0, coords.count() - 1
    while reach < last and not rest.isEmpty():
        reach = min(last, max(k_max, 4 * reach))
        new, rest = _settle(rest, held, coords, growing, reach)
        filled = new if filled is None else filled.unionByName(new)
        held = held.unionByName(new)
    if filled is None:
        return dense
    given = filled.select(*CELL, F.col("price").alias("_given")).dropDuplicates(CELL)
    closed = gaps.join(given, CELL, "left").withColumn("price", F.coalesce("price", "_given")).select(*dense.columns)
    return known.unionByName(closed)


def _links(rest: DataFrame, givers: DataFrame, lists: DataFrame, offer: Column, reach: int) -> tuple[DataFrame, DataFrame]:
    """Links of the open cells to their neighbours, and the cells that the nearest neighbour leaves open.

    ``first`` is the first round that the held neighbours of a cell allow. A cell is linked
    to neighbours up to that rank, to all of them where no held one allows any. Ranks
    are asked in steps, each by the cells alone that the ranks before leave open. Where a
    neighbour is open with a first round of 1 or 2, which no other can make earlier, ``_still``
    is that round and ``_price`` the price of round 1.
    """
    giver = ["neighbour", "commodity", "month"]
    rank, best = F.col("rank"), F.col("_best")
    asking, asked, cells = rest.withColumn("_best", F.lit(None).cast("int")), [], []
    low, high = 0, 1
    while True:
        near = asking.join(lists.filter((rank > low) & (rank <= high)), "market")
        if low > 0 and asking.count() * (high - low) <= BROADCAST_ROWS:
            # Few cells ask: what is held is read for them, not dealt out.
            near = cut_lineage(near.withColumnRenamed("rank", "_rank")).withColumnRenamed("_rank", "rank")
            near = near.join(givers.join(F.broadcast(near.select(*giver).distinct()), giver, "left_semi"), giver, "left")
        else:
            near = near.join(givers, giver, "left")
        near = cut_lineage(near.select(*CELL, "neighbour", "price", "round", "_best", rank.alias("_rank"), offer.cast("int").alias("_offer")))
        if low == 0:
            # A market has one nearest neighbour, so no cells are put together.
            done = near.filter("_offer = 1")
            near = near.filter("_offer IS NULL OR _offer > 1")
            now = near.select(*CELL, F.col("_offer").alias("_best"))
        else:
            now = cut_lineage(near.groupBy(*CELL).agg(F.least(F.min("_best"), F.min("_offer")).alias("_best")))
        asked.append(near)
        further = best.isNull() | (best > high)
        if high >= reach:
            cells.append(now)
            break
        if low > 0:
            cells.append(now.filter(~further))
        asking = now.filter(further)
        low, high = high, min(reach, 4 * high + 1)
    left = cells[0]
    for part in cells[1:]:
        left = left.unionByName(part)
    left = left.withColumnRenamed("_best", "first")
    all_asked = asked[0]
    for part in asked[1:]:
        all_asked = all_asked.unionByName(part)
    cols = [*CELL, F.col("_rank").alias("rank"), "neighbour", "price", "round"]
    still = done.select(*CELL, F.lit(1).alias("_still"), F.col("price").alias("_price")).unionByName(
        left.filter("first = 2").select(*CELL, F.lit(2).alias("_still"), F.lit(None).cast("double").alias("_price")))
    others = all_asked.select(*cols).join(left, CELL).filter(F.col("first").isNull() | (rank <= F.col("first")))
    others = others.join(still.withColumnRenamed("market", "neighbour"), giver, "left")
    none = {"_still": F.lit(None).cast("int"), "_price": F.lit(None).cast("double")}
    return cut_lineage(done.select(*cols, F.lit(1).alias("first")).withColumns(none).unionByName(others)), left


def _settle(rest: DataFrame, held: DataFrame, coords: DataFrame, growing: bool, reach: int) -> tuple[DataFrame, DataFrame]:
    """Cells of ``rest`` that a round up to ``reach`` fills, with price and round, and those that a later one may fill.

    ``held`` has the cells filled before. A neighbour of a rank gives in the first round
    that is no earlier than its rank and later than its own round; in a cascade only in
    the round of its rank. Open cells start with the round that the held neighbours allow,
    and take an earlier one from each other until none does. Prices then follow from the
    cells of earlier rounds.
    """
    giver = ["neighbour", "commodity", "month"]
    rank, of_giver, first = F.col("rank"), F.col("round"), F.col("first")
    later = F.when(of_giver.isNotNull(), F.greatest(rank, of_giver + 1)) if growing else F.when(of_giver < rank, rank)
    places = coords.join(rest.select("market").distinct(), "market", "left_semi")
    lists = nearest_join(places, coords, "market", "market", k=reach, exclude_self=True, right_name="neighbour")
    lists = cut_lineage(lists.filter(F.col("neighbour").isNotNull()).select("market", "neighbour", "rank").distinct())
    links, cells = _links(rest, held.withColumnRenamed("market", "neighbour"), lists, later, reach)

    # What is open gives in round 2 at the earliest, so only cells of later rounds can move.
    may_move = first.isNull() | (first > 2)
    as_giver = lambda df: df.withColumnRenamed("market", "neighbour")
    state = cut_lineage(cells.filter(may_move).select(*CELL, first.alias("round")))
    if not state.isEmpty():
        open_links = links.filter(may_move & of_giver.isNull()).select(*CELL, "neighbour", "rank", F.col("_still").alias("round"))
        offers = open_links.filter(of_giver.isNotNull()).groupBy(*CELL).agg(F.min(later).alias("_offer"))
        state = cut_lineage(state.join(offers, CELL, "left").select(*CELL, F.least("round", "_offer").alias("round")))
        # The others give in round 3 at the earliest, which is of use to a cell of a later round.
        mine = state.withColumnRenamed("round", "_mine").filter("_mine IS NULL OR _mine > 3")
        open_links = open_links.filter(of_giver.isNull()).drop("round").join(mine, CELL).filter("_mine IS NULL OR rank < _mine").drop("_mine")
        open_links, fresh = cut_lineage(open_links), state.filter(of_giver.isNotNull())
        while not fresh.isEmpty():
            offers = open_links.join(as_giver(fresh), giver).groupBy(*CELL).agg(F.min(later).alias("_offer"))
            now = state.join(offers, CELL, "left").withColumn("_earlier", F.least("round", "_offer"))
            now = cut_lineage(now.select(*CELL, F.col("_earlier").alias("round"), (~F.col("_earlier").eqNullSafe(of_giver)).alias("_moved")))
            state, fresh = now.drop("_moved"), now.filter("_moved").drop("_moved")

    own, given = F.col("_own"), F.col("_given")
    due = links.filter(first.isNull() | (first > 1)).join(state.withColumnRenamed("round", "_own"), CELL, "left")
    due = due.withColumn("_own", F.coalesce("_own", "first")).filter((own <= reach) & (rank <= own if growing else rank == own))
    due = due.join(as_giver(state.withColumnRenamed("round", "_moved")), giver, "left").filter(F.coalesce("round", "_still", "_moved") < own)
    due = cut_lineage(due.select(*CELL, "_own", "neighbour", F.coalesce("price", "_price").alias("price")))
    filled = links.filter(first == 1).select(*CELL, "price", first.alias("round"))
    while True:
        values = cut_lineage(_middle(due))
        done, waiting = values.filter(F.col("price").isNotNull()), values.filter(F.col("price").isNull())
        filled = filled.unionByName(done.select(*CELL, "price", own.alias("round")))
        if waiting.isEmpty():
            return filled, state.filter(of_giver.isNull() | (of_giver > reach)).select(*CELL)
        due = due.join(waiting.select(*CELL), CELL, "left_semi").join(as_giver(done.select(*CELL, F.col("price").alias("_given"))), giver, "left")
        due = cut_lineage(due.select(*CELL, "_own", "neighbour", F.coalesce("price", given).alias("price")))


def _middle(due: DataFrame) -> DataFrame:
    """Median of the prices due to each cell, null until all of them are known.

    That of one or two is halfway between the least and the greatest, which needs no list.
    """
    by, rows = [*CELL, "_own"], F.count(F.lit(1))
    sums = cut_lineage(due.groupBy(*by).agg((F.count("price") == rows).alias("_all"), rows.alias("_n"), F.min("price").alias("_low"), F.max("price").alias("_high")))
    few = sums.filter("NOT _all OR _n < 3").select(*by, F.when(F.col("_all"), F.col("_low") * 0.5 + F.col("_high") * 0.5).alias("price"))
    # At most as many prices meet in a group as there are neighbours in a list.
    many = due.join(sums.filter("_all AND _n >= 3").select(*by), by, "left_semi").groupBy(*by).agg(F.median("price").alias("price"))
    return few.unionByName(many)


def _fill_nearest(dense: DataFrame, coords: DataFrame, shortlist: int) -> DataFrame:
    """Adds donor and dist_km. Most gaps are closed by the ranked shortlist of their market;
    the cells it leaves open search all markets observed in their month."""
    # Read by each of the joins below.
    dense = cut_lineage(dense)
    seen = dense.filter(F.col("price").isNotNull())
    gaps = dense.filter(F.col("price").isNull()).select(*CELL)
    held = seen.select(F.col("market").alias("neighbour"), "commodity", "month", F.col("price").alias("_given"))
    near = gaps.join(neighbours(coords, "market", shortlist), "market").join(held, ["neighbour", "commodity", "month"])
    given = cut_lineage(near.groupBy(*CELL).agg(
        F.min_by("_given", "rank").alias("_given"), F.min_by("neighbour", "rank").alias("donor"),
        F.min_by("dist_km", "rank").alias("dist_km"),
    ))
    rest = gaps.join(given, CELL, "left_anti")
    if not rest.isEmpty():
        far = nearest_join(
            rest.join(coords, "market"), seen.join(rest.select("commodity", "month").distinct(), ["commodity", "month"], "left_semi")
            .join(coords, "market"), "market", "market", by=["commodity", "month"], right_name="neighbour",
        ).join(held, ["neighbour", "commodity", "month"])
        given = given.unionByName(far.select(*CELL, "_given", F.col("neighbour").alias("donor"), "dist_km"))
    return dense.join(given, CELL, "left").withColumn("price", F.coalesce("price", "_given")).drop("_given")


def spatial_fill_median(dense: DataFrame, coords: DataFrame, k: int) -> DataFrame:
    """Missing cells from the median of the known prices among the k nearest markets."""
    ranks = neighbours(coords, "market", k)
    seen = dense.filter(F.col("price").isNotNull()).select(
        F.col("market").alias("neighbour"), "commodity", "month", F.col("price").alias("_p")
    )
    # At most k prices meet in a group here.
    given = (
        dense.filter(F.col("price").isNull()).select(*CELL).join(ranks, "market")
        .join(seen, ["neighbour", "commodity", "month"])
        .groupBy(*CELL).agg(F.median("_p").alias("_given"))
    )
    return dense.join(given, CELL, "left").withColumn("price", F.coalesce("price", "_given")).drop("_given")


def missing_by_k(dense: DataFrame, coords: DataFrame, k_max: int) -> DataFrame:
    """Cells still missing after consulting the 1..k_max nearest markets."""
    ranks = neighbours(coords, "market", k_max)
    gaps = dense.filter(F.col("price").isNull()).select(*CELL)
    seen = dense.filter(F.col("price").isNotNull()).select(F.col("market").alias("neighbour"), "commodity", "month")
    first = gaps.join(ranks, "market").join(seen, ["neighbour", "commodity", "month"]).groupBy(*CELL).agg(
        F.min("rank").alias("k")
    )
    filled = first.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    steps = dense.sparkSession.range(1, k_max + 1).select(F.col("id").cast("int").alias("k"))
    total = gaps.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    upto = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    # k_max rows in this window.
    return steps.join(filled, "k", "left").select(
        "k", (total - F.sum(F.coalesce("n", F.lit(0))).over(upto)).alias("missing")
    )


def donor_fill(series: DataFrame, entities: DataFrame, entity: str) -> DataFrame:
    """Entities without a series take the whole series of the nearest entity that has one.

    ``entities`` holds entity, lat, lon.
    """
    having = entities.join(series.select(entity).distinct(), entity, "left_semi")
    lacking = entities.join(series.select(entity).distinct(), entity, "left_anti")
    donor = nearest_join(lacking, having, entity, entity, right_name="donor").select(entity, "donor")
    copied = donor.join(series.withColumnRenamed(entity, "donor"), "donor")
    return series.withColumn("donor", F.col(entity)).unionByName(copied.select(*series.columns, "donor"))


def zone_price(prices: DataFrame, weights: DataFrame, zone: str = "zone") -> DataFrame:
    """Weighted price of a zone per commodity and month, null if a member price is null."""
    return weighted_agg(
        prices.join(weights, "market"), [zone, "commodity", "month"], "price", "weight", "zone_price"
    )


def _asked(near: DataFrame, asked: DataFrame | None, point: str) -> tuple[DataFrame, list[str]]:
    """Points with their market, one row for each month asked for, and what their prices are joined on."""
    if asked is None:
        return near, ["market"]
    # Pairs lead: the markets of points are the smaller side, and points nobody asks for go.
    return asked.select(point, "month").distinct().join(near, point), ["market", "month"]


def point_price(points: DataFrame, coords: DataFrame, prices: DataFrame, point: str, asked: DataFrame | None = None) -> DataFrame:
    """Price series of the market nearest to each point; a point without one stays, with nulls.

    ``asked`` holds pairs (point, month): then only these are made, and a pair without a
    price stays, with nulls. Pairs of unknown points are left out.
    """
    near = nearest_join(points, coords, point, "market", right_name="market").select(point, "market", "dist_km")
    rows, keys = _asked(near, asked, point)
    return rows.join(prices, keys, "left")


def price_panel(prices: DataFrame, by: list[str], commodities: dict[str, str], value: str, prefix: str) -> DataFrame:
    """Price and thinness columns of every commodity side by side, one aggregate.

    ``commodities`` maps commodity value to column name; ``prices`` has price and thin.
    """
    aggs = []
    for v, name in commodities.items():
        hit = F.col("commodity") == v
        aggs.append(F.max(F.when(hit, F.col(value))).alias(f"{prefix}_{name}_price"))
        aggs.append(F.max(F.when(hit, F.col("thin"))).alias(f"{prefix}_{name}_mktthin"))
    return prices.groupBy(*by).agg(*aggs)


def zone_price_thin(prices: DataFrame, weights: DataFrame, zone: str = "zone") -> DataFrame:
    """Zone price with the weighted thinness of its markets."""
    joined = prices.join(weights, "market")
    return joined.groupBy(zone, "commodity", "month").agg(
        sum_strict(F.col("price") * F.col("weight")).alias("price"),
        sum_strict(F.col("thin") * F.col("weight")).alias("thin"),
    )


def station_price(
    stations: DataFrame, coords: DataFrame, points: DataFrame, point: str, commodity: str, national: str,
    asked: DataFrame | None = None, signal: float | None = None,
) -> DataFrame:
    """Current and previous-month price of the nearest station for one commodity.

    The national average row is dropped and gaps are filled per station by the
    local-level model before the join. ``asked`` as in ``point_price``, ``signal`` as in
    ``fill_local_level``.
    """
    series = stations.filter((F.col("commodity") == commodity) & (F.col("market") != national))
    filled = fill_local_level(series, ["market"], "month", "price", "price", signal)
    near = nearest_join(points, coords, point, "market", right_name="market").select(point, "market")
    rows, keys = _asked(near, asked, point)
    return rows.join(lag_calendar(filled, ["market"], "month", ["price"], 1, "_lag"), keys, "left")


def catchment_weights(pixels: DataFrame, zones: DataFrame, coords: DataFrame, zone: str, pop: str = "pop") -> DataFrame:
    """Share of a zone's population nearest to each market.

    ``pixels`` holds pixel, lat, lon and population; the cells of a market are the
    pixels nearest to it.
    """
    spots = pixels.groupBy("lat", "lon").agg(F.sum(pop).alias(pop)).withColumn("_spot", F.struct("lat", "lon"))
    inside = point_in_polygon(spots, zones).select("_spot", "lat", "lon", zone, pop)
    near = nearest_join(inside.select("_spot", "lat", "lon").distinct(), coords, "_spot", "market", right_name="market")
    parts = inside.join(near.select("_spot", "market"), "_spot").groupBy(zone, "market").agg(F.sum(pop).alias(pop))
    return share(parts, [zone], pop, "weight").select(zone, "market", "weight")
