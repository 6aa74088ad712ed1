"""Household and cluster panels assembled from the parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpanel.functions.calendar import month_flags, quarter_flags
from sparkpanel.operators.aggregates import collapse_mean
from sparkpanel.operators.clean import group_mean_fill
from sparkpanel.operators.dedup import first_per_key
from sparkpanel.operators.reshape import dummies, interact
from sparkpanel.operators.windows import broadcast_mean
from sparkpanel.session import cut_lineage


def hh_panel(
    hh: DataFrame, prices: DataFrame, season: DataFrame, price_keys: Sequence[str], season_keys: Sequence[str],
    month: str = "month", required: Sequence[str] = (), fill: Sequence[str] = (), fill_by: Sequence[str] = (),
) -> DataFrame:
    """Households with current and previous-month prices and their season statistics.

    ``prices`` is unique per (price_keys, month), ``season`` per season_keys. Missing
    values of ``fill`` first become the mean of the households that share ``fill_by``
    (cluster and interview month), whatever is dropped later; they stay missing where none
    of these knows one. Rows without one of ``required`` are dropped.
    """
    if fill:
        hh = group_mean_fill(hh, list(fill_by), list(fill))
    # Written stages have a known size: beside small ones the households need no shuffle.
    prices, season = cut_lineage(prices), cut_lineage(season)
    values = [c for c in prices.columns if c not in (*price_keys, month)]
    now = prices.withColumnsRenamed({c: f"{c}_current" for c in values})
    before = prices.select(
        *price_keys, F.add_months(month, 1).alias(month), *[F.col(c).alias(f"{c}_lag") for c in values]
    )
    out = hh.join(now, [*price_keys, month], "left").join(before, [*price_keys, month], "left")
    out = out.join(season, list(season_keys), "left")
    return out.dropna(subset=list(required)) if required else out


def cluster_panel(
    hh: DataFrame, cluster: str, year: str, month: str, names: Sequence[str], area: str, area_cols: Sequence[str],
    region: str, regions: Sequence[str], zone: str | None = None, zones: Sequence | None = None,
    thousands: Sequence[str] = ("raincytot", "elevation"), fcs: str = "FCS", strict_reference: bool = False,
    region_of: DataFrame | None = None, wanted: Sequence[str] = (),
) -> DataFrame:
    """Cluster-year means with area means, calendar and region dummies and their products.

    ``names`` are label columns of the household rows, taken once per cluster. With
    ``region_of`` (cluster, year, region; see ``region_fill``) regions come from there,
    one for each cluster and year, and those of the households go. With ``wanted`` means
    are made of what these columns of the panel need alone, for the same rows.
    """
    if region_of is not None:
        hh, names = hh.drop(region), [n for n in names if n != region]
    if wanted:
        # Stages hide from Spark what is read of them later, so columns nobody wants go first.
        means = [c for c in hh.columns if not {c, f"log{c}", f"TA_{c}"}.isdisjoint(wanted)]
        hh = hh.select(*dict.fromkeys([cluster, year, month, *names, *means]))
        area_cols = [c for c in area_cols if f"TA_{c}" in wanted]
    # The master and the cluster means feed several branches each: both are written stages.
    hh = cut_lineage(hh)
    labels = first_per_key(hh.select(cluster, *names).distinct(), [cluster], list(names))
    out = collapse_mean(hh, [cluster, year], exclude=names)
    out = out.withColumns({
        **({f"log{fcs}": F.when(F.col(fcs) > 0, F.log(fcs))} if fcs in out.columns else {}),
        **{c: F.col(c) / 1000 for c in thousands if c in out.columns},
    })
    out = out.join(labels, cluster, "left")
    if region_of is not None:
        out = out.join(region_of.select(cluster, year, region), [cluster, year], "left")
    out = cut_lineage(out)
    if area_cols:
        out = broadcast_mean(out, [area, year], list(area_cols), "TA_")
    m = F.col(month)
    out = out.withColumns({**quarter_flags(m, strict_reference), **month_flags(m)})
    out = dummies(out, region, list(regions), "region_")
    if zone is not None:
        out = dummies(out, zone, zones, f"{zone}_")
    return interact(out, [f"quarter{q}" for q in range(1, 5)], [f"region_{r}" for r in regions])


def split_year(df: DataFrame, year: str, first_test: int) -> tuple[DataFrame, DataFrame]:
    """Years before ``first_test`` to train on, that year and later ones to test on."""
    return df.filter(F.col(year) < first_test), df.filter(F.col(year) >= first_test)


def split_region(df: DataFrame, region: str, test: str) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(region) != test), df.filter(F.col(region) == test)
