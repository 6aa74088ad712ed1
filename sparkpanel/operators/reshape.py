"""Wide-long reshapes, dummies, interactions, composite keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: list[str], values: list[str] | None = None, var: str = "variable", value: str = "value") -> DataFrame:
    values = values or [c for c in df.columns if c not in ids]
    return df.unpivot(ids, values, var, value)


def widen(df: DataFrame, rows: list[str], col: str, val: str, values: list, prefix: str = "") -> DataFrame:
    """One column per listed value of ``col``; cells are unique per (rows, col)."""
    return df.groupBy(*rows).agg(
        *[F.max(F.when(F.col(col) == v, F.col(val))).alias(f"{prefix}{v}") for v in values]
    )


def transpose(df: DataFrame, row: str, cols: list[str], row_values: list, name: str = "name", prefix: str = "") -> DataFrame:
    """Columns become rows and the values of ``row`` become columns."""
    return widen(df.unpivot([row], cols, name, "_v"), [name], row, "_v", row_values, prefix)


def split_key(df: DataFrame, col: str, names: list[str], sep: str = "_") -> DataFrame:
    parts = F.split(F.col(col), sep)
    return df.withColumns({n: F.get(parts, F.lit(i)) for i, n in enumerate(names)})


def composite_key(*cols: str, sep: str = "_") -> Column:
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])


#: Levels that may become columns.
MOST_LEVELS = 5000


class TooManyLevels(ValueError):
    """A factor has more levels than a frame can have columns."""


def levels(df: DataFrame, col: str, most: int = MOST_LEVELS) -> list:
    """Known values of a factor in order, as they name columns; beyond ``most`` an error that names the factor."""
    found = df.select(col).distinct().filter(F.col(col).isNotNull()).limit(most + 1).collect()
    if len(found) > most:
        raise TooManyLevels(f"{col} has more than {most} levels; absorb it (absorbed_ols) or give the values that are wanted")
    return sorted(r[0] for r in found)


def dummies(df: DataFrame, col: str, values: list | None = None, prefix: str | None = None) -> DataFrame:
    """0/1 column per value; without ``values`` one for each level of the factor."""
    stem = prefix if prefix is not None else f"{col}_"
    return df.withColumns({
        f"{stem}{v}": F.coalesce(F.col(col) == v, F.lit(False)).cast("int") for v in (levels(df, col) if values is None else values)
    })


def interact(df: DataFrame, left: list[str], right: list[str], sep: str = "_") -> DataFrame:
    """Product column for every pair of a left and a right column name."""
    return df.withColumns({f"{a}{sep}{b}": F.col(a) * F.col(b) for a in left for b in right})


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name, missing columns as null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def key_diff(a: DataFrame, b: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Key values in a but not b, and in b but not a."""
    ka, kb = a.select(*on), b.select(*on)
    return ka.subtract(kb), kb.subtract(ka)
