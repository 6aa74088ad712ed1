"""Name clean-up used on zone, market and column labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_name(col: str | Column, aliases: dict[str, str] | None = None) -> Column:
    """Upper-case, dots and runs of blanks to one blank, then an alias table."""
    col = F.col(col) if isinstance(col, str) else col
    name = F.upper(F.trim(F.regexp_replace(col, r"[.\s]+", " ")))
    if not aliases:
        return name
    pairs = [F.lit(part) for item in aliases.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name)


def strip_x(col: str | Column) -> Column:
    """Drop the X that spreadsheet exports put before numeric headers."""
    return F.regexp_replace(col, "^X", "")


def dotted_date(col: str | Column) -> Column:
    """Date of a ``X2006.01.01`` style header value."""
    return F.to_date(strip_x(col), "yyyy.MM.dd")


def last_token(col: str | Column, sep: str = "-") -> Column:
    return F.trim(F.substring_index(col, sep, -1))


def tail_chars(col: str | Column, n: int) -> Column:
    return F.right(col, F.lit(n))


def guarded_number(col: str | Column, kind: str = "double") -> Column:
    """Number of a text cell, null where it holds none."""
    col = F.col(col) if isinstance(col, str) else col
    return F.trim(col).try_cast(kind)
