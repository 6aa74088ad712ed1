"""Registered queries: operators bound to the test tables, with SQL where it can say the same."""

from sparkpanel.queries import basic, fits, market, scoring, series, survey, weather  # noqa: F401
from sparkpanel.queries.base import ORACLES, QUERIES  # noqa: F401
