"""Distances on the sphere and the ellipsoid, and the equal-area projection."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Mean Earth radius (km) and the WGS84 ellipsoid (m).
EARTH_KM = 6371.0088
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    la1, lo1, la2, lo2 = (F.radians(_c(c)) for c in (lat1, lon1, lat2, lon2))
    s = F.pow(F.sin((la2 - la1) / 2), F.lit(2.0)) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), F.lit(2.0))
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(s)))


def _vincenty_km(lat1, lon1, lat2, lon2, max_iter: int = 200):
    """Inverse geodesic by Vincenty's series; NaN where it does not settle."""
    b = (1 - WGS84_F) * WGS84_A
    u1 = np.arctan((1 - WGS84_F) * np.tan(np.radians(lat1)))
    u2 = np.arctan((1 - WGS84_F) * np.tan(np.radians(lat2)))
    dl = np.radians(lon2 - lon1)
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = dl.copy()
    settled = np.zeros(len(dl), dtype=bool)
    with np.errstate(all="ignore"):
        for _ in range(max_iter):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            cs = su1 * su2 + cu1 * cu2 * cl
            sigma = np.arctan2(ss, cs)
            sin_alpha = np.where(ss == 0, 0.0, cu1 * cu2 * sl / np.where(ss == 0, 1.0, ss))
            cos2 = 1 - sin_alpha**2
            mid = np.where(cos2 == 0, 0.0, cs - 2 * su1 * su2 / np.where(cos2 == 0, 1.0, cos2))
            c = WGS84_F / 16 * cos2 * (4 + WGS84_F * (4 - 3 * cos2))
            new = dl + (1 - c) * WGS84_F * sin_alpha * (
                sigma + c * ss * (mid + c * cs * (2 * mid**2 - 1))
            )
            settled = np.abs(new - lam) < 1e-12
            lam = new
            if settled.all():
                break
        usq = cos2 * (WGS84_A**2 - b**2) / b**2
        big_a = 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq)))
        big_b = usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq)))
        dsig = big_b * ss * (
            mid + big_b / 4 * (cs * (2 * mid**2 - 1) - big_b / 6 * mid * (4 * ss**2 - 3) * (4 * mid**2 - 3))
        )
        out = b * big_a * (sigma - dsig) / 1000.0
    return np.where(settled, out, np.nan)


@F.pandas_udf(T.DoubleType())
def _geodesic_udf(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    args = [s.to_numpy(dtype=float) for s in (lat1, lon1, lat2, lon2)]
    out = pd.Series(_vincenty_km(*args))
    return out.where(out.notna(), None)


def geodesic_km(lat1, lon1, lat2, lon2) -> Column:
    """Ellipsoidal distance; null for null input and near-antipodal pairs."""
    return _geodesic_udf(*(_c(c).cast("double") for c in (lat1, lon1, lat2, lon2)))


def albers_constants(lat_1: float, lat_2: float, lat_0: float) -> tuple[float, float, float, float]:
    """Cone constant, C, radius of the origin (m) and squared eccentricity of the projection."""
    e2 = WGS84_F * (2 - WGS84_F)
    e = math.sqrt(e2)

    def q_num(phi):
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def m_num(phi):
        return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

    p1, p2, p0 = (math.radians(v) for v in (lat_1, lat_2, lat_0))
    n = (m_num(p1) ** 2 - m_num(p2) ** 2) / (q_num(p2) - q_num(p1))
    c = m_num(p1) ** 2 + n * q_num(p1)
    return n, c, WGS84_A * math.sqrt(c - n * q_num(p0)) / n, e2


def albers_xy(lat, lon, lat_1=20.0, lat_2=-23.0, lat_0=0.0, lon_0=25.0) -> tuple[Column, Column]:
    """Albers equal-area conic coordinates (m) on WGS84."""
    n, c, rho0, e2 = albers_constants(lat_1, lat_2, lat_0)
    e = math.sqrt(e2)
    s = F.sin(F.radians(_c(lat)))
    q = (1 - e2) * (s / (1 - e2 * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
    rho = WGS84_A * F.sqrt(F.lit(c) - n * q) / n
    theta = n * F.radians(_c(lon) - F.lit(float(lon_0)))
    return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)
