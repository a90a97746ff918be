"""EPSG:3031 (polar stereographic south, true scale -71, WGS84) <-> lat/lon
as Column expressions (closed series inverse; Snyder 1987, eqs. 21-38, 3-5)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from floe import constants as C
from floe.functions.grid import col

_E2 = C.WGS84_F * (2.0 - C.WGS84_F)
_E = math.sqrt(_E2)
_PHI_C = math.radians(abs(C.TRUE_SCALE_LAT_DEG))


def _t(phi: float) -> float:
    s = math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - _E * s) / (1 + _E * s)) ** (_E / 2)


_MC = math.cos(_PHI_C) / math.sqrt(1 - _E2 * math.sin(_PHI_C) ** 2)
_TC = _t(_PHI_C)
_E4, _E6, _E8 = _E2 ** 2, _E2 ** 3, _E2 ** 4
_K2 = _E2 / 2 + 5 * _E4 / 24 + _E6 / 12 + 13 * _E8 / 360
_K4 = 7 * _E4 / 48 + 29 * _E6 / 240 + 811 * _E8 / 11520
_K6 = 7 * _E6 / 120 + 81 * _E8 / 1120
_K8 = 4279 * _E8 / 161280


def xy_to_latlon(x="x", y="y") -> tuple[Column, Column]:
    """Projected metres -> (lat, lon) degrees. Pure JVM expressions."""
    xc, yc = col(x), col(y)
    rho = F.hypot(xc, yc)
    chi = F.lit(math.pi / 2) - F.atan(rho * F.lit(_TC / (C.WGS84_A * _MC))) * F.lit(2.0)
    phi = (chi + F.lit(_K2) * F.sin(chi * 2) + F.lit(_K4) * F.sin(chi * 4)
           + F.lit(_K6) * F.sin(chi * 6) + F.lit(_K8) * F.sin(chi * 8))
    lat = -F.degrees(phi)
    lon = F.degrees(F.atan2(xc, yc)) + F.lit(C.CENTRAL_LON_DEG)
    return lat, lon


def latlon_to_xy_py(lat_deg: float, lon_deg: float) -> tuple[float, float]:
    """Forward projection in plain Python (tests and small helpers only)."""
    phi = math.radians(-lat_deg)
    lam = math.radians(lon_deg - C.CENTRAL_LON_DEG)
    rho = C.WGS84_A * _MC * _t(phi) / _TC
    return rho * math.sin(lam), rho * math.cos(lam)


def unit_vector(lat="lat", lon="lon") -> tuple[Column, Column, Column]:
    """Point on the unit sphere (for chord distances)."""
    la, lo = F.radians(col(lat)), F.radians(col(lon))
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)
