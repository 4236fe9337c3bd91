"""Albers equal-area conic as column math (Snyder 1987, GRS80)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from zoneday import fixed_values as fv

_f = 1 / fv.GRS80_INV_F
_e2 = 2 * _f - _f * _f
_e = math.sqrt(_e2)
_a = fv.GRS80_A


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - _e2 * math.sin(phi) ** 2)


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - _e2) * (s / (1 - _e2 * s * s) - math.log((1 - _e * s) / (1 + _e * s)) / (2 * _e))


_phi0 = math.radians(fv.ALBERS_LAT0)
_phi1, _phi2 = (math.radians(p) for p in fv.ALBERS_PARALLELS)
_n = (_m(_phi1) ** 2 - _m(_phi2) ** 2) / (_q(_phi2) - _q(_phi1))
_c = _m(_phi1) ** 2 + _n * _q(_phi1)
_rho0 = _a * math.sqrt(_c - _n * _q(_phi0)) / _n
_qp = _q(math.pi / 2)
_fe, _fn = fv.ALBERS_FALSE_ORIGIN

# constants a test or an SQL restatement needs
PARAMETERS = {"e2": _e2, "e": _e, "a": _a, "n": _n, "c": _c, "rho0": _rho0, "qp": _qp, "fe": _fe, "fn": _fn}


def albers_forward(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees to plane metres."""
    s = F.sin(F.radians(lat))
    q = (1 - _e2) * (s / (1 - _e2 * s * s) - F.ln((1 - _e * s) / (1 + _e * s)) / (2 * _e))
    rho = _a * F.sqrt(_c - _n * q) / _n
    theta = _n * F.radians(lon - fv.ALBERS_LON0)
    return _fe + rho * F.sin(theta), _fn + _rho0 - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """Plane metres back to longitude and latitude in degrees."""
    dx, dy = x - _fe, _rho0 - (y - _fn)
    rho2 = dx * dx + dy * dy
    q = (_c - rho2 * (_n * _n) / (_a * _a)) / _n
    beta = F.asin(q / _qp)
    lat = (
        beta
        + (_e2 / 3 + 31 * _e2**2 / 180 + 517 * _e2**3 / 5040) * F.sin(2 * beta)
        + (23 * _e2**2 / 360 + 251 * _e2**3 / 3780) * F.sin(4 * beta)
        + (761 * _e2**3 / 45360) * F.sin(6 * beta)
    )
    return fv.ALBERS_LON0 + F.degrees(F.atan2(dx, dy)) / _n, F.degrees(lat)
