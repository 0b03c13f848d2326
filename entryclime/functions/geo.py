"""Coordinates and distances as native column math (no geodesy library per row).

``lambert_km`` is Lambert's closed-form ellipsoidal correction to the
great-circle distance on the WGS-84 ellipsoid; it agrees with an iterative
geodesic solver to well under a metre at city scale. ``haversine_km`` is the
plain spherical distance.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entryclime.functions.text import ColumnOrName, _c

# WGS-84 ellipsoid and the mean Earth radius.
WGS84_A_KM = 6378.137
WGS84_F = 1 / 298.257223563
MEAN_RADIUS_KM = 6371.0088
# Defaults of the airport cleaning step (zero coordinates, missing elevation).
JFK_LONGITUDE = -73.778889
JFK_LATITUDE = 40.639722
DEFAULT_ELEVATION_FT = 13.12


def split_coordinates(c: ColumnOrName) -> Column:
    """``'lon, lat'`` -> struct(longitude double, latitude double); malformed parts give null."""
    parts = F.split(_c(c), ",")
    return F.struct(
        F.trim(F.get(parts, 0)).try_cast("double").alias("longitude"),
        F.trim(F.get(parts, 1)).try_cast("double").alias("latitude"),
    )


def hemisphere_degrees(c: ColumnOrName, positive: str, negative: str) -> Column:
    """``'32.01N'`` -> 32.01, ``'32.01S'`` -> -32.01; suffix must be upper case, anything else null."""
    x = _c(c)
    body = x.substr(F.lit(1), F.length(x) - 1)
    txt = F.when(x.endswith(positive), body).when(x.endswith(negative), F.concat(F.lit("-"), body))
    return txt.try_cast("double")


def latitude_degrees(c: ColumnOrName) -> Column:
    return hemisphere_degrees(c, "N", "S")


def longitude_degrees(c: ColumnOrName) -> Column:
    return hemisphere_degrees(c, "E", "W")


def hemisphere_degrees_lenient(c: ColumnOrName, positive: str, negative: str) -> Column:
    """Case-insensitive suffix; text without a known suffix is cast as it is."""
    x = _c(c)
    suffix = F.upper(F.substring(x, -1, 1))
    body = x.substr(F.lit(1), F.length(x) - 1)
    txt = (
        F.when(suffix == positive, body)
        .when(suffix == negative, F.concat(F.lit("-"), body))
        .otherwise(x)
    )
    return txt.try_cast("double")


def replace_zero(c: ColumnOrName, value: float) -> Column:
    x = _c(c)
    return F.when(x == 0, F.lit(value)).otherwise(x)


def _rad(c: Column) -> Column:
    return F.radians(c)


def reduced_latitude(lat_deg: ColumnOrName) -> Column:
    """Parametric latitude (radians) on the WGS-84 ellipsoid."""
    return F.atan(F.lit(1 - WGS84_F) * F.tan(_rad(_c(lat_deg))))


POINT_TERMS = ("sb", "cb", "cosb", "sl", "cl")


def point_terms(lat_deg: ColumnOrName, lon_deg: ColumnOrName, reduced: bool = True) -> dict[str, Column]:
    """Per-point trig terms: sin/cos of half the (reduced) latitude, cos of it, sin/cos of half the longitude.

    Computing them once per row (before a join) keeps the per-pair formula
    small: it is then only products and sums of these columns.
    """
    b = reduced_latitude(lat_deg) if reduced else _rad(_c(lat_deg))
    lo = _rad(_c(lon_deg))
    return {"sb": F.sin(b / 2), "cb": F.cos(b / 2), "cosb": F.cos(b), "sl": F.sin(lo / 2), "cl": F.cos(lo / 2)}


def _pair(t1: dict[str, Column], t2: dict[str, Column]) -> tuple[Column, Column, Column, Column, Column]:
    """(h, sin Q, cos Q, sin P, cos P) for two points; h = sin^2(sigma / 2) (haversine)."""
    sq = t2["sb"] * t1["cb"] - t2["cb"] * t1["sb"]          # sin((b2 - b1) / 2)
    cq = t2["cb"] * t1["cb"] + t2["sb"] * t1["sb"]          # cos((b2 - b1) / 2)
    sdl = t2["sl"] * t1["cl"] - t2["cl"] * t1["sl"]         # sin((l2 - l1) / 2)
    h = F.least(F.lit(1.0), sq * sq + t1["cosb"] * t2["cosb"] * (sdl * sdl))
    sp = t1["sb"] * t2["cb"] + t1["cb"] * t2["sb"]          # sin((b1 + b2) / 2)
    cp = t1["cb"] * t2["cb"] - t1["sb"] * t2["sb"]          # cos((b1 + b2) / 2)
    return h, sq, cq, sp, cp


def lambert_from_terms(t1: dict[str, Column], t2: dict[str, Column]) -> Column:
    """Lambert distance in km from two points' ``point_terms(reduced=True)``.

    With h = sin^2(s/2): s = 2 asin(sqrt h), sin s = 2 sqrt(h (1 - h)),
    cos^2(s/2) = 1 - h. Coincident points return 0.
    """
    h, sq, cq, sp, cp = _pair(t1, t2)
    s = F.lit(2.0) * F.asin(F.sqrt(h))
    sin_s = F.lit(2.0) * F.sqrt(h * (F.lit(1.0) - h))
    x = (s - sin_s) * (sp * sp) * (cq * cq) / F.nullif(F.lit(1.0) - h, F.lit(0.0))
    y = (s + sin_s) * (cp * cp) * (sq * sq) / F.nullif(h, F.lit(0.0))
    d = F.lit(WGS84_A_KM) * (s - F.lit(WGS84_F / 2) * (x + y))
    return F.when(h == 0, F.lit(0.0)).otherwise(d)


def haversine_from_terms(t1: dict[str, Column], t2: dict[str, Column], radius_km: float = MEAN_RADIUS_KM) -> Column:
    h = _pair(t1, t2)[0]
    return F.lit(radius_km) * (F.lit(2.0) * F.asin(F.sqrt(h)))


def haversine_km(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName,
                 radius_km: float = MEAN_RADIUS_KM) -> Column:
    return haversine_from_terms(point_terms(lat1, lon1, False), point_terms(lat2, lon2, False), radius_km)


def lambert_km(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName) -> Column:
    return lambert_from_terms(point_terms(lat1, lon1), point_terms(lat2, lon2))


def unit_vector(lat_deg: ColumnOrName, lon_deg: ColumnOrName) -> tuple[Column, Column, Column]:
    """Point on the unit sphere; used to bucket points into 3-D grid cells."""
    la, lo = _rad(_c(lat_deg)), _rad(_c(lon_deg))
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def cell_size_for(max_km: float) -> float:
    """Grid edge (unit-sphere chord units) that any pair within ``max_km`` cannot skip.

    The chord is never longer than the arc, and the smallest radius of
    curvature of the ellipsoid is above 6335 km, so arcs within ``max_km`` on
    the ellipsoid are below ``max_km / 6335`` on the unit sphere; a 5 % margin
    covers the spherical approximation of the cell coordinates.
    """
    return max_km / 6335.0 * 1.05 + 1e-9
