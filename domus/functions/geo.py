"""Great-circle distance and a radius predicate, built from JVM-side math functions.

Distance semantics recovered from upstream sample payloads: haversine on a sphere of
radius 6,371,000 m, floored to whole metres and carried as text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in metres and the default search centre / radius.
EARTH_RADIUS_M = 6_371_000.0
DEFAULT_CENTER = (38.371622, -0.424756)
DEFAULT_RADIUS_M = 4500.0


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def haversine_m(lat, lon, lat0: float, lon0: float) -> Column:
    """Metres between each (lat, lon) row and the fixed point (lat0, lon0)."""
    lat_r, lon_r = F.radians(_c(lat)), F.radians(_c(lon))
    lat0_r, lon0_r = math.radians(lat0), math.radians(lon0)
    a = F.pow(F.sin((lat_r - F.lit(lat0_r)) / 2), 2) + F.lit(math.cos(lat0_r)) * F.cos(
        lat_r
    ) * F.pow(F.sin((lon_r - F.lit(lon0_r)) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))


def distance_text(metres: Column) -> Column:
    """Whole metres, floored, as a string (the payload's ``distance`` representation)."""
    return F.floor(metres).cast("string")


def bounding_box(lat0: float, lon0: float, radius_m: float) -> tuple[float, float, float, float] | None:
    """(lat_lo, lat_hi, lon_lo, lon_hi) enclosing the circle, or None when no safe box exists.

    The latitude half-width is exact; the longitude half-width is the widest point of the
    circle. Near a pole or across the antimeridian the box would be wrong, so we return
    None and let the exact predicate run alone.
    """
    ang = radius_m / EARTH_RADIUS_M
    if ang >= math.pi / 2:
        return None
    dlat = math.degrees(ang)
    lat_lo, lat_hi = lat0 - dlat, lat0 + dlat
    if lat_lo <= -90.0 or lat_hi >= 90.0:
        return None
    s = math.sin(ang) / math.cos(math.radians(lat0))
    if s >= 1.0:
        return None
    dlon = math.degrees(math.asin(s))
    lon_lo, lon_hi = lon0 - dlon, lon0 + dlon
    if lon_lo < -180.0 or lon_hi > 180.0:
        return None
    # Widen by a hair so float rounding in the box never drops a row the exact test keeps.
    eps = 1e-9
    return lat_lo - eps, lat_hi + eps, lon_lo - eps, lon_hi + eps


def bounding_boxes(lat0: float, lon0: float, radius_m: float) -> list[tuple[float, float, float, float]] | None:
    """Boxes that together enclose the circle: one, two beside the antimeridian, or a cap of all
    longitudes where the circle reaches a pole. None when the circle covers half the globe."""
    one = bounding_box(lat0, lon0, radius_m)
    if one is not None:
        return [one]
    ang = radius_m / EARTH_RADIUS_M
    if ang >= math.pi / 2:
        return None
    eps = 1e-9
    lat_lo, lat_hi = lat0 - math.degrees(ang) - eps, lat0 + math.degrees(ang) + eps
    s = math.sin(ang) / max(math.cos(math.radians(lat0)), 1e-300)
    if lat_lo <= -90.0 or lat_hi >= 90.0 or s >= 1.0:
        return [(max(lat_lo, -90.0), min(lat_hi, 90.0), -180.0, 180.0)]
    dlon = math.degrees(math.asin(s)) + eps
    lon0 = (lon0 + 180.0) % 360.0 - 180.0
    lo, hi = lon0 - dlon, lon0 + dlon
    if lo >= -180.0 and hi <= 180.0:
        return [(lat_lo, lat_hi, lo, hi)]
    return [(lat_lo, lat_hi, lo + 360.0 if lo < -180.0 else lo, 180.0), (lat_lo, lat_hi, -180.0, hi if lo < -180.0 else hi - 360.0)]


def within_radius(lat, lon, lat0: float, lon0: float, radius_m: float) -> Column:
    """Box pre-filter (pushes to Parquet row-group stats) AND exact haversine <= radius. Beside the
    antimeridian the box is two boxes; rows whose longitude is written beyond +-180 pass them."""
    exact = haversine_m(lat, lon, lat0, lon0) <= F.lit(float(radius_m))
    boxes = bounding_boxes(lat0, lon0, radius_m)
    if boxes is None:
        return exact
    near = _c(lat).between(boxes[0][0], boxes[0][1])
    beside = _c(lon).between(*boxes[0][2:])
    if len(boxes) > 1:
        beside = beside | _c(lon).between(*boxes[1][2:]) | (_c(lon) < F.lit(-180.0)) | (_c(lon) > F.lit(180.0))
    return near & beside & exact
