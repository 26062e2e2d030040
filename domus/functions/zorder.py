"""Z-order key of a point: the bits of latitude and longitude interleaved, so that points with
near keys are near in both coordinates. Built-in bit operations only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 31
# Masks that spread the low 31 bits of a number to its even bits.
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _cell(x: Column, lo: float, hi: float) -> Column:
    """Which of 2**BITS equal cells of [lo, hi]; values beyond the ends lie in the end cells."""
    share = (x.cast("double") - F.lit(lo)) / F.lit(hi - lo)
    return F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * F.lit(float((1 << BITS) - 1))).cast("bigint")


def _spread(n: Column) -> Column:
    for step, mask in SPREAD:
        n = n.bitwiseOR(F.shiftleft(n, step)).bitwiseAND(F.lit(mask))
    return n


def z_key(lat: Column | str, lon: Column | str) -> Column:
    """62-bit key of a point in degrees; NULL where a coordinate is NULL or not a number."""
    lat, lon = (F.col(c) if isinstance(c, str) else c for c in (lat, lon))
    whole = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    return F.when(whole, F.shiftleft(_spread(_cell(lat, -90.0, 90.0)), 1).bitwiseOR(_spread(_cell(lon, -180.0, 180.0))))
