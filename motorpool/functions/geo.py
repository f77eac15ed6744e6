"""Trip geometry: bearings, levelling, distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Forward azimuth in degrees, 0..360."""
    a1, a2, dlon = F.radians(lat1), F.radians(lat2), F.radians(lon2) - F.radians(lon1)
    east = F.sin(dlon) * F.cos(a2)
    north = F.cos(a1) * F.sin(a2) - F.sin(a1) * F.cos(a2) * F.cos(dlon)
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))


def wrap_degrees(delta: Column) -> Column:
    """Into [-180, 180)."""
    return F.pmod(delta + 180.0, F.lit(360.0)) - 180.0


def metres(speed_kmh: Column, seconds: Column) -> Column:
    return speed_kmh * (5.0 / 18.0) * seconds


def levelled(x: Column, y: Column, z: Column, mx: Column, my: Column, mz: Column, corrected: bool = False):
    """Rotate accelerations by the tilt of the stationary medians (mx, my, mz).

    The default keeps the established convention, whose angles add to the tilt;
    ``corrected=True`` removes the tilt instead.
    """
    pitch = F.atan2(-mx, F.sqrt(my * my + mz * mz))
    roll = F.atan2(my, F.sqrt(mx * mx + mz * mz))
    if corrected:
        pitch, roll = -pitch, -F.atan2(my, mz)
    cr, sr, cp, sp = F.cos(roll), F.sin(roll), F.cos(pitch), F.sin(pitch)
    y1 = cr * y + sr * z
    z1 = cr * z - sr * y
    return cp * x - sp * z1, y1, sp * x + cp * z1


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Planar distance of a point to a segment, in the units of the coordinates."""
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    t = F.when(length2 == 0, 0.0).otherwise(((px - ax) * dx + (py - ay) * dy) / length2)
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    ex, ey = px - (ax + t * dx), py - (ay + t * dy)
    return F.sqrt(ex * ex + ey * ey)
