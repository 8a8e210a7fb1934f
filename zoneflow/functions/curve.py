"""Z-order keys of points, and the ranges of keys that cover a circle.

A key interleaves the bits of the scaled longitude and latitude, so a square of the grid with a power of two on its side is one
range of keys. Tables stored in key order can then skip what lies outside a few ranges.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from zoneflow.functions.geo import EARTH_RADIUS_KM

#: Bits of either coordinate; 20 make cells of at most 38 by 19 m.
CURVE_BITS = 20


def curve_key(lat: Column, lon: Column, bits: int = CURVE_BITS) -> Column:
    """Key of a point in degrees, below ``4 ** bits``; null where a coordinate is null or not a number.

    Points outside the degrees' usual range count as on its border.
    """
    def place(value: Column, reach: int) -> Column:
        scaled = F.floor((value + reach) / (2 * reach) * 2**bits)
        return F.when(value.isNotNull() & ~F.isnan(value), F.greatest(F.lit(0), F.least(F.lit(2**bits - 1), scaled)))

    def spread(number: Column) -> Column:
        # binary digits read to the base four stand two bits apart
        return F.conv(F.bin(number.cast("long")), 4, 10).cast("long")

    return spread(place(lon, 180)) + 2 * spread(place(lat, 90))


def in_ranges(key: Column, ranges: list[tuple[int, int]]) -> Column:
    """Whether the key lies in one of the ranges, both ends included; comparisons with literals, which reach the scan."""
    found = [key.between(low, high) for low, high in ranges]
    while len(found) > 1:  # a balanced tree: its depth is the logarithm of the number of ranges
        found = [found[i] | found[i + 1] if i + 1 < len(found) else found[i] for i in range(0, len(found), 2)]
    return found[0] if found else F.lit(False)


def circle_ranges(lat: float, lon: float, radius_km: float, most: int = 64, bits: int = CURVE_BITS) -> list[tuple[int, int]]:
    """At most ``most`` ranges of keys, in order, that hold every point within the radius.

    Squares are quartered level by level. Those outside the circle go, those inside stay whole, and the others are quartered
    again until there would be too many; ``most`` is 4 at least.
    """
    if most < 4:
        raise ValueError("a circle needs at least 4 ranges")
    reach = radius_km / EARTH_RADIUS_KM + 1e-7
    if reach < 0:
        return []
    whole: list[tuple[int, int]] = []
    open_squares, level = [(0, 0)], 0  # places of squares with 2 ** (bits - level) on a side
    while level < bits and open_squares:
        quarters = [(2 * x + i, 2 * y + j) for x, y in open_squares for j in (0, 1) for i in (0, 1)]
        inside, border = [], []
        for x, y in quarters:
            box = _box(x, y, level + 1)
            if _nearest(lat, lon, *box) <= reach:
                (inside if _farthest(lat, lon, *box) <= reach else border).append((x, y))
        found = whole + [_range(x, y, bits - level - 1) for x, y in inside]
        if len(_joined(found + [_range(x, y, bits - level - 1) for x, y in border])) > most:
            break
        whole, open_squares, level = found, border, level + 1
    return _joined(whole + [_range(x, y, bits - level) for x, y in open_squares])


def _box(x: int, y: int, level: int) -> tuple[float, float, float, float]:
    side = 2.0**-level
    return 180 * y * side - 90, 180 * (y + 1) * side - 90, 360 * x * side - 180, 360 * (x + 1) * side - 180


def _nearest(lat: float, lon: float, south: float, north: float, west: float, east: float) -> float:
    """Least angle between a point and a box of degrees.

    Nearest is the meridian within the box that is closest in longitude. Along a meridian the cosine of the angle is a sine
    wave of the latitude, so its highest point or an end of the box is nearest.
    """
    across = 0.0 if west <= lon <= east else min(abs((edge - lon + 180) % 360 - 180) for edge in (west, east))
    up, along = math.sin(math.radians(lat)), math.cos(math.radians(lat)) * math.cos(math.radians(across))
    top = math.degrees(math.atan2(up, along))
    best = max(up * math.sin(math.radians(x)) + along * math.cos(math.radians(x)) for x in (south, north, min(max(top, south), north)))
    return math.acos(max(-1.0, min(1.0, best)))


def _farthest(lat: float, lon: float, south: float, north: float, west: float, east: float) -> float:
    """Largest angle between a point and a box: what is farthest from a point is nearest to the one opposite."""
    return math.pi - _nearest(-lat, lon - 180 if lon > 0 else lon + 180, south, north, west, east)


def _range(x: int, y: int, rest: int) -> tuple[int, int]:
    """Keys of the square at (x, y) with ``2 ** rest`` on a side."""
    first = (int(f"{x:b}", 4) + 2 * int(f"{y:b}", 4)) << 2 * rest
    return first, first + (1 << 2 * rest) - 1


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that touch as one."""
    joined: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if joined and low <= joined[-1][1] + 1:
            joined[-1] = joined[-1][0], max(high, joined[-1][1])
        else:
            joined.append((low, high))
    return joined
