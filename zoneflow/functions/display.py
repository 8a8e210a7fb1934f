"""Colours and labels of the zone board."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: [red, green, blue, alpha] of the board.
REQUEST = (20, 70, 255, 245)
AVAILABLE_DRIVER = (35, 170, 85, 180)
OTHER_DRIVER = (120, 120, 120, 150)
ZONE_OUTLINE = (35, 35, 35, 190)


def rgba(*channels: int | Column) -> Column:
    """Colour as an array of four ints; fractions are cut off."""
    return F.array(*[c.cast("int") if isinstance(c, Column) else F.lit(c) for c in channels])


def unit_interval(value: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))


def driver_color(status: Column) -> Column:
    return F.when(status == "available", rgba(*AVAILABLE_DRIVER)).otherwise(rgba(*OTHER_DRIVER))


def multiplier_color(multiplier: Column) -> Column:
    """Green at 0.9 to red at 1.5. The ends of the ramp and its bounds."""
    n = unit_interval((multiplier - 0.9) / 0.6)
    return rgba(70 + n * 185, 180 - n * 130, 80, 150)


def metric_color(value: Column, largest: Column) -> Column:
    """Blue that brightens with the share of the largest value. The ends of the ramp."""
    n = F.when(largest <= 0, F.lit(0.0)).otherwise(unit_interval(value / largest))
    return rgba(50, 120 + n * 90, 150 + n * 90, 145)


def zone_label(multiplier: Column, demand: Column, supply: Column) -> Column:
    return F.format_string("%.2fx\nD %d / S %d", multiplier, demand, supply)
