"""The shipped configuration: zone area, zone types and time patterns."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow import schemas


@dataclass(frozen=True)
class Factors:
    """Demand and supply factors where no time pattern applies."""

    demand_factor: float = 1.0
    supply_factor: float = 1.0


@dataclass(frozen=True)
class Area:
    center_lat: float
    center_lon: float
    radius_km: float


@dataclass(frozen=True)
class ZoneType:
    zone_type_id: str
    type: str
    base_demand: int
    base_supply: int
    price_sensitivity: float
    avg_distance: int
    probability: float


@dataclass(frozen=True)
class ZonesConfig:
    h3_resolution: int
    random_seed: int
    area: Area
    zone_types: tuple[ZoneType, ...]

    def __post_init__(self) -> None:
        check_probabilities(self.zone_types)


@dataclass(frozen=True)
class TimePatterns:
    """Patterns in list order (``pattern_index`` decides ties) and the default factors."""

    patterns: DataFrame
    default: Factors = field(default_factory=Factors)


#: How far from one the sum of probabilities may be.
PROBABILITY_SLACK = 1e-9


def check_probabilities(zone_types: tuple[ZoneType, ...]) -> None:
    """Selection probabilities add up to one."""
    total = sum(t.probability for t in zone_types)
    if not abs(total - 1.0) <= PROBABILITY_SLACK:
        raise ValueError(f"zone type probabilities add up to {total}, not to 1")


# Area, zone type profiles and time factors.
ZONES = ZonesConfig(
    h3_resolution=7,
    random_seed=42,
    area=Area(center_lat=35.7595, center_lon=-5.8340, radius_km=8.0),
    zone_types=(
        ZoneType("A", "downtown", 50, 40, 0.6, 3, 0.1),
        ZoneType("B", "residential", 20, 15, 1.0, 6, 0.5),
        ZoneType("C", "airport", 15, 20, 0.5, 15, 0.05),
        ZoneType("D", "suburb", 5, 2, 1.2, 7, 0.35),
    ),
)

# pattern, day type, hours, then (demand factor, supply factor) of each zone type
TIME_PATTERNS = (
    ("weekday_morning_peak", "weekday", (7, 8, 9),
     {"residential": (1.8, 1.1), "downtown": (1.5, 1.3), "suburb": (1.4, 0.9), "airport": (1.1, 1.2)}),
    ("weekday_midday", "weekday", (10, 11, 12, 13, 14, 15, 16),
     {"residential": (0.8, 1.0), "downtown": (1.2, 1.2), "suburb": (0.7, 0.9), "airport": (1.2, 1.3)}),
    ("weekday_evening_peak", "weekday", (17, 18, 19),
     {"residential": (1.3, 1.0), "downtown": (1.7, 1.2), "suburb": (1.1, 0.9), "airport": (1.3, 1.3)}),
    ("weekday_night", "weekday", (20, 21, 22, 23, 0, 1, 2, 3, 4, 5, 6),
     {"residential": (0.6, 0.7), "downtown": (0.8, 0.8), "suburb": (0.4, 0.5), "airport": (0.9, 0.8)}),
    ("weekend_day", "weekend", (8, 9, 10, 11, 12, 13, 14, 15, 16, 17),
     {"residential": (1.1, 1.0), "downtown": (1.3, 1.2), "suburb": (1.0, 0.9), "airport": (1.4, 1.3)}),
    ("weekend_night", "weekend", (18, 19, 20, 21, 22, 23, 0, 1, 2),
     {"residential": (1.3, 0.9), "downtown": (2.0, 1.2), "suburb": (0.8, 0.6), "airport": (1.2, 1.0)}),
)


def time_patterns(spark: SparkSession) -> TimePatterns:
    """The shipped time patterns.

    They are parsed from a literal, so Catalyst knows how small the table is; rows handed over from
    Python would have no size and would not be broadcast.
    """
    names = schemas.FACTORS.fieldNames()
    rows = [
        {"pattern_id": name, "day_type": day, "hours": hours,
         "zone_type_multipliers": {kind: dict(zip(names, pair)) for kind, pair in factors.items()}}
        for name, day, hours, factors in TIME_PATTERNS
    ]
    listed = F.from_json(F.lit(json.dumps(rows)), schemas.T.ArrayType(schemas.TIME_PATTERN))
    patterns = spark.range(0, 1, 1, 1).select(F.posexplode(listed).alias("pattern_index", "pattern"))
    return TimePatterns(patterns.select("pattern_index", "pattern.*"))
