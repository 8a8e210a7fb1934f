"""Job parameters, checked once on the driver before any plan is built."""

from __future__ import annotations

import math
import os
from collections.abc import Mapping
from dataclasses import dataclass

# Defaults of the pricing job and the names of its topics.
RIDE_REQUESTS_TOPIC = "ride_requests"
DRIVER_UPDATES_TOPIC = "driver_updates"
PRICING_TOPIC = "zone_pricing"
AVAILABLE = "available"
WINDOW_SECONDS = 15
SLIDE_SECONDS = 5
MIN_MULTIPLIER = 0.9
MAX_MULTIPLIER = 1.5
PRESSURE_WEIGHT = 0.4


@dataclass(frozen=True)
class PricingParams:
    """Window shape, price formula and topic names of one pricing job."""

    window_seconds: int = WINDOW_SECONDS
    slide_seconds: int = SLIDE_SECONDS
    min_multiplier: float = MIN_MULTIPLIER
    max_multiplier: float = MAX_MULTIPLIER
    pressure_weight: float = PRESSURE_WEIGHT
    ride_topic: str = RIDE_REQUESTS_TOPIC
    driver_topic: str = DRIVER_UPDATES_TOPIC
    pricing_topic: str = PRICING_TOPIC

    def __post_init__(self) -> None:
        if not self.min_multiplier > 0:
            raise ValueError("min_multiplier must be above zero")
        if not self.max_multiplier >= self.min_multiplier:
            raise ValueError("max_multiplier must not be below min_multiplier")
        if not self.pressure_weight > 0:
            raise ValueError("pressure_weight must be above zero")
        if not 0 < self.slide_seconds <= self.window_seconds:
            raise ValueError("slide_seconds must be above zero and at most window_seconds")

    @property
    def window(self) -> str:
        return f"{self.window_seconds} seconds"

    @property
    def slide(self) -> str:
        return f"{self.slide_seconds} seconds"

    @property
    def watermark(self) -> str:
        """Events may be late by one window length."""
        return self.window

    @property
    def pane_seconds(self) -> int:
        """Longest tumbling pane that tiles every sliding window exactly."""
        return math.gcd(self.window_seconds, self.slide_seconds)

    @property
    def event_topics(self) -> tuple[str, str]:
        return (self.ride_topic, self.driver_topic)

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> PricingParams:
        """Read the job's environment variables; unset ones keep their defaults."""
        env = os.environ if env is None else env
        variables = {
            "window_seconds": ("PRICING_WINDOW_SECONDS", int),
            "slide_seconds": ("PRICING_SLIDE_SECONDS", int),
            "min_multiplier": ("PRICING_MIN_MULTIPLIER", float),
            "max_multiplier": ("PRICING_MAX_MULTIPLIER", float),
            "pressure_weight": ("PRICING_PRESSURE_WEIGHT", float),
            "ride_topic": ("RIDE_REQUESTS_TOPIC", str),
            "driver_topic": ("DRIVER_UPDATES_TOPIC", str),
            "pricing_topic": ("PRICING_TOPIC", str),
        }
        return cls(**{field: read(env[name]) for field, (name, read) in variables.items() if name in env})
