"""Zone-level marketplace pricing on Spark: demand, supply, pressure and price per zone and window."""

from zoneflow.params import PricingParams

__all__ = ["PricingParams"]
