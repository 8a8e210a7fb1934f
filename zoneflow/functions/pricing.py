"""The price formula, defined once for batch and stream."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zoneflow.params import AVAILABLE, PricingParams


def demand_increment(topic: Column, params: PricingParams) -> Column:
    """1 for a ride request, else 0."""
    return F.when(topic == params.ride_topic, 1).otherwise(0)


def supply_increment(topic: Column, status: Column, params: PricingParams) -> Column:
    """1 for a driver update whose status is exactly ``available``, else 0."""
    return F.when((topic == params.driver_topic) & (status == AVAILABLE), 1).otherwise(0)


def pressure(demand: Column, supply: Column) -> Column:
    """Demand over supply minus one; 0 in an empty market, NULL with demand but no supply."""
    d, s = demand.cast("double"), supply.cast("double")
    return F.when((d <= 0) & (s <= 0), F.lit(0.0)).when(s > 0, d / s - 1)


def multiplier(demand: Column, supply: Column, params: PricingParams) -> Column:
    """Bounded price multiplier.

    The two empty-supply cases are decided before the formula: ``greatest`` skips NULL, so an
    unguarded NULL pressure would come out as the lowest price instead of the highest.
    """
    d, s = demand.cast("double"), supply.cast("double")
    formula = 1 + F.lit(float(params.pressure_weight)) * F.tanh(pressure(demand, supply))
    lowest, highest = F.lit(float(params.min_multiplier)), F.lit(float(params.max_multiplier))
    return (
        F.when((d <= 0) & (s <= 0), F.lit(1.0))
        .when(s <= 0, highest)
        .otherwise(F.least(highest, F.greatest(lowest, formula)))
    )
