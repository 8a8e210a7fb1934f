"""The zone board: every zone with its latest price, colours, totals and map centre."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions import display

COLOR_MODES = ("Price multiplier", "Demand count", "Supply count", "Pressure")  # fixed values: the board's choices


def board_maxima(latest: DataFrame) -> DataFrame:
    """Largest demand, supply and absolute pressure over all latest prices, 0 where there are none.

    Prices of zones that are not on the board count too.
    """
    return latest.agg(
        F.coalesce(F.max("demand_count"), F.lit(0)).alias("max_demand"),
        F.coalesce(F.max("available_driver_count"), F.lit(0)).alias("max_supply"),
        F.coalesce(F.max(F.abs("pressure")), F.lit(0.0)).alias("max_pressure"),
    )


def zone_board(zones: DataFrame, latest: DataFrame, color_by: str = COLOR_MODES[0]) -> DataFrame:
    """Every zone with its latest price; a zone without one shows neutral values.

    ``latest`` has one row per zone, so neither side of the join can be skewed; whether one side is
    broadcast is left to its measured size. The maxima are one row, read as a scalar subquery; they
    are a second pass over ``latest``, which a caller should have written to a table by then.
    """
    prices = latest.select("h3_zone", *_neutral())
    rows = zones.join(prices, "h3_zone", "left").withColumns(
        {name: F.coalesce(F.col(name).cast(kind), F.lit(neutral).cast(kind))
         for name, (kind, neutral) in _neutral().items()}
    )
    return rows.select(
        *zones.columns,
        *_neutral(),
        F.array("center_lon", "center_lat").alias("label_position"),
        _zone_color(color_by, latest).alias("fill_color"),
        F.array(*[F.lit(channel) for channel in display.ZONE_OUTLINE]).alias("line_color"),
        display.zone_label(
            F.col("price_multiplier"), F.col("demand_count"), F.col("available_driver_count")
        ).alias("label"),
    )


def _neutral() -> dict[str, tuple[str, float]]:
    return {
        "price_multiplier": ("double", 1.0),
        "demand_count": ("int", 0),
        "available_driver_count": ("int", 0),
        "pressure": ("double", 0.0),
    }


def _zone_color(color_by: str, latest: DataFrame) -> Column:
    if color_by not in COLOR_MODES:
        raise ValueError(f"color_by is one of {COLOR_MODES}")
    if color_by == COLOR_MODES[0]:
        return display.multiplier_color(F.col("price_multiplier"))
    value, largest = {
        "Demand count": (F.col("demand_count"), "max_demand"),
        "Supply count": (F.col("available_driver_count"), "max_supply"),
        "Pressure": (F.abs("pressure"), "max_pressure"),
    }[color_by]
    return display.metric_color(value, board_maxima(latest).select(largest).scalar())


def board_kpis(board: DataFrame) -> DataFrame:
    """Tracked zones, total demand and supply, average multiplier (1.0 without zones) and map centre."""
    return board.agg(
        F.count("*").alias("tracked_zones"),
        F.coalesce(F.sum("demand_count"), F.lit(0)).alias("total_demand"),
        F.coalesce(F.sum("available_driver_count"), F.lit(0)).alias("total_supply"),
        F.coalesce(F.avg("price_multiplier"), F.lit(1.0)).alias("average_multiplier"),
        F.avg("center_lat").alias("center_lat"),
        F.avg("center_lon").alias("center_lon"),
    )
