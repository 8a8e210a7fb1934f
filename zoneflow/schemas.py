"""Declared schemas of every record that crosses a boundary; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# One message on an event topic, as the pricing job reads it.
EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("h3_zone", T.StringType()),
    T.StructField("status", T.StringType()),
])

# What a message source delivers.
ENVELOPE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

# A price update inside a JSON message: timestamps travel as text.
PRICE_MESSAGE = T.StructType([
    T.StructField("h3_zone", T.StringType()),
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("demand_count", T.IntegerType()),
    T.StructField("available_driver_count", T.IntegerType()),
    T.StructField("pressure", T.DoubleType()),
    T.StructField("price_multiplier", T.DoubleType()),
    T.StructField("calculated_at", T.StringType()),
])

ZONE = T.StructType([
    T.StructField("zone_id", T.StringType()),
    T.StructField("h3_zone", T.StringType()),
    T.StructField("center_lat", T.DoubleType()),
    T.StructField("center_lon", T.DoubleType()),
    T.StructField("distance_from_center_km", T.DoubleType()),
    T.StructField("zone_type_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("base_demand", T.IntegerType()),
    T.StructField("base_supply", T.IntegerType()),
    T.StructField("price_sensitivity", T.DoubleType()),
    T.StructField("avg_distance", T.IntegerType()),
    T.StructField("selection_probability", T.DoubleType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("h3_resolution", T.IntegerType()),
])

FACTORS = T.StructType([
    T.StructField("demand_factor", T.DoubleType()),
    T.StructField("supply_factor", T.DoubleType()),
])

TIME_PATTERN = T.StructType([
    T.StructField("pattern_id", T.StringType()),
    T.StructField("day_type", T.StringType()),
    T.StructField("hours", T.ArrayType(T.IntegerType())),
    T.StructField("zone_type_multipliers", T.MapType(T.StringType(), FACTORS)),
])

TIME_PATTERNS_CONFIG = T.StructType([
    T.StructField("time_patterns", T.ArrayType(TIME_PATTERN)),
    T.StructField("default", FACTORS),
])

ZONE_TYPE = T.StructType([
    T.StructField("zone_type_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("base_demand", T.IntegerType()),
    T.StructField("base_supply", T.IntegerType()),
    T.StructField("price_sensitivity", T.DoubleType()),
    T.StructField("avg_distance", T.IntegerType()),
    T.StructField("probability", T.DoubleType()),
])

ZONES_CONFIG = T.StructType([
    T.StructField("h3_resolution", T.IntegerType()),
    T.StructField("random_seed", T.IntegerType()),
    T.StructField("area", T.StructType([
        T.StructField("center_lat", T.DoubleType()),
        T.StructField("center_lon", T.DoubleType()),
        T.StructField("radius_km", T.DoubleType()),
    ])),
    T.StructField("zone_types", T.ArrayType(ZONE_TYPE)),
])
