"""Building the zone dimension: radius, zone types, numbering."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zoneflow import schemas
from zoneflow.defaults import PROBABILITY_SLACK, Area, ZonesConfig, ZoneType, check_probabilities
from zoneflow.functions.geo import haversine_km, in_box
from zoneflow.session import materialize


def within_radius(cells: DataFrame, area: Area, lat: str = "center_lat", lon: str = "center_lon") -> DataFrame:
    """Cells whose centre lies within the radius (inclusive), with ``distance_from_center_km``.

    Coordinates are rounded to 7 digits and the distance to 4 after the test. The box comparisons
    come first: they reach the scan, and the trigonometry runs on what is left.
    """
    distance = haversine_km(F.lit(area.center_lat), F.lit(area.center_lon), F.col(lat), F.col(lon))
    return (
        cells.where(in_box(F.col(lat), F.col(lon), area.center_lat, area.center_lon, area.radius_km))
        .withColumn("distance_from_center_km", distance)
        .where(F.col("distance_from_center_km") <= area.radius_km)
        .withColumns({
            lat: F.round(lat, 7),
            lon: F.round(lon, 7),
            "distance_from_center_km": F.round("distance_from_center_km", 4),
        })
    )


def zone_uniform(zone: Column, seed: int) -> Column:
    """Number in [0, 1) that depends on the seed and the cell alone, not on row order or partition."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), zone))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def assign_zone_types(cells: DataFrame, zone_types: tuple[ZoneType, ...], seed: int) -> DataFrame:
    """Give every cell a zone type with the configured probabilities.

    The cell's uniform number is compared with the cumulative probabilities; the last type takes
    whatever rounding leaves over.
    """
    check_probabilities(zone_types)
    u = zone_uniform(F.col("h3_zone"), seed)
    pick, reached = F.lit(0), 0.0
    for zone_type in zone_types[:-1]:
        reached += zone_type.probability
        pick = pick + F.when(u >= reached, 1).otherwise(0)
    profiles = F.array(*[_profile(t) for t in zone_types])
    return cells.withColumn("_profile", F.get(profiles, pick)).select(*cells.columns, "_profile.*")


def probability_sums(documents: DataFrame, name: str, document: str) -> DataFrame:
    """``(name, types, total, valid)`` of JSON zone configurations: their number of zone types, the sum of their probabilities in
    list order, and whether ``load_zone_config`` takes that sum.

    Zone types or probabilities that are missing count as none and zero; a document that is no JSON has none.
    """
    config = F.from_json(F.col(document), "zone_types array<struct<probability double>>")
    share = F.coalesce(F.transform(config["zone_types"]["probability"], lambda p: F.coalesce(p, F.lit(0.0))), F.array().cast("array<double>"))
    return documents.select(F.col(name), share.alias("_shares")).select(
        name, F.size("_shares").alias("types"), F.aggregate("_shares", F.lit(0.0), lambda total, p: total + p).alias("total"),
    ).withColumn("valid", F.abs(F.col("total") - 1) <= PROBABILITY_SLACK)


def _profile(t: ZoneType) -> Column:
    return F.struct(
        F.lit(t.zone_type_id).alias("zone_type_id"), F.lit(t.type).alias("type"),
        F.lit(int(t.base_demand)).alias("base_demand"), F.lit(int(t.base_supply)).alias("base_supply"),
        F.lit(float(t.price_sensitivity)).alias("price_sensitivity"),
        F.lit(int(t.avg_distance)).alias("avg_distance"),
        F.lit(float(t.probability)).alias("selection_probability"),
    )


def number_rows(df: DataFrame, key: str, name: str = "row_number") -> DataFrame:
    """Number rows 1, 2, 3 … in the order of a unique key, in parallel.

    Rows are range-partitioned and sorted by the key, and written once with Spark's own increasing id: its high bits are the
    range, its low 33 bits the place in it. Range counts (one row per partition) give each range its first number. Nothing is
    sorted again or in a single task, and a lost executor cannot shift the ranges under the counts.
    """
    ordered = df.repartitionByRange(key).sortWithinPartitions(key)
    ranged = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumns({
        "_range": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    # one row per range, so both the global window and the broadcast are bounded by the partition count
    starts = ranged.groupBy("_range").agg(F.count("*").alias("_rows")).select(
        "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    return ranged.join(F.broadcast(starts), "_range").select(
        *df.columns, (F.col("_start") + F.col("_place") + 1).alias(name))


def number_zones(cells: DataFrame) -> DataFrame:
    """Add ``zone_id`` ``zone_0001`` … in cell order; ids widen beyond four digits."""
    numbered = number_rows(cells, "h3_zone", "_number")
    return numbered.select(F.format_string("zone_%04d", "_number").alias("zone_id"), *cells.columns)


def build_zones(cells: DataFrame, config: ZonesConfig, now: datetime | Column) -> DataFrame:
    """Candidate cells (``h3_zone``, ``center_lat``, ``center_lon``) to the zone dimension."""
    stamp = (now if isinstance(now, Column) else F.lit(now)).cast("timestamp")
    inside = within_radius(cells.select("h3_zone", "center_lat", "center_lon"), config.area)
    typed = assign_zone_types(inside, config.zone_types, config.random_seed)
    return number_zones(typed).withColumns({
        "created_at": stamp,
        "updated_at": stamp,
        "h3_resolution": F.lit(config.h3_resolution),
    }).select(*schemas.ZONE.fieldNames())
