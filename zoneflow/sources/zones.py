"""Reading and writing the zone dimension."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow import schemas
from zoneflow.operators.upsert import assert_unique
from zoneflow.sources.folders import numbered, remove

# Fields each reader needs.
RATE_FIELDS = ("zone_id", "h3_zone", "type", "base_demand", "base_supply", "avg_distance",
               "price_sensitivity", "center_lat", "center_lon")
MAP_FIELDS = ("zone_id", "h3_zone", "type", "center_lat", "center_lon")


def field_gaps(zones: DataFrame, required: tuple[str, ...] = RATE_FIELDS) -> DataFrame:
    """One row: number of zones, and per required field the number of zones that lack it."""
    absent = [name for name in required if name not in zones.columns]
    present = zones.select(*[name for name in required if name not in absent])
    return present.agg(
        F.count("*").alias("zones"),
        *[(F.count("*") if name in absent else F.count_if(F.col(name).isNull())).alias(name) for name in required],
    )


def read_zones(spark: SparkSession, path: str, required: tuple[str, ...] = RATE_FIELDS,
               fmt: str = "parquet") -> DataFrame:
    """Required fields of all zones in cell order; an empty table, a missing field or a repeated cell is an error.

    ``path`` is a table or a folder of snapshots, of which the newest is read.
    """
    zones = _newest(spark, path, fmt)
    if zones is None:
        raise RuntimeError(f"no zones in {path}: build the zone dimension first")
    gaps = field_gaps(zones, required).first()
    if gaps["zones"] == 0:
        raise RuntimeError(f"no zones in {path}: build the zone dimension first")
    missing = sorted(name for name in required if gaps[name])
    if missing:
        raise ValueError(f"zones in {path} lack required fields: {missing}")
    assert_unique(zones, "h3_zone")
    return zones.select(*required).orderBy("h3_zone")


def read_map_zones(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Fields for the map in cell order, of a table or of the newest snapshot; no rows when there is none."""
    zones = _newest(spark, path, fmt)
    if zones is None:
        zones = spark.createDataFrame([], schemas.ZONE)
    assert_unique(zones, "h3_zone")
    return zones.select(*MAP_FIELDS).orderBy("h3_zone")


def read_snapshot(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """The newest committed version of the dimension and its number; (no rows, 0) before the first one."""
    versions = numbered(spark, root, "version")
    if not versions:
        return spark.createDataFrame([], schemas.ZONE), 0
    newest = max(versions)
    return spark.read.parquet(versions[newest]), newest


def write_snapshot(zones: DataFrame, root: str, keep_versions: int = 5) -> str:
    """Write the whole dimension next to older versions, so that a job may read the one it replaces.

    It takes the next number that no write has touched, a crashed one included, and counts for readers once it is
    complete. Then all but the ``keep_versions`` newest complete versions go, and what crashed writes have left.
    """
    spark, root = zones.sparkSession, root.rstrip("/")
    number = max([0, *numbered(spark, root, "version", committed=False)]) + 1
    path = f"{root}/version={number}"
    zones.write.mode("error").parquet(path)
    complete = numbered(spark, root, "version")
    stay = sorted(complete)[-max(1, keep_versions):]
    for old, folder in numbered(spark, root, "version", committed=False).items():
        if old < number and old not in stay:
            remove(spark, folder)
    return path


def _newest(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    """The newest complete snapshot below ``path``, else ``path`` itself; None when there is neither."""
    if numbered(spark, path, "version", committed=False):
        zones, version = read_snapshot(spark, path)
        return zones if version else None
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
