"""Loading the two JSON configuration files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from zoneflow import schemas
from zoneflow.defaults import Area, Factors, TimePatterns, ZonesConfig, ZoneType
from zoneflow.operators.time_patterns import require_valid


def load_zone_config(spark: SparkSession, path: str) -> ZonesConfig:
    """Area, zone types and their probabilities from one JSON document."""
    config = spark.read.schema(schemas.ZONES_CONFIG).option("mode", "FAILFAST").json(path, multiLine=True).first()
    missing = sorted(name for name in schemas.ZONES_CONFIG.fieldNames() if config is None or config[name] is None)
    if missing:
        raise ValueError(f"{path} lacks required keys: {missing}")
    return ZonesConfig(
        h3_resolution=config.h3_resolution,
        random_seed=config.random_seed,
        area=Area(**config.area.asDict()),
        zone_types=tuple(ZoneType(**row.asDict()) for row in config.zone_types),
    )


def load_time_patterns(spark: SparkSession, path: str) -> TimePatterns:
    """Checked time patterns and default factors (1.0 unless given) from one JSON document."""
    text = spark.read.text(path, wholetext=True).select(F.lit(path).alias("path"), "value")
    require_valid(text, "path", "value")
    config = text.select(F.from_json("value", schemas.TIME_PATTERNS_CONFIG).alias("config")).select("config.*")
    default = config.select("default.*").first()
    patterns = config.select(F.posexplode("time_patterns").alias("pattern_index", "pattern"))
    return TimePatterns(
        patterns.select("pattern_index", "pattern.*"),
        Factors() if default.demand_factor is None else Factors(**default.asDict()),
    )
