"""Zone dimension: distance, types, numbering, upsert, readers, config."""

from __future__ import annotations

import json
import math
import random
from dataclasses import asdict, replace
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zoneflow import schemas
from zoneflow.defaults import ZONES, Area
from zoneflow.functions.geo import EARTH_RADIUS_KM, haversine_km, in_box
from zoneflow.operators import upsert as up
from zoneflow.operators import zones
from zoneflow.sources import zones as stored
from zoneflow.sources.config import load_zone_config

NOW = datetime(2026, 4, 24)


def km(lat1, lon1, lat2, lon2):
    """Independent form of the distance: angle between two unit vectors."""
    def vector(lat, lon):
        lat, lon = math.radians(lat), math.radians(lon)
        return math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)
    a, b = vector(lat1, lon1), vector(lat2, lon2)
    cross = (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])
    return EARTH_RADIUS_KM * math.atan2(math.hypot(*cross), sum(x * y for x, y in zip(a, b)))


coordinate = st.tuples(st.floats(-89, 89), st.floats(-180, 180))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=st.lists(st.tuples(coordinate, coordinate), min_size=10, max_size=40))
def test_haversine(spark, pairs):
    df = spark.createDataFrame([(*a, *b) for a, b in pairs], "a double, b double, c double, d double")
    c = F.col
    rows = df.select(*df.columns, haversine_km(c("a"), c("b"), c("c"), c("d")).alias("there"),
                     haversine_km(c("c"), c("d"), c("a"), c("b")).alias("back")).collect()
    for row in rows:
        assert row.there == pytest.approx(km(*row[:4]), abs=1e-3)
        assert row.there == pytest.approx(row.back, abs=1e-6)


@pytest.mark.parametrize("center", [(35.76, -5.83), (0, 179.99), (10, -179.95), (89.99, 20), (-89.9, 0), (60, 0)])
@pytest.mark.parametrize("radius", [1, 8, 60])
def test_box_keeps_every_cell_in_reach(spark, center, radius):
    draw = random.Random(f"{center}{radius}")
    degrees = math.degrees(radius / EARTH_RADIUS_KM)
    points = []
    for _ in range(400):
        lat = max(-90.0, min(90.0, center[0] + draw.uniform(-1.3, 1.3) * degrees))
        spread = min(180, 1.3 * degrees / max(0.001, math.cos(math.radians(lat))))
        lon = (center[1] + draw.uniform(-spread, spread) + 180) % 360 - 180
        points.append((lat, lon))
    df = spark.createDataFrame(points, "center_lat double, center_lon double")
    inside = zones.within_radius(df, Area(*center, radius)).count()
    assert inside == sum(km(*center, *p) <= radius for p in points) > 0
    boxed = df.where(in_box(F.col("center_lat"), F.col("center_lon"), *center, radius)).count()
    assert inside <= boxed < 400


def test_radius_is_inclusive_and_values_are_rounded(spark):
    df = spark.createDataFrame([("a", 0.123456789, 0.0)], "h3_zone string, center_lat double, center_lon double")
    row = zones.within_radius(df, Area(0.0, 0.0, 50)).first()
    assert row.center_lat == 0.1234568
    assert row.distance_from_center_km == round(km(0, 0, 0.123456789, 0), 4)
    exact = df.select(haversine_km(F.lit(0.0), F.lit(0.0), F.col("center_lat"), F.col("center_lon"))).first()[0]
    assert zones.within_radius(df, Area(0.0, 0.0, exact)).count() == 1


def named_cells(spark, n, partitions=7):
    key = F.lpad(F.conv((F.col("id") * 2654435761 % 4294967296).cast("string"), 10, 16), 8, "0")
    return spark.range(0, n, 1, partitions).select(
        key.alias("h3_zone"), F.lit(35.76).alias("center_lat"), F.lit(-5.83).alias("center_lon"))


def test_types_follow_the_probabilities_and_not_the_layout(spark):
    cells = named_cells(spark, 20000)
    typed = zones.assign_zone_types(cells, ZONES.zone_types, 42)
    shares = {r.type: r["count"] / 20000 for r in typed.groupBy("type").count().collect()}
    for zone_type in ZONES.zone_types:
        assert shares[zone_type.type] == pytest.approx(zone_type.probability, abs=0.015)
    again = zones.assign_zone_types(named_cells(spark, 20000, 3).orderBy(F.desc("h3_zone")), ZONES.zone_types, 42)
    assert typed.exceptAll(again).count() == 0
    other = zones.assign_zone_types(cells, ZONES.zone_types, 43)
    assert typed.exceptAll(other).count() > 1000


def test_profile_belongs_to_the_type(spark):
    typed = zones.assign_zone_types(named_cells(spark, 2000), ZONES.zone_types, 1)
    profiles = {tuple(r) for r in typed.drop("h3_zone", "center_lat", "center_lon").distinct().collect()}
    assert profiles == {tuple(asdict(t).values()) for t in ZONES.zone_types}


@pytest.mark.parametrize("n, partitions", [(0, 1), (1, 1), (5000, 7), (12000, 3)])
def test_numbering(spark, n, partitions):
    numbered = zones.number_zones(named_cells(spark, n, partitions)).select("zone_id", "h3_zone").collect()
    assert sorted((r.h3_zone, int(r.zone_id[5:])) for r in numbered) == [
        (key, i) for i, key in enumerate(sorted(r.h3_zone for r in numbered), 1)]
    assert len(numbered) == n
    assert all(len(r.zone_id) == (9 if int(r.zone_id[5:]) < 10000 else 10) for r in numbered)


def test_build_zones(spark):
    built = zones.build_zones(named_cells(spark, 50), ZONES, NOW)
    assert [(f.name, f.dataType) for f in built.schema] == [(f.name, f.dataType) for f in schemas.ZONE]
    assert {(r.created_at, r.updated_at, r.h3_resolution) for r in built.collect()} == {(NOW, NOW, 7)}


def test_probabilities_are_checked():
    types = ZONES.zone_types
    with pytest.raises(ValueError):
        replace(ZONES, zone_types=types[:3])
    with pytest.raises(ValueError):
        zones.assign_zone_types(None, types[:-1] + (replace(types[-1], probability=0.35001),), 1)


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, created string")


def test_upsert(spark):
    target = table(spark, [("a", 1, "old"), ("b", 2, "old"), ("c", None, "old")])
    updates = table(spark, [("b", 3, "new"), ("c", None, "old"), ("d", 4, "new")])
    merged = up.upsert(target, updates, "k")
    assert {tuple(r) for r in merged.collect()} == {
        ("a", 1, "old"), ("b", 3, "new"), ("c", None, "old"), ("d", 4, "new")}
    assert up.upsert(merged, updates, "k").exceptAll(merged).count() == 0
    kept = up.upsert(target, updates, "k", keep=("created",))
    assert {tuple(r) for r in kept.collect()} == {
        ("a", 1, "old"), ("b", 3, "old"), ("c", None, "old"), ("d", 4, "new")}
    stats = up.upsert_stats(target, updates, "k").first()
    assert stats.asDict() == {"matched": 2, "modified": 1, "upserted": 1, "total": 4}
    assert up.upsert_stats(target, updates.limit(0), "k").first().asDict() == {
        "matched": 0, "modified": 0, "upserted": 0, "total": 3}


def test_unique_keys(spark):
    up.assert_unique(table(spark, [("a", 1, ""), ("b", 1, "")]), "k")
    with pytest.raises(ValueError, match="b"):
        up.assert_unique(table(spark, [("a", 1, ""), ("b", 1, ""), ("b", 2, "")]), "k")


def test_readers(spark, tmp_path):
    path = str(tmp_path / "zones")
    assert stored.read_map_zones(spark, path).collect() == []
    assert stored.read_map_zones(spark, path).columns == list(stored.MAP_FIELDS)
    built = zones.build_zones(named_cells(spark, 30), ZONES, NOW)
    built.write.parquet(path)
    read = stored.read_zones(spark, path)
    assert read.columns == list(stored.RATE_FIELDS)
    keys = [r.h3_zone for r in read.collect()]
    assert keys == sorted(keys) and len(keys) == 30
    assert [r.h3_zone for r in stored.read_map_zones(spark, path).collect()] == keys

    built.limit(0).write.parquet(str(tmp_path / "empty"))
    with pytest.raises(RuntimeError):
        stored.read_zones(spark, str(tmp_path / "empty"))
    gap = F.when(F.col("zone_id") != "zone_0003", F.col("type"))
    built.withColumn("type", gap).drop("avg_distance").write.parquet(str(tmp_path / "gaps"))
    with pytest.raises(ValueError, match=r"\['avg_distance', 'type'\]"):
        stored.read_zones(spark, str(tmp_path / "gaps"))


def test_snapshots_let_a_job_read_what_it_replaces(spark, tmp_path):
    root = str(tmp_path / "zones")
    first = stored.write_snapshot(table(spark, [("a", 1, "")]), root)
    merged = up.upsert(spark.read.parquet(first), table(spark, [("b", 2, "")]), "k")
    second = stored.write_snapshot(merged, root)
    assert spark.read.parquet(second).count() == 2
    assert second.endswith("version=2")


def test_readers_see_the_newest_complete_version(spark, tmp_path):
    root = str(tmp_path / "zones")
    assert stored.read_snapshot(spark, root)[1] == 0
    built = zones.build_zones(named_cells(spark, 30), ZONES, NOW)
    crashed = tmp_path / "zones" / "version=1"
    crashed.mkdir(parents=True)
    (crashed / "part-0.parquet").write_bytes(b"unfinished")
    with pytest.raises(RuntimeError):
        stored.read_zones(spark, root)
    assert stored.read_map_zones(spark, root).collect() == []
    stored.write_snapshot(built, root)  # not stopped by the crash, and clears it away
    assert stored.read_snapshot(spark, root)[1] == 2 and not crashed.exists()
    stored.write_snapshot(built.where("h3_zone < 'z'").limit(10), root)
    assert stored.read_zones(spark, root).count() == 10
    assert stored.read_map_zones(spark, root).count() == 10
    for _ in range(3):
        stored.write_snapshot(built, root, keep_versions=2)
    assert sorted(p.name for p in (tmp_path / "zones").iterdir()) == ["version=5", "version=6"]
    assert stored.read_zones(spark, root).count() == 30


def test_repeated_cells_are_an_error(spark, tmp_path):
    built = zones.build_zones(named_cells(spark, 30), ZONES, NOW)
    built.unionByName(built).write.parquet(str(tmp_path / "twice"))
    for reader in (stored.read_zones, stored.read_map_zones):
        with pytest.raises(ValueError, match="30 repeated keys"):
            reader(spark, str(tmp_path / "twice"))


def test_merge_resolves_up_to_the_format(spark):
    """No format with row-level changes is here: the plan resolves and stops at the format."""
    spark.sql("CREATE TABLE zones_t (k STRING, n INT, note STRING) USING parquet")
    try:
        with pytest.raises(Exception) as error:
            up.merge_into(table(spark, [("a", 1, "")]).select("k", F.lit(1).alias("n"), F.lit("").alias("note")), "zones_t", "k")
        assert "MERGE" in str(error.value) and "UNRESOLVED" not in str(error.value)
    finally:
        spark.sql("DROP TABLE zones_t")


def test_upsert_makes_each_side_once(spark):
    left = spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").alias("n"))
    merged = up.merge_rows(left, left.where("n > 50"), "k", keep=("n",))
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert text.count("Range (") == 2 and text.count("FullOuter") == 1


def zone_config():
    return {"h3_resolution": ZONES.h3_resolution, "random_seed": ZONES.random_seed, "area": asdict(ZONES.area),
            "zone_types": [asdict(t) for t in ZONES.zone_types]}


def test_zone_config(spark, tmp_path):
    path = tmp_path / "zones.json"
    path.write_text(json.dumps(zone_config(), indent=2))
    assert load_zone_config(spark, str(path)) == ZONES
    for missing in ("h3_resolution", "random_seed", "area", "zone_types"):
        path = tmp_path / f"{missing}.json"
        path.write_text(json.dumps({k: v for k, v in zone_config().items() if k != missing}))
        with pytest.raises(ValueError, match=missing):
            load_zone_config(spark, str(path))
    path = tmp_path / "sum.json"
    config = zone_config()
    config["zone_types"][0]["probability"] = 0.2
    path.write_text(json.dumps(config))
    with pytest.raises(ValueError, match="add up"):
        load_zone_config(spark, str(path))
