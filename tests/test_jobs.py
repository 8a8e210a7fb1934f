"""The batch entry points end to end; the streaming ones need a broker and are only imported."""

from __future__ import annotations

import json
from dataclasses import asdict

from conftest import SF_DIR
from jobs import latest_prices, price_stream, seed_zones, zone_board
from zoneflow.defaults import ZONES
from zoneflow.plans.queries import zone_window_pricing
from zoneflow.plans.tables import cells
from zoneflow.sources.zones import read_snapshot


def test_seed_then_board(spark, tmp_path):
    cells(spark, SF_DIR).write.parquet(str(tmp_path / "cells"))
    args = ["--cells", str(tmp_path / "cells"), "--zones", str(tmp_path / "zones")]
    first = seed_zones.main(args)
    assert first["upserted"] == first["total"] > 0 and first["matched"] == 0

    config = {"h3_resolution": 7, "random_seed": 7, "area": asdict(ZONES.area) | {"radius_km": 5.0},
              "zone_types": [asdict(t) for t in ZONES.zone_types]}
    (tmp_path / "zones.json").write_text(json.dumps(config))
    again = seed_zones.main(args + ["--config", str(tmp_path / "zones.json"), "--keep-created"])
    assert 0 < again["matched"] < first["total"] == again["total"] and again["upserted"] == 0
    zones, version = read_snapshot(spark, str(tmp_path / "zones"))
    assert version == 2 and zones.count() == first["total"]
    assert zones.select("created_at").distinct().count() == 1
    assert zones.select("updated_at").distinct().count() == 2

    zone_window_pricing(spark, SF_DIR).write.parquet(str(tmp_path / "prices" / "query=q" / "batch_id=0"))
    zone_board.main(["--zones", str(tmp_path / "zones"), "--prices", str(tmp_path / "prices"),
                     "--out", str(tmp_path / "out"), "--color-by", "Pressure"])
    board = spark.read.parquet(str(tmp_path / "out" / "board"))
    assert board.count() == first["total"]
    assert spark.read.parquet(str(tmp_path / "out" / "totals")).first().tracked_zones == first["total"]


def test_streaming_jobs_import():
    assert callable(price_stream.main) and callable(latest_prices.main)
