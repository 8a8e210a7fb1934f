"""Build the zone dimension from candidate cells and merge it into the stored one.

    spark-submit jobs/seed_zones.py --cells CELLS --zones ZONES [--config zones.json] [--keep-created]

CELLS is a parquet table of (h3_zone, center_lat, center_lon); ZONES is a folder of snapshots.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zoneflow import defaults  # noqa: E402
from zoneflow.operators.upsert import assert_unique, change_stats, merge_rows  # noqa: E402
from zoneflow.operators.zones import build_zones  # noqa: E402
from zoneflow.session import build_session, materialize  # noqa: E402
from zoneflow.sources.config import load_zone_config  # noqa: E402
from zoneflow.sources.zones import read_snapshot, write_snapshot  # noqa: E402


def main(argv: list[str] | None = None) -> dict[str, int]:
    parser = argparse.ArgumentParser()
    parser.add_argument("--cells", required=True)
    parser.add_argument("--zones", required=True)
    parser.add_argument("--config", help="JSON file; the shipped area and types without it")
    parser.add_argument("--keep-created", action="store_true", help="known zones keep their created_at")
    parser.add_argument("--keep-versions", type=int, default=5, help="complete snapshots that stay")
    args = parser.parse_args(argv)
    spark = build_session("seed-zones")
    config = load_zone_config(spark, args.config) if args.config else defaults.ZONES
    now = datetime.now(timezone.utc)

    cells = spark.read.parquet(args.cells)
    assert_unique(cells, "h3_zone")
    built = build_zones(cells, config, now)
    stored, _ = read_snapshot(spark, args.zones)
    merged = merge_rows(stored, built, "h3_zone", keep=("created_at",) if args.keep_created else ())
    merged = materialize(merged, "merged")  # rows and figures from one pass
    stats = change_stats(merged).first().asDict()
    write_snapshot(merged.drop("change"), args.zones, args.keep_versions)
    print("Seeded zones:", *(f"{name}={count}" for name, count in stats.items()))
    return stats


if __name__ == "__main__":
    main()
