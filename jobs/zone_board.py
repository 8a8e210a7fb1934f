"""Write the zone board and its totals from stored zones and an update log of prices.

    spark-submit jobs/zone_board.py --zones ZONES --prices LOG --out FOLDER [--color-by "Demand count"]

ZONES is the folder of snapshots that seed_zones writes (the newest complete one is read), LOG a folder of table_sink
or log_sink, or the table that latest_prices keeps.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zoneflow.operators.board import COLOR_MODES, board_kpis, zone_board  # noqa: E402
from zoneflow.operators.pricing import latest_pricing  # noqa: E402
from zoneflow.session import build_session, materialize  # noqa: E402
from zoneflow.sources.buckets import BucketTable  # noqa: E402
from zoneflow.sources.streams import read_log  # noqa: E402
from zoneflow.sources.zones import read_map_zones  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--zones", required=True)
    parser.add_argument("--prices", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--color-by", choices=COLOR_MODES, default=COLOR_MODES[0])
    args = parser.parse_args(argv)
    spark = build_session("zone-board")
    table = BucketTable(args.prices, "h3_zone").read(spark)
    latest = table if table is not None else materialize(latest_pricing(read_log(spark, args.prices)), "latest")
    board = zone_board(read_map_zones(spark, args.zones), latest, args.color_by)
    board.write.mode("overwrite").parquet(f"{args.out}/board")
    totals = board_kpis(spark.read.parquet(f"{args.out}/board"))
    totals.write.mode("overwrite").parquet(f"{args.out}/totals")


if __name__ == "__main__":
    main()
