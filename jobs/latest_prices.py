"""Keep the latest price per zone as a table, from the pricing topic, until stopped.

    spark-submit --packages … jobs/latest_prices.py --out FOLDER --checkpoint FOLDER [--start earliest|tail|latest] [--buckets N]

The table has one row per zone after every batch, in hash buckets of which a batch rewrites those it touches; ``--buckets`` is
fixed by the first start. The first start reads what the topic holds already, so that zones whose
price does not change are there too; ``--start tail`` begins with the last messages of each partition.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zoneflow.params import PricingParams  # noqa: E402
from zoneflow.session import build_session  # noqa: E402
from zoneflow.sources.buckets import BucketTable  # noqa: E402
from zoneflow.sources.messages import decode_pricing  # noqa: E402
from zoneflow.sources.streams import (  # noqa: E402
    BOOTSTRAP_SERVERS, latest_sink, read_price_stream, starting_offsets, topic_bounds,
)
from zoneflow.streaming.pricing import run_until_stopped  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--out", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--max-per-trigger", type=int)
    parser.add_argument("--buckets", type=int, default=64)
    parser.add_argument("--start", choices=("earliest", "tail", "latest"), default="earliest")
    args = parser.parse_args(argv)
    servers = os.environ.get("KAFKA_BOOTSTRAP_SERVERS", BOOTSTRAP_SERVERS)
    spark, params = build_session("latest-prices"), PricingParams.from_env()
    start = starting_offsets(args.start, lambda: topic_bounds(spark, [params.pricing_topic], servers))
    prices = read_price_stream(spark, params, servers, starting_offsets=start, max_per_trigger=args.max_per_trigger)
    run_until_stopped(latest_sink(decode_pricing(prices), BucketTable(args.out, "h3_zone", args.buckets), args.checkpoint))


if __name__ == "__main__":
    main()
