"""Price zones from the two event topics into the pricing topic, until stopped.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 jobs/price_stream.py

Settings come from the environment: PRICING_WINDOW_SECONDS, PRICING_SLIDE_SECONDS,
PRICING_MIN_MULTIPLIER, PRICING_MAX_MULTIPLIER, PRICING_PRESSURE_WEIGHT, PRICING_TOPIC,
RIDE_REQUESTS_TOPIC, DRIVER_UPDATES_TOPIC, KAFKA_BOOTSTRAP_SERVERS and
PRICING_CHECKPOINT_LOCATION (a folder that all executors share and that outlives them). Without it the checkpoint goes
below ``spark.checkpoint.dir``; without either the job refuses to start, as a restart would lose offsets and windows.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from zoneflow.params import PricingParams  # noqa: E402
from zoneflow.session import build_session  # noqa: E402
from zoneflow.sources.streams import BOOTSTRAP_SERVERS, kafka_sink, read_event_stream  # noqa: E402
from zoneflow.streaming.pricing import pricing_messages, run_until_stopped  # noqa: E402


def checkpoint_folder(spark: SparkSession) -> str:
    """The same folder at every start."""
    named = os.environ.get("PRICING_CHECKPOINT_LOCATION")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not shared:
        raise RuntimeError("set PRICING_CHECKPOINT_LOCATION or spark.checkpoint.dir to a lasting folder")
    return named or f"{shared.rstrip('/')}/zone-pricing"


def main() -> None:
    params = PricingParams.from_env()
    servers = os.environ.get("KAFKA_BOOTSTRAP_SERVERS", BOOTSTRAP_SERVERS)
    spark = build_session("zone-pricing")
    checkpoint = checkpoint_folder(spark)
    messages = pricing_messages(read_event_stream(spark, params, servers), params)
    run_until_stopped(kafka_sink(messages, params.pricing_topic, checkpoint, servers))


if __name__ == "__main__":
    main()
