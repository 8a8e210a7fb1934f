"""Larger trials than bench.py: many copies of the events, a third of them in one zone.

    python bench_scale.py FOLDER [COPIES]

FOLDER is new; it receives the copied tables. Prints seconds and events per second of the window
aggregation (plain and by panes, sparse and dense zones), of the latest price and of a stream.
"""

from __future__ import annotations

import os
import sys
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.operators import pricing
from zoneflow.params import PricingParams
from zoneflow.plans.tables import DAILY, HOURLY, as_feed
from zoneflow.sources.messages import encode_events
from zoneflow.sources.streams import read_file_stream, table_sink
from zoneflow.streaming.pricing import pricing_messages, run_to_end
from zoneflow.streaming.progress import ProgressCounter


def copies(spark: SparkSession, source: str, count: int) -> DataFrame:
    """Every copy has its own zones and times of day; a third of all events moves to zone 7."""
    events = spark.read.parquet(f"{source}/events.parquet")
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).repartition(64)
    return many.withColumn("event_id", F.col("event_id") + F.col("copy") * 1_000_000).withColumns({
        "user_id": F.when(F.xxhash64("event_id") % 3 == 0, 7).otherwise(F.col("user_id") + F.col("copy") * 1500),
        "ts": F.col("ts") + F.make_interval(secs=F.pmod(F.xxhash64("event_id", F.lit(1)), F.lit(86_400))),
    }).select(*events.columns)


def timed(label: str, rows: int, df: DataFrame) -> None:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    print(f"{label:34s}{seconds:7.1f} s {rows / seconds / 1e6:7.2f} M events/s", flush=True)


def stream_trial(spark: SparkSession, events: DataFrame, folder: str) -> None:
    """15 s / 5 s windows over JSON messages of ten minutes, in ten-second files, ten per batch."""
    second = F.pmod(F.xxhash64("event_id", F.lit(2)), F.lit(600))
    iso = F.date_format(F.timestamp_seconds(second + 1_700_000_000), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    slot = F.floor(second / 10).cast("int")
    messages = events.select(slot.alias("slot"), "*").repartition(60, "slot")
    sent = encode_events(messages.withColumns({"timestamp": iso, "event_id": F.col("event_id").cast("string")}), "slot")
    sent.write.partitionBy("slot").json(f"{folder}/in")
    for directory in sorted(os.listdir(f"{folder}/in")):
        if directory.startswith("slot="):
            for name in os.listdir(f"{folder}/in/{directory}"):
                age = 1_700_000_000 + int(directory[5:])
                os.utime(f"{folder}/in/{directory}/{name}", (age, age))
    counter = ProgressCounter.listen(spark)
    start = time.perf_counter()
    raw = read_file_stream(spark, f"{folder}/in/slot=*", max_per_trigger=10)
    query = run_to_end(table_sink(pricing_messages(raw, PricingParams()), f"{folder}/out", f"{folder}/checkpoint"))
    seconds, rows = time.perf_counter() - start, counter.records_read(query)
    state = max(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators)
    print(f"{'stream 15 s / 5 s, JSON':34s}{seconds:7.1f} s {rows / seconds / 1e6:7.2f} M events/s "
          f"{rows} rows, {len(query.recentProgress)} batches, state {state} rows, "
          f"late {counter.late_rows_dropped(query)}", flush=True)


def main() -> None:
    folder, count = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 100
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench-scale")
        .config("spark.sql.shuffle.partitions", "32").config("spark.driver.memory", "20g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    copies(spark, "/root/testdata/sf0.1", count).write.parquet(f"{folder}/events.parquet")
    sparse = spark.read.parquet(f"{folder}/events.parquet")
    rows = sparse.count()
    print(datetime.now().isoformat(timespec="seconds"), rows, "events", flush=True)
    for name, table in (("sparse", sparse), ("dense", sparse.withColumn("user_id", F.col("user_id") % 1500))):
        feed = as_feed(table)
        for label, params, panes in (("3 windows", DAILY, False), ("3 windows, panes", DAILY, True),
                                     ("24 windows, panes", HOURLY, True)):
            timed(f"{name}: {label}", rows, pricing.zone_window_pricing(feed, params, panes))
        timed(f"{name}: latest price", rows, pricing.latest_pricing(pricing.zone_window_pricing(feed, DAILY)))
    timed("dense: 24 windows", rows, pricing.zone_window_pricing(feed, HOURLY, False))
    few = as_feed(spark.read.parquet("/root/testdata/sf0.1/events.parquet")
                  .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(29))))
                  .withColumn("event_id", F.col("event_id") + F.col("copy") * 1_000_000))
    stream_trial(spark, few, folder)
    spark.stop()


if __name__ == "__main__":
    main()
