"""Registered queries: each takes (spark, folder of tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.defaults import ZONES, time_patterns
from zoneflow.functions.pricing import multiplier, pressure
from zoneflow.operators import board, events, pricing, time_patterns as patterns, upsert, zones
from zoneflow.params import DRIVER_UPDATES_TOPIC, RIDE_REQUESTS_TOPIC
from zoneflow.plans.tables import (
    DAILY, HOURLY, MOVED, TUMBLING, add_late_file, as_feed, cells, feed, latest_time, message_feed, ntz, ordered_files, pattern_documents,
    raw_messages, read, replayed, run_log, segment_types, shipped_patterns, shipped_zones, state_store,
    update_log, zone_documents,
)
from zoneflow.session import materialize, new_folder
from zoneflow.sources import messages
from zoneflow.sources.buckets import BucketTable
from zoneflow.sources.cell_index import read_cells_within, write_cells
from zoneflow.sources.config import load_time_patterns, load_zone_config
from zoneflow.sources.message_log import append_messages, read_message_log
from zoneflow.sources.price_log import Folding, log_counts, read_folded
from zoneflow.sources.streams import count_sink, latest_sink, read_log, read_log_stream, table_sink
from zoneflow.sources.zones import RATE_FIELDS, field_gaps, read_map_zones, read_zones, write_snapshot
from zoneflow.streaming.pricing import closed_pricing_stream, pricing_stream, run_to_end, run_until_idle
from zoneflow.streaming.state import open_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEEDED = datetime(2024, 1, 1)
RESEEDED = datetime(2024, 2, 1)
RECENT_SECONDS = 3 * 86_400


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# Prices per zone and window


@query
def zone_window_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.zone_window_pricing(feed(spark, sf_dir), DAILY)


@query
def zone_window_pricing_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without panes: events are spread over their windows, as in a stream."""
    return pricing.zone_window_pricing(feed(spark, sf_dir), DAILY, panes=False)


@query
def zone_hourly_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 windows per event."""
    return pricing.zone_window_pricing(feed(spark, sf_dir), HOURLY)


@query
def zone_tumbling_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.zone_window_pricing(feed(spark, sf_dir), TUMBLING)


@query
def latest_zone_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.latest_pricing(zone_window_pricing(spark, sf_dir))


@query
def latest_closed_zone_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing.latest_pricing(zone_window_pricing(spark, sf_dir), latest_time(feed(spark, sf_dir)))


@query
def pricing_update_log_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a stream that folds it every third batch, closed windows put away, and what came after the last fold."""
    prices = pricing_stream(replayed(spark, sf_dir, ordered_files(spark, sf_dir)), DAILY)
    out, _ = run_log(spark, prices, folding=Folding.of(DAILY, every=3, fanout=2))
    return ntz(read_folded(spark, out), "window_start", "window_end").drop("calculated_at")


@query
def latest_of_update_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, update_log(spark, sf_dir))
    return ntz(pricing.latest_pricing(log), "window_start", "window_end").drop("calculated_at")


@query
def pricing_message_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = messages.encode_pricing(zone_window_pricing(spark, sf_dir), F.lit(RESEEDED))
    return ntz(messages.decode_pricing(sent), "window_start", "window_end", "calculated_at")


# Events


@query
def events_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = messages.decode_events(raw_messages(spark, sf_dir))
    timed = events.with_event_time(decoded, now=F.lit(RESEEDED).cast("timestamp"))
    return ntz(timed, "event_time").drop("timestamp")


@query
def events_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages with unreadable times dropped."""
    decoded = messages.decode_events(raw_messages(spark, sf_dir))
    return ntz(events.with_event_time(decoded, "drop"), "event_time").drop("timestamp")


@query
def event_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.with_indicators(feed(spark, sf_dir)).drop("lat", "lon")


@query
def union_topic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "events")
    requests = as_feed(table.where(F.col("event_type").isin("click", "view")))
    updates = as_feed(table.where(~F.col("event_type").isin("click", "view")))
    return events.union_topics(requests.drop("topic", "status"), updates.drop("topic"))


def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = feed(spark, sf_dir)
    return events.recent_events(table, latest_time(table), RECENT_SECONDS)


@query
def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent(spark, sf_dir)


@query
def recent_received_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose time could not be read count by when they were received."""
    table = feed(spark, sf_dir)
    now = latest_time(table)
    unread = F.col("props").isin('{"k": 3}', '{"k": 7}')
    received = as_feed(read(spark, sf_dir, "events"), "props").withColumns({
        "received_at": F.col("event_time") + F.expr("INTERVAL 1 HOUR"), "event_time": F.when(~unread, F.col("event_time"))})
    return events.recent_events(received, now, RECENT_SECONDS).drop("props")


@query
def request_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.event_points(recent(spark, sf_dir), RIDE_REQUESTS_TOPIC)


@query
def driver_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.event_points(recent(spark, sf_dir), DRIVER_UPDATES_TOPIC)


@query
def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.event_counts(recent(spark, sf_dir))


@query
def tick_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.tick_totals(feed(spark, sf_dir).withColumn("event_time", _hour()))


@query
def tail_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 5,000 offsets of each of four partitions per topic."""
    log = as_feed(read(spark, sf_dir, "events"), "user_id").select(
        "topic", (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        "h3_zone", "status",
    )
    return events.tail(log)


# Time-of-day factors


@query
def events_with_time_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = feed(spark, sf_dir).select("event_id", "event_time", "h3_zone").join(
        segment_types(spark, sf_dir), "h3_zone", "left")
    return patterns.enrich_with_time_factors(typed, time_patterns(spark))


@query
def events_with_loaded_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the shipped patterns written as a config file and loaded from it."""
    typed = feed(spark, sf_dir).select("event_id", "event_time", "h3_zone").join(
        segment_types(spark, sf_dir), "h3_zone", "left")
    return patterns.enrich_with_time_factors(typed, load_time_patterns(spark, shipped_patterns(spark)))


@query
def expected_zone_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected rates of every zone in every hour it was active in."""
    active = feed(spark, sf_dir).select("h3_zone", _hour().alias("event_time")).distinct()
    typed = zones.assign_zone_types(cells(spark, sf_dir).select("h3_zone"), ZONES.zone_types, ZONES.random_seed)
    ticks = active.join(typed, "h3_zone")
    return patterns.expected_rates(patterns.enrich_with_time_factors(ticks, time_patterns(spark)))


@query
def expected_zone_multiplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    demand, supply = F.col("expected_requests"), F.col("expected_available")
    return expected_zone_rates(spark, sf_dir).select(
        "h3_zone", "event_time", demand, supply,
        pressure(demand, supply).alias("pressure"), multiplier(demand, supply, DAILY).alias("price_multiplier"),
    )


@query
def pattern_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.pattern_violations(pattern_documents(spark, sf_dir), "config", "document")


# Zones


@query
def zones_within_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.within_radius(cells(spark, sf_dir), ZONES.area).orderBy("h3_zone")


@query
def indexed_zones_within_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over cells stored in curve order, with their keys."""
    index = new_folder(spark, "cell-index")
    write_cells(cells(spark, sf_dir), index)
    return read_cells_within(spark, index, ZONES.area)


@query
def configured_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone types of all cells in reach, by the shipped configuration written as a file and loaded from it."""
    config = load_zone_config(spark, shipped_zones(spark))
    inside = zones.within_radius(cells(spark, sf_dir), config.area)
    return zones.assign_zone_types(inside.select("h3_zone"), config.zone_types, config.random_seed)


@query
def zone_config_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration per customer: its sum of probabilities, and whether it is refused."""
    return zones.probability_sums(zone_documents(spark, sf_dir), "config", "document")


@query
def zone_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(zones.build_zones(cells(spark, sf_dir), ZONES, F.lit(SEEDED)), "created_at", "updated_at")


def seeded_twice(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The dimension as built first, and a second build around a moved centre."""
    first = zones.build_zones(cells(spark, sf_dir), ZONES, F.lit(SEEDED))
    second = zones.build_zones(cells(spark, sf_dir), MOVED, F.lit(RESEEDED))
    return first, second


@query
def zone_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(upsert.upsert(*seeded_twice(spark, sf_dir), "h3_zone"), "created_at", "updated_at")


@query
def zone_upsert_keeping_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = upsert.upsert(*seeded_twice(spark, sf_dir), "h3_zone", keep=("created_at",))
    return ntz(merged, "created_at", "updated_at")


@query
def zone_upsert_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = seeded_twice(spark, sf_dir)
    timeless = [name for name in first.columns if name not in ("zone_id", "created_at", "updated_at")]
    return upsert.upsert_stats(first.select(timeless), second.select(timeless), "h3_zone")


def bucketed_zones(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> tuple[BucketTable, dict[str, int]]:
    """The dimension as a bucketed table, seeded and seeded again; what the second upsert did."""
    table = BucketTable(new_folder(spark, "zone-table"), "h3_zone", 8)
    first, second = seeded_twice(spark, sf_dir)
    table.upsert(first)
    return table, table.upsert(second, keep)


@query
def zone_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(bucketed_zones(spark, sf_dir)[0].read(spark), "created_at", "updated_at")


@query
def zone_table_upsert_keeping_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(bucketed_zones(spark, sf_dir, ("created_at",))[0].read(spark), "created_at", "updated_at")


@query
def zone_table_upsert_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second upsert counted while it wrote; every zone that both builds have gets a new time."""
    changes = bucketed_zones(spark, sf_dir)[1]
    names = ("matched", "modified", "upserted", "total")
    return spark.range(0, 1, 1, 1).select(*[F.lit(changes[name]).cast("long").alias(name) for name in names])


@query
def duplicate_zone_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.duplicates(feed(spark, sf_dir), "h3_zone")


@query
def zone_field_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = segment_types(spark, sf_dir).withColumn("type", F.nullif("type", F.lit("industrial")))
    return field_gaps(known.join(cells(spark, sf_dir), "h3_zone"), ("h3_zone", "type", "center_lat", "avg_distance"))


def snapshots(spark: SparkSession, sf_dir: str) -> str:
    """A folder with two versions of the dimension, of which readers see the second."""
    root = new_folder(spark, "zones")
    for built in seeded_twice(spark, sf_dir):
        write_snapshot(built, root)
    return root


@query
def zones_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_zones(spark, snapshots(spark, sf_dir)).select(*RATE_FIELDS)


@query
def map_zones_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_map_zones(spark, snapshots(spark, sf_dir))


# Zone board


def board_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.within_radius(cells(spark, sf_dir), ZONES.area).select("h3_zone", "center_lat", "center_lon")


def board_by(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    """Metric colours read the latest prices twice, so those are written once: one row per zone."""
    latest = materialize(latest_zone_pricing(spark, sf_dir), "latest")
    return board.zone_board(board_zones(spark, sf_dir), latest, metric)


@query
def zone_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board.zone_board(board_zones(spark, sf_dir), latest_zone_pricing(spark, sf_dir))


@query
def zone_board_by_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board_by(spark, sf_dir, "Demand count")


@query
def zone_board_by_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board_by(spark, sf_dir, "Supply count")


@query
def zone_board_by_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board_by(spark, sf_dir, "Pressure")


@query
def board_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board.board_maxima(latest_zone_pricing(spark, sf_dir))


@query
def board_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = board.board_kpis(zone_board(spark, sf_dir))
    return kpis.withColumns({
        name: F.round(name, 9) for name in ("average_multiplier", "center_lat", "center_lon")
    })


# Streams: ordered files in, one per trigger; update log out, folded at the end


@query
def stream_zone_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_log(spark, update_log(spark, sf_dir))
    return ntz(pricing.compact_updates(log), "window_start", "window_end").drop("calculated_at")


@query
def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: each window once, after the watermark has passed its end."""
    closed = read_log(spark, update_log(spark, sf_dir, "append"))
    return ntz(closed, "window_start", "window_end").drop("calculated_at")


@query
def stream_closed_windows_by_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 windows per event, state by pane and block; windows of blocks that have closed."""
    prices = closed_pricing_stream(replayed(spark, sf_dir, ordered_files(spark, sf_dir)), HOURLY)
    out, _ = run_log(spark, prices, "append", Folding.of(HOURLY, every=4))
    return ntz(read_log(spark, out), "window_start", "window_end").drop("calculated_at")


@query
def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that the stream still holds when it stops, read from its state."""
    prices = pricing_stream(replayed(spark, sf_dir, ordered_files(spark, sf_dir)), DAILY)
    _, checkpoint = run_log(spark, prices)
    with state_store(spark):
        return ntz(materialize(open_windows(spark, checkpoint, DAILY), "open-windows"), "window_start", "window_end")


@query
def stream_closed_window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that an append stream has written, as its commits count them."""
    prices = pricing_stream(replayed(spark, sf_dir, ordered_files(spark, sf_dir)), DAILY)
    out, _ = run_log(spark, prices, "append", Folding.of(DAILY, every=4))
    return log_counts(spark, out).select("rows_written")


@query
def stream_latest_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second stream over the first one's update log, kept as a bucketed table with one row per zone."""
    log = read_log_stream(spark, update_log(spark, sf_dir))
    latest = BucketTable(new_folder(spark, "latest"), "h3_zone", 8)
    run_to_end(latest_sink(log, latest, new_folder(spark, "latest-checkpoint")))
    return ntz(latest.read(spark), "window_start", "window_end").drop("calculated_at")


@query
def stream_records_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read by topic, across a restart: the late file arrives after the first run has ended."""
    folder, checkpoint = ordered_files(spark, sf_dir, with_late=False), new_folder(spark, "counts-checkpoint")
    counts = BucketTable(new_folder(spark, "counts"), "topic", 1)
    for arrive in (lambda: None, lambda: add_late_file(spark, sf_dir, folder)):
        arrive()
        with state_store(spark):
            run_to_end(count_sink(replayed(spark, sf_dir, folder), counts, checkpoint))
    return counts.read(spark)


@query
def stream_tail_after_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message log read from its last 500 offsets per partition on, in batches; half of all messages arrive after the first run
    has ended, and the second goes on from the checkpoint."""
    log, progress = new_folder(spark, "messages"), new_folder(spark, "messages-progress")
    out, checkpoint = new_folder(spark, "polled"), new_folder(spark, "polled-checkpoint")
    held = message_feed(spark, sf_dir)
    last = held.agg(F.max("offset")).first()[0] or 0
    for half in (F.col("offset") <= last // 2, F.col("offset") > last // 2):
        append_messages(held.where(half), log)
        stream = read_message_log(spark, log, "tail", 500, max_per_trigger=max(1, last), progress=progress)
        run_until_idle(table_sink(stream, out, checkpoint, "append"))
    return read_log(spark, out).select("topic", "partition", "offset", "key", "value")


def _hour():
    return F.date_trunc("hour", F.col("event_time")).cast("timestamp_ntz")
