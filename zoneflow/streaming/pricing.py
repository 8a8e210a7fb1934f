"""Streams built from the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from zoneflow.operators.events import with_event_time, with_indicators
from zoneflow.operators.pricing import COUNTS, INCREMENTS, latest_pricing, price_windows, zone_window_pricing
from zoneflow.params import PricingParams
from zoneflow.sources.messages import decode_events, decode_pricing, encode_pricing


def pricing_stream(events: DataFrame, params: PricingParams = PricingParams()) -> DataFrame:
    """Priced zone windows of a stream of decoded events with an ``event_time``.

    State holds the windows that end after the watermark; an event is dropped, window by window,
    once it is later than that. In update mode every trigger emits the windows it changed.
    """
    return zone_window_pricing(events.withWatermark("event_time", params.watermark), params).withColumn(
        "calculated_at", F.current_timestamp()
    )


def closed_pricing_stream(events: DataFrame, params: PricingParams = PricingParams(), block_slides: int = 6) -> DataFrame:
    """Priced zone windows of a stream of events, each once after it has closed, for append mode; with little state.

    Three steps. Events are summed into tumbling panes; a pane is handed on once the watermark has passed its end. Closed panes
    are summed in blocks of time, each of which holds all panes of the ``block_slides`` windows that start in it, with sums for
    each of them. A closed block is spread over its windows without any state. So an event is kept as part of one pane's row and then of a few blocks'
    rows, where ``pricing_stream`` keeps a row for every window it lies in (window / slide of them).

    Two things differ from ``pricing_stream`` in append mode. A late event counts for all its windows or none: it is dropped once
    its pane has closed. And windows of a block come out together, up to ``block_slides - 1`` slides after the first of them
    has closed. Zones are spread by hash, and a block's row has a fixed size, however many events a zone has.
    """
    if block_slides < 1:
        raise ValueError("block_slides must be at least one")
    window, slide = params.window_seconds, params.slide_seconds
    block = block_slides * slide
    # both counts travel as one number, demand above supply, which halves the rows kept; as they come out as ints, 32 bits hold each
    marked = with_indicators(events.withWatermark("event_time", params.watermark), params)
    both = F.shiftleft(F.col(INCREMENTS[0]).cast("long"), 32) + F.col(INCREMENTS[1])
    panes = marked.groupBy(F.window("event_time", f"{params.pane_seconds} seconds"), "h3_zone").agg(F.sum(both).alias("events"))
    placed = panes.select(
        F.window(F.window_time("window"), f"{window - slide + block} seconds", f"{block} seconds").alias("block"), "h3_zone",
        F.unix_seconds("window.start").alias("at"), "events",
    ).withColumn("at", F.col("at") - F.unix_seconds("block.start"))
    # one flat sum per window, null without panes: no lists to merge with those in the state
    sums = [F.sum(F.when(F.col("at").between(i * slide, i * slide + window - 1), F.col("events"))).alias(f"events{i}")
            for i in range(block_slides)]
    blocks = placed.groupBy("block", "h3_zone").agg(*sums)
    # numbers are spread and sums picked by them: an array of structs would make an object of every window and field
    numbers = F.explode(F.array(*[F.lit(i) for i in range(block_slides)])).alias("i")
    picked = F.expr("CASE i " + " ".join(f"WHEN {i} THEN events{i}" for i in range(block_slides)) + " END")
    spread = blocks.select("*", F.unix_seconds("block.start").alias("first"), numbers).select(
        "h3_zone", (F.col("first") + F.col("i") * slide).alias("start"), picked.alias("events")).where("events IS NOT NULL")
    counts = spread.select(
        F.struct(F.timestamp_seconds("start").alias("start"), F.timestamp_seconds(F.col("start") + window).alias("end")).alias("window"),
        "h3_zone", F.shiftright("events", 32).cast("int").alias(COUNTS[0]),
        F.col("events").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias(COUNTS[1]))
    return price_windows(counts, params).withColumn("calculated_at", F.current_timestamp())


def pricing_messages(raw: DataFrame, params: PricingParams = PricingParams(), on_bad: str = "now") -> DataFrame:
    """Event messages in, price messages out."""
    events = with_event_time(decode_events(raw, ("timestamp", "h3_zone", "status")), on_bad)
    return encode_pricing(pricing_stream(events, params), F.col("calculated_at"))


def latest_pricing_stream(price_messages: DataFrame) -> DataFrame:
    """The latest price per zone as a second stream, over the topic the first one writes."""
    return latest_pricing(decode_pricing(price_messages))


def run_to_end(writer: DataStreamWriter) -> StreamingQuery:
    """Process what the source holds now, in as many batches as its options ask for, and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_until_idle(writer: DataStreamWriter) -> StreamingQuery:
    """Process what the source holds now and stop, for sources that limit their batches themselves."""
    query = writer.start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def run_until_stopped(writer: DataStreamWriter) -> None:
    """Process new data as it arrives until the query is stopped or fails."""
    writer.start().awaitTermination()
