"""Marketplace events: event time, indicators, recent points and counts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions import display
from zoneflow.functions.pricing import demand_increment, supply_increment
from zoneflow.functions.time import parse_time
from zoneflow.params import PricingParams
from zoneflow.session import materialize


def union_topics(requests: DataFrame, updates: DataFrame, params: PricingParams = PricingParams()) -> DataFrame:
    """Both event tables as one, tagged by topic; a column only one side has is NULL on the other."""
    return requests.withColumn("topic", F.lit(params.ride_topic)).unionByName(
        updates.withColumn("topic", F.lit(params.driver_topic)), allowMissingColumns=True
    )


def with_event_time(df: DataFrame, on_bad: str = "now", now: Column | None = None) -> DataFrame:
    """Add ``event_time`` parsed from the ``timestamp`` text.

    ``on_bad="now"`` replaces an unreadable time by ``now`` (the batch's processing time unless
    given). A replay of old data must use ``"drop"``: one such row would lift the watermark to the
    wall clock and make all that follows late.
    """
    if on_bad not in ("now", "drop"):
        raise ValueError("on_bad is 'now' or 'drop'")
    event_time = parse_time(F.col("timestamp"))
    if on_bad == "now":
        event_time = F.coalesce(event_time, F.current_timestamp() if now is None else now)
    df = df.withColumn("event_time", event_time)
    return df.where("event_time IS NOT NULL") if on_bad == "drop" else df


def with_indicators(events: DataFrame, params: PricingParams = PricingParams()) -> DataFrame:
    """Add the two 0/1 columns that windows sum up."""
    return events.withColumns({
        "demand_increment": demand_increment(F.col("topic"), params),
        "available_driver_increment": supply_increment(F.col("topic"), F.col("status"), params),
    })


def recent_events(events: DataFrame, now: datetime | Column, seconds: int = 60) -> DataFrame:
    """Events not older than ``seconds`` before ``now``; later ones stay.

    An event without event time counts by its ``received_at``, where there is such a column. The two
    cases are separate comparisons, so that with a literal ``now`` both reach the file scan.
    """
    cutoff = (now if isinstance(now, Column) else F.lit(now)) - F.make_interval(secs=F.lit(seconds))
    recent = F.col("event_time") >= cutoff
    if "received_at" in events.columns:
        recent = recent | (F.col("event_time").isNull() & (F.col("received_at") >= cutoff))
    return events.where(recent)


def event_points(events: DataFrame, topic: str, params: PricingParams = PricingParams()) -> DataFrame:
    """Located events of one topic, ready to draw: drivers by their status, requests all alike."""
    status = F.coalesce(F.col("status"), F.lit("request"))
    color = display.driver_color(status) if topic == params.driver_topic else display.rgba(*display.REQUEST)
    return events.where((F.col("topic") == topic) & F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        "lat", "lon", "h3_zone", status.alias("status"), color.alias("color")
    )


def event_counts(events: DataFrame, params: PricingParams = PricingParams()) -> DataFrame:
    """Number of ride requests and driver updates, located or not."""
    return events.agg(*_topic_counts(params))


def tick_totals(events: DataFrame, params: PricingParams = PricingParams()) -> DataFrame:
    """Requests and driver updates per tick (``event_time``)."""
    return events.groupBy("event_time").agg(*_topic_counts(params))


def _topic_counts(params: PricingParams) -> list[Column]:
    return [
        F.count_if(F.col("topic") == params.ride_topic).alias("request_count"),
        F.count_if(F.col("topic") == params.driver_topic).alias("driver_count"),
    ]


def tail(df: DataFrame, n: int = 5000, keys: tuple[str, ...] = ("topic", "partition"),
         offset: str = "offset") -> DataFrame:
    """The last ``n`` offsets of every topic partition.

    This is offset arithmetic as a message consumer does it, not a row count: a partition with gaps
    yields fewer rows. One narrow pass finds the last offsets; the second pass compares against
    them, and against the lowest bound of all partitions, which a file scan can skip row groups by.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    ends = materialize(df.groupBy(*keys).agg((F.max(offset) - n).alias("_before")), "tail")
    lowest = ends.agg(F.min("_before")).first()[0]
    if lowest is None:
        return df.limit(0)
    return (
        df.where(F.col(offset) > lowest)
        .join(ends, list(keys))
        .where(F.col(offset) > F.col("_before"))
        .select(*df.columns)
    )
