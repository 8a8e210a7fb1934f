"""Windowed demand and supply per zone, the price that follows, and the latest of them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.pricing import multiplier, pressure
from zoneflow.operators.events import with_indicators
from zoneflow.params import PricingParams

INCREMENTS = ("demand_increment", "available_driver_increment")
COUNTS = ("demand_count", "available_driver_count")
BLOCK_WINDOWS = 8  # windows per block of the pane form: one pane in eight goes to two blocks


def aggregate_zone_windows(events: DataFrame, params: PricingParams = PricingParams(),
                           panes: bool | None = None) -> DataFrame:
    """Demand and available supply per sliding window and zone.

    ``events`` carries ``event_time``, ``h3_zone`` and the two indicators. A zone with only busy
    drivers yields a 0/0 row, a silent zone none. Sums are combined before the shuffle, so a zone
    that holds a third of the events sends one row per window and task.

    Overlapping windows in batch are summed by ``panes`` unless that is turned off: each event goes
    into the one tumbling pane it lies in, and panes instead of events are spread over the windows.
    A stream spreads events, as its state has to be keyed by window.
    """
    if panes is None:
        panes = not events.isStreaming and _has_panes(events, params)
    if panes:
        return _windows_of_panes(events, params)
    return events.groupBy(F.window("event_time", params.window, params.slide), "h3_zone").agg(*_count(*INCREMENTS))


def _windows_of_panes(events: DataFrame, params: PricingParams) -> DataFrame:
    """Sliding windows from pane sums.

    A pane adds to all windows from the first to the last that hold it, so it is two changes of running sums: one at the first
    window's start and one back after the last one's. Sums stay the same between two changes, and only what is finished is spread
    over the windows in between; so a task sorts two rows per pane, however many windows a pane lies in. Panes are shuffled by
    zone and block of time (those that lie across a border go to both blocks): blocks cut a hot zone into even pieces.
    """
    demand, supply = INCREMENTS
    kind = events.schema["event_time"].dataType
    window, slide = params.window_seconds, params.slide_seconds
    length = BLOCK_WINDOWS * window // slide * slide  # a block holds whole slides

    def floor(seconds: Column, step: int) -> Column:
        return seconds - F.pmod(seconds, F.lit(step))

    def block(seconds: Column) -> Column:
        return floor(seconds, length)

    pane = F.window("event_time", f"{params.pane_seconds} seconds").alias("pane")
    sums = events.groupBy(pane, "h3_zone").agg(F.sum(demand).alias(demand), F.sum(supply).alias(supply))
    # whole seconds from here on: cheaper than adding intervals to timestamps
    covered = sums.withColumn("at", F.unix_timestamp("pane.start")).select(
        "h3_zone", demand, supply,
        floor(F.col("at") - window + slide, slide).alias("first"), floor(F.col("at"), slide).alias("last"),
    )
    blocks = F.array_distinct(F.array(block(F.col("first")), block(F.col("last"))))
    placed = covered.withColumn("block", F.explode(blocks)).repartition("block", "h3_zone")
    begin = F.greatest("first", "block").alias("start")
    end = F.least(F.col("last") + slide, F.col("block") + length).alias("start")
    changes = placed.withColumn("change", F.explode(F.array(
        F.struct(begin, F.col(demand), F.col(supply), F.lit(1).alias("panes")),
        F.struct(end, (-F.col(demand)).alias(demand), (-F.col(supply)).alias(supply), F.lit(-1).alias("panes")),
    ))).select("block", "h3_zone", "change.*")
    ordered = W.partitionBy("block", "h3_zone").orderBy("start")
    so_far = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    # of changes at one start the last one has the sum of all; the others reach no window
    steps = changes.select(
        "h3_zone", "start", F.lead("start").over(ordered).alias("next"),
        *[F.sum(name).over(so_far).alias(name) for name in (demand, supply, "panes")],
    ).where((F.col("panes") > 0) & (F.col("next") > F.col("start")))
    starts = F.sequence("start", F.col("next") - slide, F.lit(slide).cast("long"))
    counts = steps.select("h3_zone", F.explode(starts).alias("start"), *[
        F.col(name).cast("int").alias(count) for name, count in zip(INCREMENTS, COUNTS, strict=True)])
    bounds = F.struct(F.timestamp_seconds("start").cast(kind).alias("start"),
                      F.timestamp_seconds(F.col("start") + window).cast(kind).alias("end"))
    return counts.select(bounds.alias("window"), "h3_zone", *COUNTS)


def _has_panes(events: DataFrame, params: PricingParams) -> bool:
    """Whether windows overlap and event times have exact seconds: wall-clock times do only in UTC."""
    kind = events.schema["event_time"].dataType
    in_utc = events.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z")
    return params.slide_seconds < params.window_seconds and (in_utc or isinstance(kind, T.TimestampType))


def _count(demand: str, supply: str) -> list[Column]:
    return [F.sum(demand).cast("int").alias(COUNTS[0]), F.sum(supply).cast("int").alias(COUNTS[1])]


def price_windows(windows: DataFrame, params: PricingParams = PricingParams(), *more: str) -> DataFrame:
    """Zone windows with window bounds, pressure and price multiplier as plain columns.

    ``more`` names further columns of ``windows`` to carry along.
    """
    demand, supply = (F.col(name) for name in COUNTS)
    return windows.select(
        "h3_zone",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        demand,
        supply,
        pressure(demand, supply).alias("pressure"),
        multiplier(demand, supply, params).alias("price_multiplier"),
        *more,
    )


def zone_window_pricing(events: DataFrame, params: PricingParams = PricingParams(),
                        panes: bool | None = None) -> DataFrame:
    """Events to priced zone windows. A stream passes events that already carry a watermark."""
    return price_windows(aggregate_zone_windows(with_indicators(events, params), params, panes), params)


def compact_updates(updates: DataFrame) -> DataFrame:
    """Fold an update log to its newest version per zone and window.

    A stream in update mode emits a window whenever it changes. The message key is the zone alone,
    so compaction by key would mix windows; this folds by zone and window start.
    """
    return _newest(updates, ("h3_zone", "window_start"), "calculated_at")


def latest_pricing(pricing: DataFrame, closed_before: datetime | Column | None = None) -> DataFrame:
    """The newest window of every zone; of an update log, that window's newest version.

    ``closed_before`` ignores windows that are still filling at that time. Also runs as a stream, as
    a query of its own over the price topic: Spark refuses it behind the windowed aggregation in
    update mode. State is one row per zone.

    A log is ordered by (window end, calculation time) as one number in one aggregation: each task sends one row per zone,
    where folding versions first would shuffle nearly the whole log.
    """
    if closed_before is not None:
        limit = closed_before if isinstance(closed_before, Column) else F.lit(closed_before)
        pricing = pricing.where(F.col("window_end") <= limit)
    if "calculated_at" not in pricing.columns:
        return _newest(pricing, ("h3_zone",), "window_end")
    ordered = pricing.withColumn("_order", _micros("window_end") * F.lit(10**18) + _micros("calculated_at"))
    return _newest(ordered, ("h3_zone",), "_order").drop("_order")


def _micros(name: str) -> Column:
    """Microseconds since 1970 as a number wide enough for two of them side by side."""
    return F.coalesce(F.unix_micros(F.col(name).cast("timestamp")), F.lit(0)).cast("decimal(19,0)")


def _newest(df: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """Per key the row with the largest ``order``.

    One ``max_by`` per column keeps the aggregation buffer flat, so it is a hash aggregation with a
    partial step before the shuffle; a ``max_by`` over a struct would sort every input row.
    """
    newest = df.groupBy(*keys).agg(
        *[(F.max(c) if c == order else F.max_by(c, order)).alias(c) for c in df.columns if c not in keys]
    )
    return newest.select(*df.columns)
