"""Interleaves sources so that every prefix keeps to target weights: Pfair scheduling of blocks, earliest deadline first.

One slot takes one block of one source. With ``p`` of ``period`` slots, block ``k`` of a source may not start before slot
``floor(k * period / p)`` and must be done by slot ``ceil((k + 1) * period / p)``. Earliest deadline first meets all these
windows, hence no source is ever a whole block ahead of or behind its target. The schedule repeats after ``period`` slots,
so one period is worked out from the weights alone. Given targets are taken as exact ratios and the period is their common
denominator, so nothing is rounded and nothing adds up over periods. Blocks, not rows, are then put in the order of their
slots, in parallel ranges, and every row finds its place from the rows in the blocks before its own.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import row_key
from zoneflow.session import materialize

#: Rows of a source are numbered in this many buckets of ``doc_id``, a prime, so that a source with a third of all rows is
#: many small groups.
BUCKETS = 4093
#: Sources that one ``period`` is made for; for more of them the period grows in proportion.
PERIOD_GROUPS = 64
#: Longest period of given targets, in slots: one period is played on the driver.
LONGEST_PERIOD = 1 << 20
#: Blocks of a source that are listed at a time, so that a source with a third of all rows is many small groups.
BLOCK_CHUNK = 4096


@dataclass(frozen=True)
class MixParams:
    """``block_rows`` documents make a block. Without targets ``period`` is the number of slots for up to ``PERIOD_GROUPS`` sources. Every
    source is a group of its own, unless ``max_groups`` is set lower: then all but the ``max_groups - 1`` largest share one
    group, whose rows are mixed like any other's. ``exponent`` tempers the counts to default weights, which are whole slots of
    the period: these slots are the targets."""

    period: int = 1000
    block_rows: int = 16
    max_groups: int = (1 << 31) - 1
    exponent: float = 0.5


def quotas(weights: Mapping[int, float], period: int) -> dict[int, int]:
    """Slots of each group in one period: proportional, at least one each, in all exactly ``period`` (largest remainder)."""
    if len(weights) > period:
        raise ValueError("more groups than slots in a period")
    total = sum(weights.values())
    spare = period - len(weights)
    exact = {g: max(0.0, w / total * period - 1) for g, w in weights.items()}
    scale = spare / (sum(exact.values()) or 1)
    share = {g: 1 + math.floor(x * scale) for g, x in exact.items()}
    left = period - sum(share.values())
    for g in sorted(exact, key=lambda g: (-(exact[g] * scale % 1), g))[:left]:
        share[g] += 1
    return share


def exact_shares(weights: Mapping[int, float]) -> dict[int, int]:
    """Slots of each group in the shortest period that holds all ratios of the weights exactly.

    A weight counts as the decimal number it is written as (0.1 is a tenth). Raises if no period of ``LONGEST_PERIOD`` slots does.
    """
    ratios = {g: Fraction(str(w)) for g, w in weights.items()}
    if min(ratios.values()) <= 0:
        raise ValueError("target weights must be positive")
    unit = math.lcm(*(r.denominator for r in ratios.values()))
    whole = {g: int(r * unit) for g, r in ratios.items()}
    common = math.gcd(*whole.values())
    share = {g: n // common for g, n in whole.items()}
    if sum(share.values()) > LONGEST_PERIOD:
        raise ValueError(f"target weights need a period of {sum(share.values())} slots, {LONGEST_PERIOD} at most: give them fewer digits")
    return share


def schedule(share: Mapping[int, int]) -> list[int]:
    """The group of every slot of one period: among released blocks, the earliest deadline, then the lower group."""
    period = sum(share.values())
    waiting = [(0, math.ceil(period / p), g, 0) for g, p in share.items()]  # release, deadline, group, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    slots = []
    for now in range(period):
        while waiting and waiting[0][0] <= now:
            _, deadline, g, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, g, k))
        _, g, k = heapq.heappop(ready)
        slots.append(g)
        if (k := k + 1) < share[g]:
            heapq.heappush(waiting, (k * period // share[g], -(-(k + 1) * period // share[g]), g, k))
    return slots


def mix_sources(docs: DataFrame, params: MixParams = MixParams(), targets: Mapping[str, float] | None = None) -> DataFrame:
    """``(doc_id, source, source_group, block, slot, release, deadline, position)``, one row per input row.

    ``position`` numbers all rows from 0 without gaps in the mixed order, ``slot`` is the place of the row's block in the
    endless schedule. Weights are ``targets`` by source, kept to exactly however many rows there are, or the sources' counts to
    the power ``exponent``; each source without a target has the smallest one. When a source runs out the others keep their slots. Within a source rows follow
    ``doc_id`` in ``BUCKETS`` residue classes; rows with equal ids follow each other in any order, null ids come last, and
    null is a source like any other. Other columns are ignored, an empty table gives an empty result.
    """
    return _placed(docs.select("doc_id", "source"), params, targets).select(
        "doc_id", "source", "source_group", "block", "slot", "release", "deadline", "position")


def order_documents(docs: DataFrame, params: MixParams = MixParams(), targets: Mapping[str, float] | None = None) -> DataFrame:
    """All rows of ``docs`` with all their columns, dealt into partitions by position and in mixed order within each.

    Equal rows follow each other in any order, null ids and sources are placed as ``mix_sources`` says, an empty table stays empty."""
    ordered = _with_places(docs, params, targets).repartitionByRange("at").sortWithinPartitions("at")
    return ordered.select(*[F.col("__doc").getField(c).alias(c) for c in docs.columns])


def place_documents(
    docs: DataFrame, name: str, params: MixParams = MixParams(), targets: Mapping[str, float] | None = None
) -> DataFrame:
    """All rows of ``docs`` with all their columns and their position in the mixed order, in any order.

    The position follows from the rows alone, whatever files they were read from; a column called ``name`` is replaced.
    Equal rows share out their places, nulls are placed as ``mix_sources`` says, an empty table stays empty.
    """
    return _with_places(docs, params, targets).select(
        *[F.col("__doc").getField(c).alias(c) for c in docs.columns if c != name], F.col("at").alias(name))


def _with_places(docs: DataFrame, params: MixParams, targets: Mapping[str, float] | None) -> DataFrame:
    """``(__doc, at)``: every row as a struct with its position."""
    packed = docs.select(
        row_key(F.col("doc_id"), F.col("text"), F.col("source")).alias("__key"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"))
    narrow = packed.select("__key", F.col("__doc")["doc_id"].alias("doc_id"), F.col("__doc")["source"].alias("source"))
    # Equal rows share a key; each takes one of the key's places.
    places = _placed(narrow, params, targets).groupBy("__key").agg(
        F.min("position").alias("at"), F.when(F.count("*") > 1, F.sort_array(F.collect_list("position"))).alias("more"),
        F.count("*").alias("n"))
    placed = packed.join(materialize(places, "mix-places"), "__key")
    once = placed.filter("n = 1").select("__doc", "at")
    numbered = Window.partitionBy("__key").orderBy("__key")
    again = placed.filter("n > 1").withColumn("i", F.row_number().over(numbered)).select(
        "__doc", F.element_at("more", F.col("i")).alias("at"))
    return once.unionByName(again)


def _placed(rows: DataFrame, params: MixParams, targets: Mapping[str, float] | None) -> DataFrame:
    bucketed = rows.withColumn(
        "bucket", F.coalesce(F.pmod(F.col("doc_id"), F.lit(BUCKETS)), F.lit(BUCKETS)).cast("int"))
    counts = materialize(bucketed.groupBy("source", "bucket").agg(F.count("*").alias("n")), "mix-counts")
    sizes = counts.groupBy("source").agg(F.sum("n").alias("n"))
    # One row per source reaches the driver: the schedule is worked out there, from names and counts alone.
    found = sizes.orderBy(F.desc("n"), F.asc_nulls_last("source")).toArrow()
    names, size = found.column("source").to_pylist(), found.column("n").to_pylist()
    own_groups = min(len(names), params.max_groups - 1)
    groups = [min(g, own_groups) for g in range(len(names))]
    if own_groups < len(names):
        size = [*size[:own_groups], sum(size[own_groups:])]
    if targets:
        least = min(targets.values())
        weights = {g: targets.get(names[g], least) if g < own_groups else least for g in range(len(size))}
        share = exact_shares(weights or {0: 1})
    else:
        weights = {g: n ** params.exponent for g, n in enumerate(size)}
        share = quotas(weights or {0: 1.0}, max(params.period, -(-params.period * len(size) // PERIOD_GROUPS)))
    slots_all = sum(share.values())

    spark = rows.sparkSession
    named = _table(spark, "mix-groups", __source=pa.array(names, pa.string()), source_group=pa.array(groups, pa.int32()))
    scheduled = _table(
        spark, "mix-quotas", source_group=pa.array(range(len(size)), pa.int32()), held=pa.array(size, pa.int64()),
        own=pa.array([share[g] for g in range(len(size))], pa.int64()))
    with_group = lambda some: some.join(named, some["source"].eqNullSafe(named["__source"])).drop("__source")
    # A row's number within its group: rows in earlier buckets of the group, then its number within the bucket.
    by_bucket = Window.partitionBy("source_group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = with_group(counts).groupBy("source_group", "bucket").agg(F.sum("n").alias("n")).select(
        "source_group", "bucket", F.coalesce(F.sum("n").over(by_bucket), F.lit(0)).alias("offset"))
    # Rows with equal ids follow their keys, where there are any: equal tables give equal places.
    in_bucket = Window.partitionBy("source_group", "bucket").orderBy("doc_id", *[c for c in rows.columns if c == "__key"])
    numbered = with_group(bucketed).withColumn("__i", F.row_number().over(in_bucket) - 1).join(
        materialize(offsets, "mix-offsets"), ["source_group", "bucket"]).withColumn("__i", F.col("offset") + F.col("__i"))
    numbered = numbered.withColumn("block", F.floor(F.col("__i") / params.block_rows).cast("long"))
    blocks = _blocks(scheduled, _period_table(spark, share), params.block_rows, slots_all)
    return numbered.join(blocks, ["source_group", "block"]).select(
        *rows.columns, "source_group", "block", "slot", "release", "deadline",
        (F.col("before") + F.col("__i") % params.block_rows).alias("position"))


def _blocks(scheduled: DataFrame, slots: DataFrame, block_rows: int, period: int) -> DataFrame:
    """``(source_group, block, slot, release, deadline, before)``: every block, with the rows in all blocks of earlier slots."""
    last = F.floor((F.col("held") - 1) / block_rows).cast("long")
    some = scheduled.filter("held > 0").select(
        "*", last.alias("last"), F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(BLOCK_CHUNK).cast("long"))).alias("__from"))
    listed = some.repartition("source_group", "__from").select("source_group", "held", "own", F.explode(F.sequence(
        F.col("__from"), F.least(F.col("last"), F.col("__from") + BLOCK_CHUNK - 1))).alias("block"))
    listed = listed.withColumn("turn", F.floor(F.col("block") / F.col("own")).cast("long")).withColumn(
        "nth", (F.col("block") % F.col("own")).cast("int")).join(slots, ["source_group", "nth"])
    every = F.lit(period).cast("long")
    listed = listed.select(
        "source_group", "block", (F.col("turn") * every + F.col("at")).alias("slot"),
        F.floor(F.col("block") * every / F.col("own")).cast("long").alias("release"),
        F.ceil((F.col("block") + 1) * every / F.col("own")).cast("long").alias("deadline"),
        F.least(F.lit(block_rows).cast("long"), F.col("held") - F.col("block") * block_rows).alias("size"))
    ordered = materialize(listed, "mix-listed").repartitionByRange("slot").withColumn("range", F.spark_partition_id())
    ordered = materialize(ordered, "mix-ranges")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: both the global window and the broadcast are bounded by the partition count.
    starts = ordered.groupBy("range").agg(F.sum("size").alias("size")).select(
        "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("range").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(ordered.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        F.broadcast(starts), "range").select(
        "source_group", "block", "slot", "release", "deadline", (F.col("start") + F.col("within")).alias("before")), "mix-blocks")


def _table(spark: SparkSession, label: str, **columns: pa.Array) -> DataFrame:
    return materialize(spark.createDataFrame(pa.table(columns)), label)


def _period_table(spark: SparkSession, share: Mapping[int, int]) -> DataFrame:
    """``(source_group, nth, at)``: the slot of each group's nth block of a period."""
    slots = schedule(share)
    seen = [0] * len(share)
    nth = []
    for g in slots:
        nth.append(seen[g])
        seen[g] += 1
    return _table(spark, "mix-slots", source_group=pa.array(slots, pa.int32()), nth=pa.array(nth, pa.int32()),
                  at=pa.array(range(len(slots)), pa.int64()))
