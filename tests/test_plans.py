"""Physical plans: what is broadcast, what reaches the scan, what never happens."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from zoneflow.defaults import ZONES, time_patterns
from zoneflow.operators import events, pricing, time_patterns as patterns, zones
from zoneflow.plans import queries
from zoneflow.plans.tables import DAILY, cells, feed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = [name for name in queries.QUERIES if not name.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_products(spark, name):
    text = plan(queries.QUERIES[name](spark, SF_DIR))
    for forbidden in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert forbidden not in text


def test_spread_windows_are_combined_before_the_only_shuffle(spark):
    text = plan(pricing.zone_window_pricing(feed(spark, SF_DIR), DAILY, panes=False))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Exchange") == 1
    assert text.index("HashAggregate") < text.index("Exchange") < text.index("partial_sum") < text.index("Expand")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_flagship_spreads_panes_after_its_last_shuffle(spark):
    text = plan(pricing.zone_window_pricing(feed(spark, SF_DIR), DAILY))
    assert "Expand" not in text and text.count("Exchange") == 2
    windows, by_block, by_pane = text.split("Exchange")
    assert "explode(sequence(" in windows and "partial_sum" in windows
    assert by_block.strip().startswith("hashpartitioning(block") and "partial_sum" not in by_block
    assert "partial_sum" in by_pane
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_newest_rows_are_hash_aggregated(spark):
    text = plan(pricing.latest_pricing(pricing.zone_window_pricing(feed(spark, SF_DIR), DAILY)))
    assert "SortAggregate" not in text and "Sort [" not in text


def test_newest_of_a_log_is_hash_aggregated(spark):
    log = spark.range(1000).select(
        F.concat(F.lit("z"), F.col("id") % 7).alias("h3_zone"), F.timestamp_seconds(F.col("id") % 90).alias("window_end"),
        F.timestamp_seconds(F.col("id") % 13).alias("calculated_at"), F.col("id").cast("int").alias("demand_count"))
    newest = pricing.latest_pricing(log)
    text = plan(newest)
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text and text.count("Exchange") == 1
    rows = [(r.h3_zone, r.window_end, r.calculated_at) for r in log.collect()]
    want = {z: max((e, c) for y, e, c in rows if y == z) for z, _, _ in rows}
    assert {r.h3_zone: (r.window_end, r.calculated_at) for r in newest.collect()} == want


def test_time_slots_are_broadcast_by_their_size(spark):
    """No hint: with the size check turned off there is no broadcast."""
    df = feed(spark, SF_DIR).withColumn("type", F.lit("downtown"))
    assert "BroadcastHashJoin" in plan(patterns.enrich_with_time_factors(df, time_patterns(spark)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(patterns.enrich_with_time_factors(df, time_patterns(spark)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbering_sorts_per_range(spark):
    numbered = zones.number_rows(cells(spark, SF_DIR).select("h3_zone"), "h3_zone")
    text = plan(numbered)
    assert "row_number()" not in text
    assert text.count("Exchange hashpartitioning") == 1  # the range counts, one row per range
    [single] = re.findall(r"Exchange SinglePartition.*\n.*\n.*", text)
    assert "count" in single


def test_radius_box_reaches_the_scan(spark, tmp_path):
    cells(spark, SF_DIR).write.parquet(str(tmp_path / "cells"))
    text = plan(zones.within_radius(spark.read.parquet(str(tmp_path / "cells")), ZONES.area))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThanOrEqual(center_lat" in pushed and "LessThanOrEqual(center_lon" in pushed


def test_tail_bound_reaches_the_scan(spark, tmp_path):
    log = spark.range(0, 20000, 1, 4).select(F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"),
                                             F.col("id").alias("offset"))
    log.write.parquet(str(tmp_path / "log"))
    text = plan(events.tail(spark.read.parquet(str(tmp_path / "log")), 100))
    assert "GreaterThan(offset,19897)" in text and "BroadcastHashJoin" in text


def test_latest_time_reaches_the_scan(spark):
    text = plan(queries.recent_events(spark, SF_DIR))
    assert re.search(r"GreaterThanOrEqual\(ts,20\d\d-", text)


def test_hot_zone_join_is_split(spark):
    """A third of the events in one zone, and a zone table too big to broadcast."""
    hot = F.when(F.col("id") % 3 == 0, "z7").otherwise(F.concat(F.lit("z"), F.col("id") % 1000))
    df = spark.range(0, 300_000, 1, 8).select(
        hot.alias("h3_zone"), F.lit(datetime(2026, 4, 24, 8)).alias("event_time"), F.col("id").alias("event_id"))
    kinds = spark.range(1000).select(F.concat(F.lit("z"), "id").alias("h3_zone"), F.lit("downtown").alias("type"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = df.join(kinds, "h3_zone", "left")
        rows = joined.collect()
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == 300_000 and all(r.type == "downtown" for r in rows)


def test_shared_folder_comes_from_the_session(spark):
    from zoneflow.session import materialize, shared_folder
    folder = shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert folder == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")
    table = materialize(spark.range(10).toDF("n"), "test")
    assert table.inputFiles()[0].split(":", 1)[-1].lstrip("/").startswith(folder.split(":", 1)[-1].lstrip("/"))
    assert sorted(r.n for r in table.collect()) == list(range(10))
