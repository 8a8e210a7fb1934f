"""Price formula, parameters, windows, latest price and update log."""

from __future__ import annotations

import math
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zoneflow.functions.pricing import multiplier, pressure
from zoneflow.operators import pricing
from zoneflow.params import PricingParams

PARAMS = PricingParams()


def price(spark, pairs, params=PARAMS):
    df = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "i int, d int, s int")
    rows = df.select("i", pressure(F.col("d"), F.col("s")), multiplier(F.col("d"), F.col("s"), params)).collect()
    return [tuple(row[1:]) for row in sorted(rows)]


@pytest.mark.parametrize("demand, supply, weight, want_pressure, want_multiplier", [
    (7, 7, 0.7, 0.0, 1.0),
    (25, 20, 0.3, 0.25, 1.0 + 0.3 * math.tanh(0.25)),
    (30, 40, 0.2, -0.25, 1.0 + 0.2 * math.tanh(-0.25)),
    (3, 12, 0.5, -0.75, 0.9),
    (0, 17, 0.2, -1.0, 0.9),
    (640, 5, 2.0, 127.0, 1.5),
    (1, 0, 0.6, None, 1.5),
    (-4, 0, 0.6, 0.0, 1.0),
    (0, 0, 1.5, 0.0, 1.0),
])
def test_formula(spark, demand, supply, weight, want_pressure, want_multiplier):
    [(p, m)] = price(spark, [(demand, supply)], PricingParams(pressure_weight=weight))
    assert p == want_pressure
    assert m == pytest.approx(want_multiplier, abs=1e-15)


@pytest.mark.parametrize("bad", [
    {"min_multiplier": 0}, {"min_multiplier": -1}, {"max_multiplier": 0.8}, {"pressure_weight": 0},
    {"pressure_weight": float("nan")}, {"slide_seconds": 0}, {"slide_seconds": 20}, {"window_seconds": 0},
])
def test_parameters_are_checked(bad):
    with pytest.raises(ValueError):
        PricingParams(**bad)


def test_parameters_from_environment():
    params = PricingParams.from_env({"PRICING_WINDOW_SECONDS": "60", "PRICING_MAX_MULTIPLIER": "2", "OTHER": "x"})
    assert params == PricingParams(window_seconds=60, max_multiplier=2.0)
    assert (PARAMS.window, PARAMS.slide, PARAMS.watermark) == ("15 seconds", "5 seconds", "15 seconds")


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=st.lists(st.tuples(st.integers(0, 500), st.integers(0, 500)), min_size=20, max_size=60),
       weight=st.floats(0.05, 3), low=st.floats(0.1, 1), high=st.floats(1, 4))
def test_multiplier_is_bounded_and_monotone(spark, pairs, weight, low, high):
    params = PricingParams(min_multiplier=low, max_multiplier=high, pressure_weight=weight)
    more_demand = [(d + 1, s) for d, s in pairs]
    more_supply = [(d, s + 1) for d, s in pairs]
    result = price(spark, pairs + more_demand + more_supply, params)
    n = len(pairs)
    for (d, s), base, demand, supply in zip(pairs, result, result[n:], result[2 * n:]):
        assert low <= base[1] <= high
        if d == s:
            assert base[0] == 0.0
        if s > 0:
            assert base[0] == d / s - 1
            assert base[1] == pytest.approx(min(high, max(low, 1 + weight * math.tanh(d / s - 1))), abs=1e-12)
            assert demand[1] >= base[1] >= supply[1]


def events_of(spark, rows):
    return spark.createDataFrame(rows, "event_time timestamp, topic string, status string, h3_zone string")


def brute_force(rows, params):
    counts = defaultdict(lambda: [0, 0])
    for when, topic, status, zone in rows:
        last = int(when.timestamp()) // params.slide_seconds * params.slide_seconds
        for start in range(last, int(when.timestamp()) - params.window_seconds, -params.slide_seconds):
            counts[zone, start][0] += topic == params.ride_topic
            counts[zone, start][1] += topic == params.driver_topic and status == "available"
    return {(zone, start, *pair) for (zone, start), pair in counts.items()}


@pytest.mark.parametrize("window, slide", [(15, 5), (15, 15), (14, 4), (60, 1), (7, 3)])
@pytest.mark.parametrize("panes", [False, True, None])
def test_windows_against_brute_force(spark, window, slide, panes):
    """One zone holds a third of all events."""
    params = PricingParams(window_seconds=window, slide_seconds=slide)
    start = datetime(2026, 4, 24, 8)
    rows = []
    for i in range(600):
        zone = "hot" if i % 3 == 0 else f"z{i % 40}"
        topic = params.ride_topic if i % 2 else params.driver_topic
        status = None if i % 2 else ("available", "busy", "Available")[i % 7 % 3]
        rows.append((start + timedelta(seconds=(i * 37 % 211) + (i % 10) / 10), topic, status, zone))
    got = pricing.zone_window_pricing(events_of(spark, rows), params, panes)
    assert dict(got.dtypes)["demand_count"] == dict(got.dtypes)["available_driver_count"] == "int"
    epoch = F.unix_timestamp("window_start")
    found = got.select("h3_zone", epoch, "demand_count", "available_driver_count").collect()
    utc = [(w.replace(tzinfo=None), *rest) for w, *rest in rows]
    assert {tuple(row) for row in found} == brute_force(utc, params)
    assert len(found) == len({tuple(row)[:2] for row in found})


def test_busy_zone_has_a_row_and_silent_zone_has_none(spark):
    when = datetime(2026, 4, 24, 8)
    rows = pricing.zone_window_pricing(events_of(spark, [(when, PARAMS.driver_topic, "busy", "a")])).collect()
    assert len(rows) == 3
    assert {(r.h3_zone, r.demand_count, r.available_driver_count, r.pressure, r.price_multiplier) for r in rows} == {
        ("a", 0, 0, 0.0, 1.0)}


def price_log(spark, rows):
    base = datetime(2026, 4, 24, 8)
    at = lambda s: base + timedelta(seconds=s)
    return spark.createDataFrame(
        [(z, at(e - 15), at(e), d, 1, None if p is None else float(p), 1.0, at(c)) for z, e, d, p, c in rows],
        "h3_zone string, window_start timestamp, window_end timestamp, demand_count int, "
        "available_driver_count int, pressure double, price_multiplier double, calculated_at timestamp")


def test_compaction_and_latest(spark):
    log = price_log(spark, [
        ("a", 15, 1, 1, 10), ("a", 15, 2, None, 12), ("a", 20, 1, 2, 12), ("a", 20, 5, 3, 16), ("b", 15, 9, 4, 10)])
    compact = pricing.compact_updates(log)
    assert compact.columns == log.columns
    assert {(r.h3_zone, r.demand_count, r.pressure) for r in compact.collect()} == {
        ("a", 2, None), ("a", 5, 3.0), ("b", 9, 4.0)}
    assert {(r.h3_zone, r.demand_count) for r in pricing.latest_pricing(log).collect()} == {("a", 5), ("b", 9)}
    assert {(r.h3_zone, r.demand_count) for r in pricing.latest_pricing(pricing.compact_updates(log)).collect()} == {
        ("a", 5), ("b", 9)}
    closed = pricing.latest_pricing(log, datetime(2026, 4, 24, 8, 0, 15))
    assert {(r.h3_zone, r.demand_count) for r in closed.collect()} == {("a", 2), ("b", 9)}


def test_wall_clock_times_outside_utc_are_still_aligned(spark):
    """In a zone half an hour off, wall-clock seconds would shift the slides; the plain form is used."""
    hour = PricingParams(window_seconds=7200, slide_seconds=3600)
    rows = [(datetime(2026, 4, 24, 8, 10), PARAMS.ride_topic, None, "a")]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = events_of(spark, rows).withColumn("event_time", F.lit(rows[0][0].isoformat()).cast("timestamp_ntz"))
        starts = {r.window_start for r in pricing.zone_window_pricing(df, hour).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert starts == {datetime(2026, 4, 24, 7), datetime(2026, 4, 24, 8)}


def test_instants_outside_utc_need_no_plain_form(spark):
    hour = PricingParams(window_seconds=7200, slide_seconds=3600)
    rows = [(datetime(2026, 4, 24, 8, 10) + timedelta(minutes=17 * i), PARAMS.ride_topic, None, f"z{i % 2}")
            for i in range(60)]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = events_of(spark, rows)
        tiled = pricing.zone_window_pricing(df, hour)
        assert "explode(sequence(" in tiled._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, tiled.collect())) == sorted(
            map(tuple, pricing.zone_window_pricing(df, hour, panes=False).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("window, slide", [(24, 1), (15, 4), (10, 7)])
def test_panes_spread_only_finished_windows(spark, window, slide):
    """Nothing is summed above the spreading, and windows equal those of events spread one by one, over several blocks."""
    params = PricingParams(window_seconds=window, slide_seconds=slide)
    events = spark.range(400).select(
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(900)) - 300).alias("event_time"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("z"), F.col("id") % 3)).alias("h3_zone"),
        F.when(F.col("id") % 2 == 0, params.ride_topic).otherwise(params.driver_topic).alias("topic"),
        F.when(F.col("id") % 5 > 0, "available").alias("status"))
    by_panes = pricing.zone_window_pricing(events, params, True)
    plan = by_panes._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("Aggregate" in line for line in plan[:next(i for i, line in enumerate(plan) if "explode(sequence(" in line)])
    want = pricing.zone_window_pricing(events, params, False)
    assert sorted(map(repr, by_panes.collect())) == sorted(map(repr, want.collect()))
