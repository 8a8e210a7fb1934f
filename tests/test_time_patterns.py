"""Time factors: lookup vectors, first match, defaults, checks and loading."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from zoneflow.defaults import TIME_PATTERNS, Factors, time_patterns
from zoneflow.functions.time import day_type
from zoneflow.operators import time_patterns as patterns
from zoneflow.sources.config import load_time_patterns


def config_text(chosen=(0, 3, 4, 5), **changes):
    listed = [
        {"pattern_id": name, "day_type": day, "hours": list(hours),
         "zone_type_multipliers": {k: {"demand_factor": d, "supply_factor": s} for k, (d, s) in factors.items()}}
        for name, day, hours, factors in (TIME_PATTERNS[i] for i in chosen)
    ]
    return {"time_patterns": listed, "default": {"demand_factor": 1.0, "supply_factor": 1.0}} | changes


def load(spark, tmp_path, config):
    path = tmp_path / "patterns.json"
    path.write_text(json.dumps(config, indent=2))
    return load_time_patterns(spark, str(path))


def factors(spark, config, when, kind, tz=None):
    df = spark.createDataFrame([(when, kind)], "event_time timestamp, type string")
    row = patterns.enrich_with_time_factors(df, config, tz=tz).first()
    return row.demand_factor, row.supply_factor


@pytest.mark.parametrize("when, want", [
    (datetime(2026, 4, 24, 8), "weekday"), (datetime(2026, 4, 25, 8), "weekend"),
    (datetime(2026, 4, 26, 23, 59), "weekend"), (datetime(2026, 4, 27), "weekday"), (None, None),
])
def test_day_type(spark, when, want):
    assert spark.createDataFrame([(when,)], "t timestamp").select(day_type(F.col("t"))).first()[0] == want


# The factors of the shipped patterns.
@pytest.mark.parametrize("when, kind, want", [
    (datetime(2023, 11, 13, 9, 59), "suburb", (1.4, 0.9)),
    (datetime(2023, 11, 15, 2), "residential", (0.6, 0.7)),
    (datetime(2023, 11, 17, 20), "airport", (0.9, 0.8)),
    (datetime(2023, 11, 18, 17, 30), "downtown", (1.3, 1.2)),
    (datetime(2023, 11, 19, 0, 1), "suburb", (0.8, 0.6)),
    (datetime(2023, 11, 14, 7), "harbour", (1.0, 1.0)),
    (datetime(2023, 11, 19, 6), "residential", (1.0, 1.0)),
    (datetime(2023, 11, 14, 7), None, (1.0, 1.0)),
    (None, "downtown", (1.0, 1.0)),
])
def test_lookup(spark, tmp_path, when, kind, want):
    assert factors(spark, load(spark, tmp_path, config_text()), when, kind) == want


def test_local_hours(spark):
    """08:00 UTC on a Friday is 17:00 in Tokyo: the evening peak."""
    assert factors(spark, time_patterns(spark), datetime(2026, 4, 24, 8), "downtown", "Asia/Tokyo") == (1.7, 1.2)


def test_first_pattern_owns_the_hour(spark, tmp_path):
    one = {"demand_factor": 2, "supply_factor": 3}
    two = {"demand_factor": 4, "supply_factor": 5}
    listed = [
        {"pattern_id": "first", "day_type": "weekday", "hours": [8], "zone_type_multipliers": {"a": one}},
        {"pattern_id": "second", "day_type": "weekday", "hours": [8, 9], "zone_type_multipliers": {"a": two, "b": two}},
    ]
    config = load(spark, tmp_path, {"time_patterns": listed, "default": {"demand_factor": 6, "supply_factor": 7}})
    assert factors(spark, config, datetime(2026, 4, 24, 8), "a") == (2.0, 3.0)
    assert factors(spark, config, datetime(2026, 4, 24, 8), "b") == (6.0, 7.0)
    assert factors(spark, config, datetime(2026, 4, 24, 9), "b") == (4.0, 5.0)


def test_shipped_patterns(spark, tmp_path):
    slots = patterns.time_slots(time_patterns(spark).patterns)
    assert slots.count() == slots.select("day_type", "hour", "type").distinct().count() == 4 * (24 + 19)
    covered = {r.hour for r in slots.where("day_type = 'weekend'").select("hour").distinct().collect()}
    assert set(range(24)) - covered == {3, 4, 5, 6, 7}
    from_file = load(spark, tmp_path, config_text(range(6)))
    assert from_file.default == Factors()
    assert from_file.patterns.orderBy("pattern_index").collect() == \
        time_patterns(spark).patterns.orderBy("pattern_index").collect()


def test_default_factors_are_optional(spark, tmp_path):
    config = config_text()
    del config["default"]
    assert load(spark, tmp_path, config).default == Factors(1.0, 1.0)


def found(spark, config):
    text = config if isinstance(config, str) or config is None else json.dumps(config)
    docs = spark.createDataFrame([("doc", text)], "id string, text string")
    return {(r.pattern_index, r.rule, r.detail) for r in patterns.pattern_violations(docs, "id", "text").collect()}


def test_valid_config_has_no_violations(spark):
    assert found(spark, config_text(range(6))) == set()


def broken(**changes):
    config = config_text((0, 1))
    config["time_patterns"][1] |= changes
    return config


@pytest.mark.parametrize("config, want", [
    (None, {(None, "config_not_object", None)}),
    ("nope", {(None, "config_not_object", None)}),
    ([], {(None, "config_not_object", None)}),
    ({}, {(None, "patterns_not_list", None)}),
    ({"time_patterns": []}, {(None, "patterns_not_list", None)}),
    (config_text(default=3), {(None, "factors_not_object", "default")}),
    (config_text(default={"demand_factor": True, "supply_factor": 1}),
     {(None, "factor_not_positive", "default.demand_factor")}),
    ({"time_patterns": [3]}, {(0, "pattern_not_object", None)}),
    ({"time_patterns": [{"pattern_id": "p", "day_type": "weekday"}]},
     {(0, "missing_field", "hours"), (0, "missing_field", "zone_type_multipliers")}),
    (broken(pattern_id=""), {(1, "pattern_id_not_text", None)}),
    (broken(pattern_id=5), {(1, "pattern_id_not_text", None)}),
    (broken(day_type="holiday"), {(1, "unknown_day_type", "holiday")}),
    (broken(hours=[]), {(1, "hours_not_list", None)}),
    (broken(hours="8"), {(1, "hours_not_list", None)}),
    (broken(hours=[24]), {(1, "invalid_hour", "24")}),
    (broken(hours=[8, -1, 7.5, "9", None]),
     {(1, "invalid_hour", "-1"), (1, "invalid_hour", "7.5"), (1, "invalid_hour", '"9"'), (1, "invalid_hour", "null")}),
    (broken(zone_type_multipliers={}), {(1, "multipliers_not_object", None)}),
    (broken(zone_type_multipliers={"": {"demand_factor": 1, "supply_factor": 1}}), {(1, "empty_zone_type", None)}),
    (broken(zone_type_multipliers={"a": 1}), {(1, "factors_not_object", "a")}),
    (broken(zone_type_multipliers={"a": {"demand_factor": -1, "supply_factor": "1"}}),
     {(1, "factor_not_positive", "a.demand_factor"), (1, "factor_not_positive", "a.supply_factor")}),
])
def test_violations(spark, config, want):
    assert found(spark, config) == want


@pytest.mark.parametrize("changes", [
    {"hours": [24]},
    {"zone_type_multipliers": {"residential": {"demand_factor": -1, "supply_factor": 1.1}}},
])
def test_loading_a_broken_config_fails(spark, tmp_path, changes):
    with pytest.raises(ValueError):
        load(spark, tmp_path, broken(**changes))


def test_expected_rates(spark):
    rows = [("a", 50, 40, 0.6, 1.5, 1.3), ("b", 5, 2, 1.2, 0.4, 0.2)]
    df = spark.createDataFrame(rows, "type string, base_demand int, base_supply int, price_sensitivity double, "
                                     "demand_factor double, supply_factor double")
    got = [tuple(r)[6:] for r in patterns.expected_rates(df).collect()]
    assert got[0] == (75.0, 52, 39.0, 0.625)
    assert got[1][:3] == (2.0, 1, 0.75)
