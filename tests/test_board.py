"""Zone board: defaults, colours, maxima, totals."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from zoneflow.functions import display
from zoneflow.operators import board


def latest(spark, rows):
    return spark.createDataFrame(rows, "h3_zone string, demand_count int, available_driver_count int, "
                                       "pressure double, price_multiplier double")


def zones(spark, *keys):
    return spark.createDataFrame([(k, 35.0 + i, -5.0 - i) for i, k in enumerate(keys)],
                                 "h3_zone string, center_lat double, center_lon double")


PRICES = [("a", 6, 2, 2.0, 1.25), ("b", 0, 4, -1.0, 0.9), ("c", 3, 0, None, 1.5), ("elsewhere", 12, 8, -4.0, 1.0)]


@pytest.mark.parametrize("color_by, want", [
    ("Price multiplier", {"a": [177, 104, 80, 150], "b": [70, 180, 80, 150], "c": [255, 50, 80, 150],
                          "quiet": [100, 158, 80, 150]}),
    ("Demand count", {"a": [50, 165, 195, 145], "b": [50, 120, 150, 145], "c": [50, 142, 172, 145],
                      "quiet": [50, 120, 150, 145]}),
    ("Supply count", {"a": [50, 142, 172, 145], "b": [50, 165, 195, 145], "c": [50, 120, 150, 145],
                      "quiet": [50, 120, 150, 145]}),
    ("Pressure", {"a": [50, 165, 195, 145], "b": [50, 142, 172, 145], "c": [50, 120, 150, 145],
                  "quiet": [50, 120, 150, 145]}),
])
def test_colors(spark, color_by, want):
    rows = board.zone_board(zones(spark, "a", "b", "c", "quiet"), latest(spark, PRICES), color_by).collect()
    assert {r.h3_zone: r.fill_color for r in rows} == want


def test_neutral_values_and_label(spark):
    rows = {r.h3_zone: r for r in
            board.zone_board(zones(spark, "a", "c", "quiet"), latest(spark, PRICES)).collect()}
    quiet = rows["quiet"]
    assert (quiet.price_multiplier, quiet.demand_count, quiet.available_driver_count, quiet.pressure) == (1.0, 0, 0, 0.0)
    assert quiet.label == "1.00x\nD 0 / S 0"
    assert rows["a"].label == "1.25x\nD 6 / S 2"
    assert rows["c"].pressure == 0.0
    assert quiet.label_position == [-7.0, 37.0]
    assert quiet.line_color == [35, 35, 35, 190]
    assert set(rows) == {"a", "c", "quiet"}


def test_maxima_count_zones_off_the_board(spark):
    assert tuple(board.board_maxima(latest(spark, PRICES)).first()) == (12, 8, 4.0)
    assert tuple(board.board_maxima(latest(spark, [])).first()) == (0, 0, 0.0)


def test_board_without_prices(spark):
    [row] = board.zone_board(zones(spark, "a"), latest(spark, []), "Demand count").collect()
    assert row.fill_color == [50, 120, 150, 145]


def test_kpis(spark):
    rows = board.zone_board(zones(spark, "a", "b", "quiet"), latest(spark, PRICES))
    kpis = board.board_kpis(rows).first()
    assert tuple(kpis)[:3] == (3, 6, 6)
    assert kpis.average_multiplier == pytest.approx((1.25 + 0.9 + 1.0) / 3)
    assert (kpis.center_lat, kpis.center_lon) == (36.0, -6.0)
    assert tuple(board.board_kpis(rows.limit(0)).first()) == (0, 0, 0, 1.0, None, None)


def test_unknown_color_mode(spark):
    with pytest.raises(ValueError):
        board.zone_board(zones(spark, "a"), latest(spark, PRICES), "Mood")


def test_ramps_are_clamped_and_cut_off(spark):
    df = spark.createDataFrame([(0.1,), (0.9,), (1.0,), (1.5,), (9.0,)], "m double")
    reds = [r[0][0] for r in df.select(display.multiplier_color(F.col("m"))).collect()]
    assert reds == [70, 70, int(70 + (1.0 - 0.9) / 0.6 * 185), 255, 255]
