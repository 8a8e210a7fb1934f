"""Tables of cells stored in curve order, and radius queries that skip most of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.defaults import Area
from zoneflow.functions.curve import circle_ranges, curve_key, in_ranges
from zoneflow.operators.zones import within_radius

CURVE = "curve"


def write_cells(cells: DataFrame, path: str, lat: str = "center_lat", lon: str = "center_lon",
                files: int | None = None, group_bytes: int = 16 << 20) -> None:
    """Write cells in the order of their ``curve_key``, which is kept in the column ``curve``.

    Each file holds one stretch of the curve and each row group of about ``group_bytes`` a part of it. Cells with equal keys
    are dealt by all their columns, so a crowded place does not end up in one task. Cells without a place come first, with a null key. ``files`` is the
    shuffle width unless given. A column ``curve`` of the input is an error.
    """
    if CURVE in cells.columns:
        raise ValueError(f"cells already have a column {CURVE!r}")
    order = [CURVE, *(f.name for f in cells.schema.fields if isinstance(f.dataType, (T.StringType, T.NumericType)))]
    keyed = cells.withColumn(CURVE, curve_key(F.col(lat), F.col(lon)))
    dealt = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    dealt.sortWithinPartitions(CURVE).write.option("parquet.block.size", group_bytes).parquet(path)


def read_cells_within(spark: SparkSession, path: str, area: Area, lat: str = "center_lat", lon: str = "center_lon",
                      ranges: int = 64) -> DataFrame:
    """``within_radius`` over a table of ``write_cells``: same rows, and the column ``curve``.

    The circle becomes at most ``ranges`` ranges of keys. They reach the scan, which reads only files, row groups and pages
    whose least and largest key touch one.
    """
    covering = circle_ranges(area.center_lat, area.center_lon, area.radius_km, ranges)
    return within_radius(spark.read.parquet(path).where(in_ranges(F.col(CURVE), covering)), area, lat, lon)
