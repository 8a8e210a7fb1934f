"""What a stopped or running stream holds, read from its checkpoint as tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.operators.pricing import COUNTS, price_windows
from zoneflow.params import PricingParams
from zoneflow.sources.folders import file_system, read_text


def open_windows(spark: SparkSession, checkpoint: str, params: PricingParams = PricingParams()) -> DataFrame:
    """Priced windows that a ``pricing_stream`` still holds after its last committed batch, those that can yet change.

    State is read by Spark's own reader, one task per state partition. The session selects the same state store as the stream."""
    held = spark.read.format("statestore").load(checkpoint)
    counts = F.col("value").cast(f"struct<{COUNTS[0]}: bigint, {COUNTS[1]}: bigint>")
    rows = held.select("key.window", "key.h3_zone", counts.alias("counts"))
    return price_windows(rows.select("window", "h3_zone", *[F.col(f"counts.{name}").cast("int").alias(name) for name in COUNTS]), params)


def state_size(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(operator, rows)``: rows that each stateful operator of a stream holds, by its number."""
    operators = [row.operatorId for row in spark.read.format("state-metadata").load(checkpoint).select("operatorId").distinct().collect()]
    sizes = [spark.read.format("statestore").option("operatorId", number).load(checkpoint).agg(
        F.lit(number).cast("int").alias("operator"), F.count(F.lit(1)).alias("rows")) for number in sorted(operators)]
    found = spark.createDataFrame([], "operator int, rows long")
    for size in sizes:
        found = found.unionByName(size)
    return found


def watermarks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(batch, watermark)`` of the batches whose offsets the checkpoint keeps; the watermark is what each of them began with."""
    files, folder = file_system(spark, f"{checkpoint.rstrip('/')}/offsets")
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    batches = sorted(int(name) for name in names if name.isdigit())
    millis = [json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/offsets/{n}").splitlines()[1])["batchWatermarkMs"] for n in batches]
    rows = spark.createDataFrame(list(zip(batches, millis, strict=True)), "batch long, millis long")
    return rows.select("batch", F.timestamp_millis("millis").alias("watermark"))
