"""JSON messages in and out of an envelope of (topic, partition, offset, timestamp, key, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow import schemas
from zoneflow.functions.time import parse_time


def decode_events(raw: DataFrame, fields: tuple[str, ...] = tuple(schemas.EVENT.fieldNames())) -> DataFrame:
    """Event fields and topic of every message that names a zone.

    Malformed JSON and null values decode to all-NULL rows, so the zone test removes them too.
    ``received_at`` is the envelope's timestamp, where there is one. ``fields`` limits what is
    parsed to what the caller uses.
    """
    received = [F.col("timestamp").alias("received_at")] if "timestamp" in raw.columns else []
    schema = schemas.T.StructType([schemas.EVENT[name] for name in fields])
    return _parsed(raw, schema, "topic", *received)


def encode_events(events: DataFrame, *more: str) -> DataFrame:
    """Events as messages keyed by zone; NULL fields are left out of the JSON."""
    return events.select(
        "topic",
        F.col("h3_zone").alias("key"),
        F.to_json(F.struct(*schemas.EVENT.fieldNames())).alias("value"),
        *more,
    )


def encode_pricing(pricing: DataFrame, calculated_at: Column | None = None, keep_nulls: bool = False) -> DataFrame:
    """Priced zone windows as messages: key is the zone, value the JSON of eight fields.

    Fixed values: names and order of the fields are the wire format. Timestamps become text. A NULL pressure is left out of the JSON unless ``keep_nulls`` is set.
    """
    stamp = F.current_timestamp() if calculated_at is None else calculated_at
    value = F.to_json(
        F.struct(
            "h3_zone",
            F.col("window_start").cast("string").alias("window_start"),
            F.col("window_end").cast("string").alias("window_end"),
            "demand_count",
            "available_driver_count",
            "pressure",
            "price_multiplier",
            stamp.cast("string").alias("calculated_at"),
        ),
        {"ignoreNullFields": str(not keep_nulls).lower()},
    )
    return pricing.select(F.col("h3_zone").cast("string").alias("key"), value.alias("value"))


def decode_pricing(raw: DataFrame) -> DataFrame:
    """Price messages back to typed rows."""
    return _parsed(raw, schemas.PRICE_MESSAGE).withColumns(
        {name: parse_time(F.col(name)) for name in ("window_start", "window_end", "calculated_at")}
    )


def _parsed(raw: DataFrame, schema: schemas.T.StructType, *envelope: str | Column) -> DataFrame:
    """Parse the message value and keep the rows that name a zone.

    A filter on a plain ``from_json`` column is pushed below it and parses every message a second
    time. ``inline`` of a one-element array yields the same columns, and the filter stays above.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema)
    kept = raw.select(*envelope, F.inline(F.array(parsed)))
    return kept.where("h3_zone IS NOT NULL")
