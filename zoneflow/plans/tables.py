"""The given tables in the shape of marketplace data.

``events`` become requests (click, view) and driver updates (signup and purchase: available; error:
busy) of the customer's cell; ``customer`` rows are the candidate cells. Both grow with the scale.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import asdict, replace
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.defaults import TIME_PATTERNS, ZONES, Area
from zoneflow.params import DRIVER_UPDATES_TOPIC, RIDE_REQUESTS_TOPIC, PricingParams
from zoneflow.session import STATE_SETTINGS, new_folder
from zoneflow.sources.folders import data_files, set_order
from zoneflow.sources.price_log import Folding, log_sink
from zoneflow.sources.streams import table_sink
from zoneflow.streaming.pricing import pricing_stream, run_to_end

# A cell sees a few events a day: day-long windows, every eight hours.
DAILY = PricingParams(window_seconds=86_400, slide_seconds=28_800)
TUMBLING = PricingParams(window_seconds=86_400, slide_seconds=86_400)
HOURLY = PricingParams(window_seconds=86_400, slide_seconds=3_600)

MOVED = replace(ZONES, random_seed=43, area=Area(ZONES.area.center_lat + 0.05, ZONES.area.center_lon, 8.0))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def as_feed(events: DataFrame, *more: str) -> DataFrame:
    """``events`` as marketplace events; every tenth props value stands for a missing location."""
    located = ~F.col("props").endswith("0}")
    kind = F.col("event_type")
    return events.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.when(kind.isin("click", "view"), RIDE_REQUESTS_TOPIC).otherwise(DRIVER_UPDATES_TOPIC).alias("topic"),
        F.when(kind.isin("signup", "purchase"), "available").when(kind == "error", "busy").alias("status"),
        _cell_name(F.col("user_id")).alias("h3_zone"),
        F.when(located, ZONES.area.center_lat + (F.col("value") - 50) / 1000).alias("lat"),
        F.when(located, ZONES.area.center_lon + (F.col("event_id") % 1000 - 500) / 10000).alias("lon"),
        *more,
    )


def _cell_name(number: Column) -> Column:
    """Nine digits or more. Padding stays in generated code; a format string is parsed again for every row."""
    digits = number.cast("string")
    return F.concat(F.lit("Customer#"), F.lpad(digits, F.greatest(F.length(digits), F.lit(9)), F.lit("0")))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_feed(read(spark, sf_dir, "events"))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON messages; props 1 to 6 stand for the ways a message can be off."""
    off = F.col("props")
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    zone = F.when(off == '{"k": 2}', None).when(off == '{"k": 4}', "").otherwise(F.col("h3_zone"))

    def message(zone: Column) -> Column:
        return F.to_json(F.struct(
            F.col("event_id").cast("string").alias("event_id"),
            F.when(off == '{"k": 3}', "garbage").otherwise(iso).alias("timestamp"),
            "lat", "lon", zone.alias("h3_zone"), "status",
        ))

    value = (
        F.when(off == '{"k": 1}', F.concat(F.lit("broken "), message(zone)))
        .when(off == '{"k": 6}', message(F.col("event_id")))
        .when(off != '{"k": 5}', message(zone))
    )
    return as_feed(read(spark, sf_dir, "events"), "props").select("topic", value.alias("value"))


def message_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of four partitions per topic, with the event's id as offset."""
    return as_feed(read(spark, sf_dir, "events"), "user_id").select(
        "topic", (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.col("h3_zone").alias("key"), F.col("status").alias("value"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as candidate cells, spread over about 22 by 18 km."""
    key = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("h3_zone"),
        (ZONES.area.center_lat + ((key * 7919) % 2001 - 1000) / 10000).alias("center_lat"),
        (ZONES.area.center_lon + ((key * 104729) % 2003 - 1001) / 10000).alias("center_lon"),
    )


def segment_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone type by market segment; no time pattern knows the last one."""
    names = {"AUTOMOBILE": "downtown", "BUILDING": "residential", "FURNITURE": "airport",
             "HOUSEHOLD": "suburb", "MACHINERY": "industrial"}
    kind = F.lit(None)
    for segment, name in names.items():
        kind = F.when(F.col("c_mktsegment") == segment, name).otherwise(kind)
    return read(spark, sf_dir, "customer").select(F.col("c_name").alias("h3_zone"), kind.alias("type"))


STREAM_FILES = 8  # pieces of time of a replayed table, one per trigger
ROW_GROUP_BYTES = 4 << 20  # of those files: a trigger reads its one file in as many tasks as it has row groups
#: For streams that run to their end here and whose log is read afterwards.
REPLAY_SETTINGS = {
    # counting the rows of a store costs one more lookup with every row put or removed
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # a store takes no more memory than its state needs, instead of 64 MB and more once that much has passed through it
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "16",
    # the default is a 12-byte value that is made and compared as an object, three of them in every row of prices
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # a fold writes closed and open rows side by side, without sorting them apart
    "spark.sql.maxConcurrentOutputFileWriters": "2",
}


def ordered_files(spark: SparkSession, sf_dir: str, with_late: bool = True) -> str:
    """``events`` as a stream would bring them: files in order of time, and last one with old events once more.

    Modification times put the files in order, as they would be if each had been written when its events happened. The events
    of the last file are late for every window they lie in.
    """
    folder = new_folder(spark, "events")
    read(spark, sf_dir, "events").repartitionByRange(STREAM_FILES, "ts").sortWithinPartitions("ts").write.option(
        "parquet.block.size", ROW_GROUP_BYTES).parquet(f"{folder}/ontime")
    set_order(spark, data_files(spark, f"{folder}/ontime"))
    if with_late:
        add_late_file(spark, sf_dir, folder)
    return folder


def add_late_file(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The events of the first day once more, after all others."""
    events = read(spark, sf_dir, "events")
    first_day = events.agg(F.min("ts") + F.expr("INTERVAL 1 DAY")).first()[0]
    events.where(F.col("ts") < F.lit(first_day)).repartition(1).write.parquet(f"{folder}/late")
    set_order(spark, [*data_files(spark, f"{folder}/ontime"), *data_files(spark, f"{folder}/late")])


def replayed(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """A stream over ``ordered_files``, one file per trigger."""
    source = spark.readStream.schema(read(spark, sf_dir, "events").schema).option("maxFilesPerTrigger", 1)
    return as_feed(source.parquet(f"{folder}/*")).withColumn("event_time", F.col("event_time").cast("timestamp"))


def update_log(spark: SparkSession, sf_dir: str, mode: str = "update") -> str:
    """Run the pricing stream over the ordered files to its end, one file per trigger; returns the folder of its log."""
    return run_log(spark, pricing_stream(replayed(spark, sf_dir, ordered_files(spark, sf_dir)), DAILY), mode)[0]


def run_log(spark: SparkSession, prices: DataFrame, mode: str = "update", folding: Folding | None = None) -> tuple[str, str]:
    """Run a stream of prices to its end; returns the folders of its log and of its checkpoint."""
    out, checkpoint = new_folder(spark, "prices"), new_folder(spark, "prices-checkpoint")
    with state_store(spark, REPLAY_SETTINGS):
        run_to_end(log_sink(prices, out, checkpoint, folding, mode) if folding else table_sink(prices, out, checkpoint, mode))
    return out, checkpoint


@contextmanager
def state_store(spark: SparkSession, more: Mapping[str, str] = MappingProxyType({})) -> Iterator[None]:
    """The state store of ``STATE_SETTINGS`` for queries that start inside, whatever the session has; ``more`` settings with it."""
    settings = STATE_SETTINGS | more
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def pattern_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One time-pattern config per customer; segment, nation and balance decide what is wrong with it."""
    day = {"AUTOMOBILE": '"day_type":"weekday",', "BUILDING": '"day_type":"weekend",',
           "FURNITURE": '"day_type":"furniture",', "HOUSEHOLD": "", "MACHINERY": '"day_type":"weekend",'}
    segment = F.col("c_mktsegment")
    day_text = F.lit("")
    for name, text in day.items():
        day_text = F.when(segment == name, text).otherwise(day_text)
    hours = F.when(segment == "MACHINERY", '"8"').otherwise(
        F.format_string("[%d,%d]", F.col("c_nationkey"), F.col("c_nationkey") + 3))
    factors = F.when(segment == "MACHINERY", "{}").otherwise(F.concat(
        F.lit('{"downtown":{"demand_factor":'), F.col("c_acctbal").cast("string"), F.lit(',"supply_factor":1.0}}')))
    document = F.concat(
        F.lit('{"time_patterns":[{"pattern_id":"'), F.col("c_name"), F.lit('",'), day_text,
        F.lit('"hours":'), hours, F.lit(',"zone_type_multipliers":'), factors, F.lit("}]}"))
    return read(spark, sf_dir, "customer").select(F.col("c_name").alias("config"), document.alias("document"))


def shipped_patterns(spark: SparkSession) -> str:
    """The shipped time patterns as a JSON config file in the shared folder."""
    config = {
        "time_patterns": [
            {"pattern_id": name, "day_type": day, "hours": list(hours), "zone_type_multipliers": {
                kind: {"demand_factor": demand, "supply_factor": supply} for kind, (demand, supply) in factors.items()}}
            for name, day, hours, factors in TIME_PATTERNS],
        "default": {"demand_factor": 1.0, "supply_factor": 1.0},
    }
    path = new_folder(spark, "patterns")
    spark.range(1).select(F.lit(json.dumps(config)).alias("value")).write.text(path)
    return path


def shipped_zones(spark: SparkSession) -> str:
    """The shipped zone configuration as a JSON config file in the shared folder."""
    path = new_folder(spark, "zone-config")
    spark.range(1).select(F.lit(json.dumps(asdict(ZONES))).alias("value")).write.text(path)
    return path


def zone_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone configuration per customer: the nation sets one of three probabilities, so few of the sums are one."""
    kinds = [
        F.concat(F.lit(f'{{"zone_type_id":"{name}","probability":'), share.cast("string"), F.lit("}"))
        for name, share in (("A", F.lit("0.1")), ("B", F.lit("0.2")), ("C", F.col("c_nationkey") / 10))]
    document = F.concat(F.lit('{"zone_types":['), F.concat_ws(",", *kinds), F.lit("]}"))
    return read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("config"),
        F.when(F.col("c_mktsegment") == "MACHINERY", '{"zone_types":[]}').otherwise(document).alias("document"))


def ntz(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as wall-clock UTC, as the SQL side has them."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def latest_time(events: DataFrame) -> Column:
    """The newest event time as a literal: one value, so that later filters reach the scan."""
    return F.lit(events.agg(F.max("event_time")).first()[0])
