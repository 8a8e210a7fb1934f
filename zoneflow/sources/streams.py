"""Message sources and sinks: Kafka on a cluster, files where there is no broker."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from zoneflow import schemas
from zoneflow.operators.pricing import latest_pricing
from zoneflow.params import PricingParams
from zoneflow.sources.buckets import BucketTable
from zoneflow.sources.folders import numbered, query_folder, subfolders
from zoneflow.sources.price_log import read_committed

TAIL_MESSAGES = 5000  # fixed value: messages per partition a late reader starts with
BOOTSTRAP_SERVERS = "localhost:9092"
TRIGGER_BYTES = 256 << 20  # of a log that is read as a stream


def kafka_options(servers: str, topics: Iterable[str], starting_offsets: str = "latest",
                  max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of a Kafka source that subscribes to several topics and tolerates lost offsets."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def tail_offsets(bounds: Iterable[tuple[str, int, int, int]], n: int = TAIL_MESSAGES) -> str:
    """``startingOffsets`` for the last ``n`` messages of each (topic, partition, begin, end)."""
    starts: dict[str, dict[str, int]] = {}
    for topic, partition, begin, end in bounds:
        starts.setdefault(topic, {})[str(partition)] = max(begin, end - n)
    return json.dumps(starts, sort_keys=True)


def read_event_stream(spark: SparkSession, params: PricingParams = PricingParams(),
                      servers: str = BOOTSTRAP_SERVERS, **options: object) -> DataFrame:
    """Both event topics as one stream of envelopes."""
    settings = kafka_options(servers, params.event_topics, **options)
    return spark.readStream.format("kafka").options(**settings).load()


def read_price_stream(spark: SparkSession, params: PricingParams = PricingParams(),
                      servers: str = BOOTSTRAP_SERVERS, **options: object) -> DataFrame:
    """The topic that the pricing stream writes."""
    settings = kafka_options(servers, [params.pricing_topic], **options)
    return spark.readStream.format("kafka").options(**settings).load()


def read_file_stream(spark: SparkSession, path: str, max_per_trigger: int | None = None) -> DataFrame:
    """The same envelopes from JSON files that appear below ``path``."""
    reader = spark.readStream.schema(schemas.ENVELOPE)
    if max_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.json(path)


def kafka_sink(messages: DataFrame, topic: str, checkpoint: str, servers: str = BOOTSTRAP_SERVERS,
               mode: str = "update") -> DataStreamWriter:
    """Writer of (key, value) messages to one topic."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
    )


def table_sink(rows: DataFrame, path: str, checkpoint: str, mode: str = "update") -> DataStreamWriter:
    """Writer of an update log as parquet, one folder per query and micro-batch, files by size and not by shuffle width.

    File sinks refuse update mode. A batch that is run again after a failure replaces its own folder, so each update is
    stored once. A query with a fresh checkpoint has a folder of its own and leaves the others' alone. A log that is to stay
    small is written by ``price_log.log_sink``, a table of one row per zone by ``latest_sink``.
    """
    own: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not own:
            own.append(query_folder(batch.sparkSession, path, checkpoint))
        batch.hint("rebalance").write.mode("overwrite").parquet(f"{own[0]}/batch_id={batch_id}")

    return (
        rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode)
    )


def latest_sink(prices: DataFrame, table: BucketTable, checkpoint: str) -> DataStreamWriter:
    """Writer of the latest price per zone into a bucketed table: a batch rewrites the buckets of the zones it holds.

    ``prices`` are rows with a ``calculated_at``, in any number per zone and without state: a batch is reduced to one row per zone
    before it is merged, and an older price never replaces a newer one, whatever the order of arrival.
    """
    def order(row: Column) -> Column:
        return F.struct(row["window_end"].cast("timestamp"), row["calculated_at"].cast("timestamp"))

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(latest_pricing(batch), number=batch_id, newer=lambda old, new: order(new) > order(old))

    return prices.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")


def count_sink(records: DataFrame, table: BucketTable, checkpoint: str) -> DataStreamWriter:
    """Writer of the number of records read by topic. Counts are the stream's state and the table's rows, so they go on after
    a restart from the checkpoint, and a batch that is run again counts once."""
    counts = records.groupBy("topic").agg(F.count(F.lit(1)).alias("records_read"))
    return counts.writeStream.foreachBatch(
        lambda batch, batch_id: table.upsert(batch, number=batch_id)
    ).option("checkpointLocation", checkpoint).outputMode("update")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a log that ``table_sink`` or ``log_sink`` has written: of each query the committed batches."""
    logs = [_log_of(spark, own) for own in subfolders(spark, path, "query")]
    logs = [log for log in logs if log is not None]
    if not logs:
        raise RuntimeError(f"no committed batches in {path}")
    return reduce(DataFrame.unionByName, logs)


def read_log_stream(spark: SparkSession, path: str, max_bytes: int = TRIGGER_BYTES) -> DataFrame:
    """A stream over the batches of a log that ``table_sink`` has written.

    A trigger is limited by bytes, not by files: a stream writes as many files as its state is wide, however few rows they hold,
    and a sink that merges each trigger into a table would merge once per so many files.
    """
    return spark.readStream.schema(read_log(spark, path).schema).option("maxBytesPerTrigger", max_bytes).parquet(f"{path}/*/*")


def _log_of(spark: SparkSession, own: str) -> DataFrame | None:
    committed = read_committed(spark, own)
    if committed is not None:
        return committed
    folders = list(numbered(spark, own, "batch_id").values())
    return spark.read.parquet(*folders) if folders else None


def topic_bounds(spark: SparkSession, topics: Iterable[str], servers: str = BOOTSTRAP_SERVERS) -> list[tuple[str, int, int, int]]:
    """(topic, partition, begin, end) of what the broker holds now; one row per topic partition reaches the driver."""
    settings = kafka_options(servers, topics, "earliest")
    held = spark.read.format("kafka").options(**settings).load().groupBy("topic", "partition").agg(
        F.min("offset").alias("begin"), (F.max("offset") + 1).alias("end"))
    return [tuple(row) for row in held.collect()]


def starting_offsets(start: str, bounds: Callable[[], Iterable[tuple[str, int, int, int]]], tail: int = TAIL_MESSAGES) -> str:
    """``startingOffsets`` of a first start: ``earliest``, ``latest``, or ``tail`` for the last messages of each partition.

    Partitions without messages are not among ``bounds``; where there are none at all, everything to come is read.
    """
    if start != "tail":
        return start
    held = list(bounds())
    return tail_offsets(held, tail) if held else "earliest"
