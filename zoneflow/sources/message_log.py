"""A message log on files, addressed by topic, partition and offset, and a stream source that seeks and polls in it.

``append_messages`` writes parquet files sorted by offset; a commit names them with the offsets that each holds. The source plans
a batch as offset ranges over these files, one task per file, and skips row groups outside the range. This module travels to
the Python workers by value, so that they need nothing of this package.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from zoneflow import schemas
from zoneflow.sources.commits import FOLDER, commit, newest_number

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "message_log"
ROWS_PER_FILE = 1_000_000
COLUMNS = schemas.ENVELOPE.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ").replace(",", ", ")
COMMITS = FOLDER

Offsets = dict[str, dict[str, int]]


def append_messages(messages: DataFrame, path: str) -> None:
    """Add messages (the envelope's columns, a missing one null) to the log; readers see all of them or none.

    Offsets come with the messages, unique in their topic and partition and above those that the log holds; gaps are allowed. A topic
    partition of any size is dealt over tasks by ranges of offsets. One row per file reaches the driver, as its listing would.
    """
    spark = messages.sparkSession
    number = (newest_number(spark, path) or 0) + 1
    folder = f"data/append={number}-{uuid.uuid4().hex}"
    keys = ["topic", "partition", "offset"]
    rows = messages.select(*[
        (F.col(field.name) if field.name in messages.columns else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in schemas.ENVELOPE])
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{path}/{folder}")
    held = spark.read.schema(rows.schema).parquet(f"{path}/{folder}").groupBy(
        "topic", "partition", F.col("_metadata.file_name").alias("file")).agg(
        F.min("offset").alias("first"), F.max("offset").alias("last")).collect()
    if any(None in (r.topic, r.partition, r.first) for r in held):
        raise ValueError("messages without topic, partition or offset")
    ends = message_ends(spark, path)
    late = [r for r in held if r["first"] < ends.get(r.topic, {}).get(str(r.partition), 0)]
    if late:
        raise ValueError(f"offsets of {late[0].topic} {late[0].partition} start at {late[0]['first']}, which the log has passed")
    if held:
        commit(spark, path, number, {"files": [[r.topic, r.partition, r["first"], r["last"], f"{folder}/{r.file}"] for r in held]}, kept=None)


def message_ends(spark: SparkSession, path: str) -> Offsets:
    """The next offset of every topic partition that the log holds."""
    return _Log(qualified(spark, path)).bounds()[1]


def read_message_log(spark: SparkSession, path: str, start: str = "latest", tail: int = 5000, max_per_trigger: int | None = None,
                     progress: str | None = None) -> DataFrame:
    """The log as a stream of envelopes.

    ``start`` is where a query without a checkpoint begins: ``earliest``, ``latest``, ``tail`` for the last ``tail`` offsets of each
    partition, or offsets as JSON by topic and partition, as the Kafka source takes them. Topic partitions that appear later
    are read from their first offset. ``max_per_trigger`` bounds the offsets of a batch, shared out by what each partition lags
    behind, one at least; it needs ``progress``, a shared folder of this query alone, where the source notes what it has
    planned: Spark does not tell it after a restart. Such a query reaches the end by ``streaming.pricing.run_until_idle``.
    """
    if max_per_trigger is not None and not progress:
        raise ValueError("max_per_trigger needs a progress folder")
    spark.dataSource.register(MessageLogSource)
    reader = spark.readStream.format(FORMAT).option("path", qualified(spark, path)).option("startingOffsets", start).option("tail", tail)
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger).option("progress", qualified(spark, progress))
    return reader.load()


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as workers without a Hadoop configuration need it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(at).toString().rstrip("/")


class MessageLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return COLUMNS

    def streamReader(self, schema) -> DataSourceStreamReader:
        return MessageLogReader(dict(self.options))


@dataclass
class OffsetRange(InputPartition):
    """Offsets of one topic partition, ``first`` included and ``end`` not, within one file."""

    topic: str
    partition: int
    first: int
    end: int
    file: str


class MessageLogReader(DataSourceStreamReader):
    """Offsets by topic and partition are those of the next message to read."""

    def __init__(self, options: dict[str, str]):
        given = {name.lower(): value for name, value in options.items()}
        self.path, self.start, self.tail = given["path"], given["startingoffsets"], int(given["tail"])
        self.limit = int(given["maxoffsetspertrigger"]) if "maxoffsetspertrigger" in given else None
        self.progress = given.get("progress")
        self.log = _Log(self.path)
        self.first: Offsets | None = None
        self.at: Offsets | None = None

    def initialOffset(self) -> dict:
        """Fixed by the first call, which Spark makes after it has asked for the latest offset."""
        if self.first is None:
            noted = self.progress and _read(f"{self.progress}/first.json")
            self.first = json.loads(noted) if noted else self._first()
            if self.progress and not noted:
                _write(f"{self.progress}/first.json", json.dumps(self.first))
        return self.first

    def _first(self) -> Offsets:
        begins, ends = self.log.bounds()
        if self.start == "earliest":
            found = begins
        elif self.start == "latest":
            found = ends
        elif self.start == "tail":
            found = {t: {p: max(begins[t][p], end - self.tail) for p, end in of.items()} for t, of in ends.items()}
        else:
            found = json.loads(self.start)
        return _ordered(found)

    def latestOffset(self) -> dict:
        first = self.initialOffset()
        begins, ends = self.log.bounds()
        if self.limit is None:
            return _ordered(ends)
        if self.at is None:  # after a restart: what was planned last, which Spark has either finished or plans again
            planned = _read(f"{self.progress}/planned.json")
            self.at = json.loads(planned) if planned else first
        at = {(t, p): self.at.get(t, {}).get(p, begins[t][p]) for t, of in ends.items() for p in of}
        lag = {(t, p): max(0, ends[t][p] - first) for (t, p), first in at.items()}
        # A step over a gap counts like messages; to what lags at all goes one offset at least.
        share = min(1.0, self.limit / max(1, sum(lag.values())))
        end: Offsets = {}
        for (t, p), first in at.items():
            end.setdefault(t, {})[p] = first + min(lag[t, p], max(1, int(lag[t, p] * share)))
        return _ordered(end)

    def partitions(self, start: dict, end: dict) -> list[OffsetRange]:
        self.at = _ordered(end)
        if self.progress:
            _write(f"{self.progress}/planned.json", json.dumps(self.at))
        found = []
        for topic, partition, first, last, file in self.log.files():
            upto = end.get(topic, {}).get(str(partition), 0)
            low, high = max(first, start.get(topic, {}).get(str(partition), 0)), min(last + 1, upto)
            if low < high:
                found.append(OffsetRange(topic, partition, low, high, file))
        return found

    def read(self, partition: OffsetRange) -> Iterator[pa.RecordBatch]:
        files, at = _where(f"{self.path}/{partition.file}")
        column = pads.field
        wanted = ((column("topic") == partition.topic) & (column("partition") == partition.partition)
                  & (column("offset") >= partition.first) & (column("offset") < partition.end))
        text = pa.string()
        schema = pa.schema([("topic", text), ("partition", pa.int32()), ("offset", pa.int64()),
                            ("timestamp", pa.timestamp("us", "UTC")), ("key", text), ("value", text)])
        for batch in pads.dataset(at, filesystem=files, format="parquet").to_batches(filter=wanted):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([
                    (batch.column(f.name).cast(pa.timestamp("us"), safe=False) if f.name == "timestamp" else batch.column(f.name)).cast(f.type)
                    for f in schema], schema=schema)

    def commit(self, end: dict) -> None:
        """Nothing to give up: files stay."""


class _Log:
    """What the commits of a log name, each commit read once."""

    def __init__(self, path: str):
        self.path = path
        self.seen: dict[str, list] = {}

    def files(self) -> list:
        """(topic, partition, first offset, last offset, file) in the order of commits."""
        files, folder = _where(f"{self.path}/{COMMITS}")
        for info in files.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if info.base_name.endswith(".json") and info.base_name[:-5].isdigit() and info.base_name not in self.seen:
                with files.open_input_stream(info.path) as stream:
                    self.seen[info.base_name] = json.loads(stream.read())["files"]
        return [file for name in sorted(self.seen, key=lambda n: int(n[:-5])) for file in self.seen[name]]

    def bounds(self) -> tuple[Offsets, Offsets]:
        """First and next offset of every topic partition."""
        begins: Offsets = {}
        ends: Offsets = {}
        for topic, partition, first, last, _ in self.files():
            low, high = begins.setdefault(topic, {}), ends.setdefault(topic, {})
            low[str(partition)] = min(first, low.get(str(partition), first))
            high[str(partition)] = max(last + 1, high.get(str(partition), 0))
        return begins, ends


def _ordered(offsets: Offsets) -> Offsets:
    """Equal offsets as equal text: Spark compares what is written."""
    return {t: {p: int(offsets[t][p]) for p in sorted(offsets[t], key=int)} for t in sorted(offsets)}


def _where(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and path[5:8] != "///" else path)


def _read(path: str) -> str | None:
    """A small file's text; None if it is not there."""
    files, at = _where(path)
    if files.get_file_info(at).type == pafs.FileType.NotFound:
        return None
    with files.open_input_stream(at) as stream:
        return stream.read().decode()


def _write(path: str, text: str) -> None:
    """Replace a small file; it is there whole or as it was."""
    files, at = _where(path)
    files.create_dir(at.rsplit("/", 1)[0])
    aside = f"{at}.{uuid.uuid4().hex}"
    with files.open_output_stream(aside) as stream:
        stream.write(text.encode())
    files.move(aside, at)
