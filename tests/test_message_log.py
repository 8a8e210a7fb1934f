"""The message log: offsets, tail start, limits per trigger, restarts, files out of range."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from zoneflow import schemas
from zoneflow.sources import message_log
from zoneflow.sources.streams import read_log, table_sink
from zoneflow.streaming.pricing import run_until_idle

SCHEMA = "topic string, partition int, offset long, key string, value string"


def rows(topic, partition, first, end, step=1):
    return [(topic, partition, o, f"k{o % 3}", None if o % 5 == 0 else f"v{o}") for o in range(first, end, step)]


def append(spark, log, *parts):
    message_log.append_messages(spark.createDataFrame([r for part in parts for r in part], SCHEMA), log)


def poll(spark, tmp_path, start="earliest", name="q", **options):
    out = str(tmp_path / f"out-{name}")
    stream = message_log.read_message_log(spark, str(tmp_path / "log"), start, progress=str(tmp_path / f"progress-{name}"), **options)
    query = run_until_idle(table_sink(stream, out, str(tmp_path / f"checkpoint-{name}"), "append"))
    log = read_log(spark, out)
    return query, sorted((r.topic, r.partition, r.offset, r.key, r.value) for r in log.collect())


def test_earliest_reads_all_with_all_columns(spark, tmp_path):
    log = str(tmp_path / "log")
    given = spark.createDataFrame(rows("a", 0, 0, 20) + rows("a", 1, 5, 9), SCHEMA).withColumn(
        "timestamp", F.timestamp_seconds(F.col("offset") + 1_700_000_000)).withColumn("more", F.lit(1))
    message_log.append_messages(given, log)
    assert message_log.message_ends(spark, log) == {"a": {"0": 20, "1": 9}}
    _, got = poll(spark, tmp_path)
    assert got == sorted(rows("a", 0, 0, 20) + rows("a", 1, 5, 9))
    back = read_log(spark, str(tmp_path / "out-q"))
    names = [f.name for f in schemas.ENVELOPE]
    assert [(f.name, f.dataType) for f in back.schema if f.name in names] == [(f.name, f.dataType) for f in schemas.ENVELOPE]
    assert sorted(map(str, back.select(names).collect())) == sorted(map(str, given.select(names).collect()))


def test_tail_and_json_starts(spark, tmp_path):
    append(spark, str(tmp_path / "log"), rows("a", 0, 0, 100), rows("a", 1, 40, 50), rows("b", 0, 0, 300, 10))
    _, got = poll(spark, tmp_path, "tail", tail=30)
    # offset arithmetic: a partition with gaps yields fewer messages
    assert got == sorted(rows("a", 0, 70, 100) + rows("a", 1, 40, 50) + rows("b", 0, 270, 300, 10))
    _, got = poll(spark, tmp_path, json.dumps({"a": {"0": 95, "1": 0}, "b": {"0": 1000}}), "json")
    assert got == sorted(rows("a", 0, 95, 100) + rows("a", 1, 40, 50))


def test_latest_then_restart_with_a_new_partition(spark, tmp_path):
    log = str(tmp_path / "log")
    append(spark, log, rows("a", 0, 0, 10))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    run = lambda: run_until_idle(table_sink(message_log.read_message_log(spark, log), out, checkpoint, "append"))
    run()
    append(spark, log, rows("a", 0, 10, 14), rows("b", 3, 7, 9))
    run()
    run()
    assert sorted(r.offset for r in read_log(spark, out).collect()) == [7, 8, 10, 11, 12, 13]


def test_limit_per_trigger_holds_across_restarts(spark, tmp_path):
    log = str(tmp_path / "log")
    append(spark, log, rows("a", 0, 0, 90), rows("a", 1, 0, 10), rows("b", 0, 0, 1))
    first, got = poll(spark, tmp_path, max_per_trigger=20)
    assert got == sorted(rows("a", 0, 0, 90) + rows("a", 1, 0, 10) + rows("b", 0, 0, 1))
    append(spark, log, rows("a", 0, 90, 150))
    second, got = poll(spark, tmp_path, max_per_trigger=20)
    assert second.id == first.id and got == sorted(rows("a", 0, 0, 150) + rows("a", 1, 0, 10) + rows("b", 0, 0, 1))
    sizes = [
        p["numInputRows"] for q in (first, second) for p in q.recentProgress if p["numInputRows"]]
    assert sum(sizes) == 161 and max(sizes) <= 22  # 20, and one at least for each partition that lags
    with pytest.raises(ValueError, match="progress"):
        message_log.read_message_log(spark, log, max_per_trigger=5)


def test_an_append_that_did_not_commit_is_not_seen(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    append(spark, log, rows("a", 0, 0, 5))

    def killed(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(message_log, "commit", killed)
        with pytest.raises(RuntimeError, match="killed"):
            append(spark, log, rows("a", 0, 5, 8))
    append(spark, log, rows("a", 0, 5, 7))
    _, got = poll(spark, tmp_path)
    assert got == rows("a", 0, 0, 7)


def test_bad_appends(spark, tmp_path):
    log = str(tmp_path / "log")
    append(spark, log, rows("a", 0, 0, 5))
    with pytest.raises(ValueError, match="which the log has passed"):
        append(spark, log, rows("a", 0, 4, 6))
    with pytest.raises(ValueError, match="without"):
        append(spark, log, [("a", None, 9, None, None)])
    message_log.append_messages(spark.createDataFrame([], SCHEMA), log)
    assert message_log.message_ends(spark, log) == {"a": {"0": 5}}
    assert message_log.message_ends(spark, str(tmp_path / "none")) == {}


def test_a_hot_partition_is_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(message_log, "ROWS_PER_FILE", 100)
    log = str(tmp_path / "log")
    append(spark, log, rows("a", 0, 0, 1000), rows("a", 1, 0, 3))
    reader = message_log.MessageLogReader({"path": message_log.qualified(spark, log), "startingOffsets": "earliest", "tail": "1"})
    planned = reader.partitions({"a": {"0": 250, "1": 0}}, {"a": {"0": 700, "1": 3}})
    assert len(planned) >= 5 and max(p.end - p.first for p in planned) <= 100
    assert sum(batch.num_rows for p in planned for batch in reader.read(p)) == 453
