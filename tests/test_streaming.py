"""Streams over ordered files: windows, lateness, restart, latest price, progress."""

from __future__ import annotations

import json
import os
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from zoneflow.operators import events as ev
from zoneflow.operators import pricing
from zoneflow.params import PricingParams
from zoneflow.sources import messages, streams
from zoneflow.sources.buckets import BucketTable
from zoneflow.sources.folders import data_files
from zoneflow.streaming import pricing as live
from zoneflow.streaming import state
from zoneflow.streaming.progress import ProgressCounter

PARAMS = PricingParams()


def put(folder, number, rows):
    """One file of messages, newer than those before it; rows are (second, zone[, status])."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{number:03d}.json"
    with path.open("w") as file:
        for offset, (second, zone, *status) in enumerate(rows):
            event = {"event_id": f"{number}-{offset}", "h3_zone": zone,
                     "timestamp": f"2026-04-24T08:{second // 60:02d}:{second % 60:02d}+00:00"}
            if status:
                event["status"] = status[0]
            file.write(json.dumps({"topic": PARAMS.driver_topic if status else PARAMS.ride_topic, "partition": 0,
                                   "offset": offset, "key": zone, "value": json.dumps(event)}) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def decoded(spark, folder):
    raw = streams.read_file_stream(spark, str(folder), max_per_trigger=1)
    return ev.with_event_time(messages.decode_events(raw))


def run(spark, tmp_path, mode="update"):
    out, checkpoint = str(tmp_path / f"out-{mode}"), str(tmp_path / f"checkpoint-{mode}")
    prices = live.pricing_stream(decoded(spark, tmp_path / "in"), PARAMS)
    return live.run_to_end(streams.table_sink(prices, out, checkpoint, mode)), out


@pytest.fixture
def counter(spark):
    listener = ProgressCounter.listen(spark)
    yield listener
    spark.streams.removeListener(listener)


def emitted(spark, out):
    rows = spark.read.parquet(out).select("batch_id", "h3_zone", F.second("window_end").alias("end"), "demand_count")
    return sorted(tuple(r) for r in rows.collect())


LATE = [[(1, "A")], [(40, "B")], [(41, "B")], [(4, "A"), (24, "A"), (42, "B")]]


def test_late_events_are_dropped_window_by_window(spark, tmp_path, counter):
    for number, rows in enumerate(LATE):
        put(tmp_path / "in", number, rows)
    query, out = run(spark, tmp_path)
    assert emitted(spark, out) == sorted(
        [(0, "A", e, 1) for e in (5, 10, 15)] + [(1, "B", e, 1) for e in (45, 50, 55)]
        + [(2, "B", e, 2) for e in (45, 50, 55)]
        + [(3, "A", 30, 1), (3, "A", 35, 1)] + [(3, "B", e, 3) for e in (45, 50, 55)])
    assert counter.late_rows_dropped(query) == 4
    assert counter.records_read(query) == 6


def test_late_event_right_after_the_jump_is_accepted(spark, tmp_path, counter):
    put(tmp_path / "in", 0, [(1, "A")])
    put(tmp_path / "in", 1, [(40, "B")])
    put(tmp_path / "in", 2, [(4, "A")])
    query, out = run(spark, tmp_path)
    assert counter.late_rows_dropped(query) == 0
    assert (2, "A", 10, 2) in emitted(spark, out)


def test_append_mode_writes_closed_windows_once(spark, tmp_path):
    for number, rows in enumerate(LATE):
        put(tmp_path / "in", number, rows)
    _, out = run(spark, tmp_path, "append")
    assert [row[1:] for row in emitted(spark, out)] == [("A", 5, 1), ("A", 10, 1), ("A", 15, 1)]


def spread(second, n=60):
    return [(second + i % 5, "hot" if i % 3 == 0 else f"z{i % 11}", *(() if i % 2 else ("available",)))
            for i in range(n)]


def test_folded_stream_equals_batch_across_a_restart(spark, tmp_path, counter):
    """Three files, a stop, three more from the checkpoint."""
    for number in range(3):
        put(tmp_path / "in", number, spread(number * 5))
    first, _ = run(spark, tmp_path)
    assert counter.records_read(first) == 180
    for number in range(3, 6):
        put(tmp_path / "in", number, spread(number * 5))
    query, out = run(spark, tmp_path)
    assert query.id == first.id and counter.records_read(query) == 360  # across the restart
    log = streams.read_log(spark, out)
    folded = pricing.compact_updates(log).drop("calculated_at")
    assert log.count() > folded.count()
    from zoneflow import schemas
    raw = spark.read.schema(schemas.ENVELOPE).json(str(tmp_path / "in"))
    batch = pricing.zone_window_pricing(ev.with_event_time(messages.decode_events(raw)), PARAMS)
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, batch.collect()))
    assert folded.agg(F.sum("demand_count")).first()[0] == 3 * 180
    fast = pricing.zone_window_pricing(ev.with_event_time(messages.decode_events(raw)), PARAMS, panes=True)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, batch.collect()))


def test_a_repeated_batch_is_stored_once(spark, tmp_path):
    """After a crash between the sink and the commit, the batch runs again into its own folder."""
    put(tmp_path / "in", 0, spread(0))
    _, out = run(spark, tmp_path)
    before = spark.read.parquet(out).count()
    os.remove(tmp_path / "checkpoint-update" / "commits" / "0")
    crc = tmp_path / "checkpoint-update" / "commits" / ".0.crc"
    if crc.exists():
        os.remove(crc)
    run(spark, tmp_path)
    assert spark.read.parquet(out).count() == before


def test_messages_in_messages_out(spark, tmp_path):
    put(tmp_path / "in", 0, [(1, "A"), (2, "A", "available"), (3, "B")])
    raw = streams.read_file_stream(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    live.run_to_end(streams.table_sink(live.pricing_messages(raw, PARAMS), out, str(tmp_path / "checkpoint")))
    sent = spark.read.parquet(out)
    prices = messages.decode_pricing(sent).collect()
    assert {(r.h3_zone, r.demand_count, r.available_driver_count, r.pressure, r.price_multiplier) for r in prices} == {
        ("A", 1, 1, 0.0, 1.0), ("B", 1, 0, None, 1.5)}
    assert {r.key for r in sent.collect()} == {"A", "B"}
    assert len({r.calculated_at for r in prices}) == 1  # one processing time per batch


def test_latest_price_stream(spark, tmp_path):
    folder = tmp_path / "prices"
    folder.mkdir()
    at = lambda s: datetime(2026, 4, 24, 8, 0, s)
    schema = ("h3_zone string, window_start timestamp, window_end timestamp, demand_count int, "
              "available_driver_count int, pressure double, price_multiplier double, calculated_at timestamp")
    versions = [[("a", 15, 1, 16), ("b", 15, 2, 16)], [("a", 20, 3, 17), ("a", 15, 9, 18)], [("a", 20, 4, 19)]]
    for number, rows in enumerate(versions):
        df = spark.createDataFrame([(z, at(e - 15), at(e), d, 0, None, 1.5, at(c)) for z, e, d, c in rows], schema)
        sent = messages.encode_pricing(df, F.col("calculated_at")).collect()
        path = folder / f"{number}.json"
        path.write_text("\n".join(json.dumps({"topic": "zone_pricing", "value": r.value}) for r in sent))
        os.utime(path, (1_700_000_000 + number,) * 2)
    raw = streams.read_file_stream(spark, str(folder), max_per_trigger=1)
    out = str(tmp_path / "out")
    live.run_to_end(streams.table_sink(live.latest_pricing_stream(raw), out, str(tmp_path / "checkpoint")))
    seen = {(r.batch_id, r.h3_zone, r.demand_count) for r in spark.read.parquet(out).collect()}
    assert seen == {(0, "a", 1), (0, "b", 2), (1, "a", 3), (2, "a", 4)}


def test_chaining_the_latest_price_behind_the_windows_is_refused(spark, tmp_path):
    put(tmp_path / "in", 0, [(1, "A")])
    chained = pricing.latest_pricing(live.pricing_stream(decoded(spark, tmp_path / "in"), PARAMS))
    with pytest.raises(AnalysisException):
        streams.table_sink(chained, str(tmp_path / "o"), str(tmp_path / "c")).trigger(availableNow=True).start()


def test_counts_survive_more_batches_than_reports(spark, tmp_path, counter):
    """Two streams at once, more batches than reports are kept."""
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        started = []
        for label, files in (("one", 9), ("two", 6)):
            for number in range(files):
                put(tmp_path / label, number, spread(number * 5, 10 + number))
            prices = live.pricing_stream(decoded(spark, tmp_path / label), PARAMS)
            sink = streams.table_sink(prices, str(tmp_path / f"{label}-out"), str(tmp_path / f"{label}-checkpoint"))
            started.append(sink.trigger(availableNow=True).start())
        for query in started:
            query.awaitTermination()
    finally:
        spark.conf.set(name, before)
    assert [counter.records_read(q) for q in started] == [sum(10 + n for n in range(9)), sum(10 + n for n in range(6))]
    assert sum(p.numInputRows for p in started[0].recentProgress) < counter.records_read(started[0])


def test_two_checkpoints_on_one_folder_keep_apart(spark, tmp_path):
    for number in range(3):
        put(tmp_path / "in", number, spread(number * 5))
    _, out = run(spark, tmp_path)
    before = spark.read.parquet(out).count()
    prices = live.pricing_stream(decoded(spark, tmp_path / "in"), PARAMS)
    live.run_to_end(streams.table_sink(prices, out, str(tmp_path / "fresh")))
    assert spark.read.parquet(out).count() == 2 * before
    assert spark.read.parquet(out).select("query").distinct().count() == 2


def test_latest_table_has_one_row_per_zone(spark, tmp_path):
    """In any order of arrival: the files of the log come newest first."""
    for number in range(4):
        put(tmp_path / "in", number, [(number * 7, "A"), (number * 7, f"z{number}")])
    _, log = run(spark, tmp_path)
    files = [f for f in sorted(tmp_path.glob("out-update/*/*/part-*"), reverse=True)]
    for second, path in enumerate(files):
        os.utime(path, (1_700_000_000 + second,) * 2)
    schema = streams.read_log(spark, log).schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{log}/*/*")
    table = BucketTable(str(tmp_path / "latest"), "h3_zone", 4)
    live.run_to_end(streams.latest_sink(rows, table, str(tmp_path / "latest-c")))
    want = pricing.latest_pricing(streams.read_log(spark, log))
    got = table.read(spark)
    assert got.count() == 5 and sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_panes_hold_a_third_of_the_state_and_give_the_same_windows(spark, tmp_path):
    """24 windows per event: at every batch, against the stream that keeps a row per window."""
    params = PricingParams(window_seconds=24, slide_seconds=1)
    for number in range(8):
        put(tmp_path / "in", number, [(number * 12 + i % 12, f"z{i % 7}", *(() if i % 2 else ("available",))) for i in range(20)])
    put(tmp_path / "in", 8, [(2, "z1"), (3, "late")])
    held, logs = [], []
    for label, stream in (("panes", live.closed_pricing_stream), ("windows", live.pricing_stream)):
        sink = streams.table_sink(stream(decoded(spark, tmp_path / "in"), params), str(tmp_path / label), str(tmp_path / f"{label}-c"), "append")
        query = live.run_to_end(sink)
        held.append(max(sum(s.numRowsTotal for s in p.stateOperators) for p in query.recentProgress))
        logs.append(streams.read_log(spark, str(tmp_path / label)).drop("calculated_at"))
    assert 3 * held[0] <= held[1]
    last = logs[0].agg(F.max("window_end")).first()[0]
    got, want = (sorted(map(tuple, log.where(F.col("window_end") <= last).collect())) for log in logs)
    assert got == want and len(got) > 100
    assert 0 <= logs[1].where(F.col("window_end") > last).select("window_end").distinct().count() <= 5
    with pytest.raises(ValueError):
        live.closed_pricing_stream(decoded(spark, tmp_path / "in"), params, 0)


def test_state_as_a_table(spark, tmp_path):
    for number, rows in enumerate(LATE):
        put(tmp_path / "in", number, rows)
    _, out = run(spark, tmp_path)
    checkpoint = str(tmp_path / "checkpoint-update")
    held = state.open_windows(spark, checkpoint, PARAMS)
    assert sorted((r.h3_zone, r.window_end.second, r.demand_count) for r in held.collect()) == [
        ("A", 30, 1), ("A", 35, 1), ("B", 45, 3), ("B", 50, 3), ("B", 55, 3)]
    assert [tuple(r) for r in state.state_size(spark, checkpoint).collect()] == [(0, 5)]
    marks = [r.watermark for r in state.watermarks(spark, checkpoint).orderBy("batch").collect()]
    assert marks == sorted(marks) and marks[-1].second == 27


def test_records_read_go_on_after_a_restart(spark, tmp_path):
    table, checkpoint = BucketTable(str(tmp_path / "counts"), "topic", 1), str(tmp_path / "c")
    for number in range(2):
        put(tmp_path / "in", number, spread(number * 5, 10))
    live.run_to_end(streams.count_sink(decoded(spark, tmp_path / "in"), table, checkpoint))
    put(tmp_path / "in", 2, spread(10, 10))
    live.run_to_end(streams.count_sink(decoded(spark, tmp_path / "in"), table, checkpoint))
    assert {r.topic: r.records_read for r in table.read(spark).collect()} == {PARAMS.ride_topic: 15, PARAMS.driver_topic: 15}


def test_registered_streams_are_real(spark, counter):
    """Several bounded batches, versions of windows, late rows that stay out, and little state."""
    from conftest import SF_DIR
    from zoneflow.plans import tables

    log = streams.read_log(spark, tables.update_log(spark, SF_DIR))
    windows = pricing.zone_window_pricing(tables.feed(spark, SF_DIR), tables.DAILY).count()
    assert pricing.compact_updates(log).count() == windows < log.count()
    folder = tables.ordered_files(spark, SF_DIR)
    source = spark.readStream.schema(tables.read(spark, SF_DIR, "events").schema).option("maxFilesPerTrigger", 1)
    feed = tables.as_feed(source.parquet(f"{folder}/*")).withColumn("event_time", F.col("event_time").cast("timestamp"))
    sink = streams.table_sink(live.pricing_stream(feed, tables.DAILY), f"{folder}-out", f"{folder}-checkpoint")
    with tables.state_store(spark):
        query = live.run_to_end(sink)
    assert counter.late_rows_dropped(query) > 0
    batches = [p for p in query.recentProgress if p.numInputRows]
    assert len(batches) > tables.STREAM_FILES
    assert max(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators) < windows / 2


def test_rocksdb_state(spark, tmp_path):
    from zoneflow.session import SETTINGS
    name = "spark.sql.streaming.stateStore.providerClass"
    put(tmp_path / "in", 0, [(1, "A")])
    spark.conf.set(name, SETTINGS[name])
    try:
        _, out = run(spark, tmp_path)
    finally:
        spark.conf.unset(name)
    assert len(emitted(spark, out)) == 3


def test_kafka_options():
    options = streams.kafka_options("host:1", PARAMS.event_topics, max_per_trigger=2000)
    assert options == {"kafka.bootstrap.servers": "host:1", "subscribe": "ride_requests,driver_updates",
                       "startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "2000"}
    assert "maxOffsetsPerTrigger" not in streams.kafka_options("host:1", ["t"])


def test_starting_offsets():
    bounds = lambda: [("prices", 0, 100, 9000), ("prices", 1, 0, 10)]
    assert streams.starting_offsets("earliest", None) == "earliest" and streams.starting_offsets("latest", None) == "latest"
    assert json.loads(streams.starting_offsets("tail", bounds, 50)) == {"prices": {"0": 8950, "1": 0}}
    assert streams.starting_offsets("tail", list) == "earliest"


def test_price_stream_needs_a_lasting_checkpoint(spark, monkeypatch):
    from jobs import price_stream

    monkeypatch.delenv("PRICING_CHECKPOINT_LOCATION", raising=False)
    if not spark.conf.get("spark.checkpoint.dir", None):
        with pytest.raises(RuntimeError, match="PRICING_CHECKPOINT_LOCATION"):
            price_stream.checkpoint_folder(spark)
    monkeypatch.setenv("PRICING_CHECKPOINT_LOCATION", "/lasting/folder")
    assert price_stream.checkpoint_folder(spark) == "/lasting/folder"


def test_tail_offsets():
    bounds = [("t", 0, 0, 12000), ("t", 1, 9000, 12000), ("u", 0, 0, 10)]
    assert json.loads(streams.tail_offsets(bounds)) == {"t": {"0": 7000, "1": 9000}, "u": {"0": 0}}


def test_merges_of_a_log_follow_its_bytes_and_not_its_files(spark, tmp_path):
    """Ten files or more of one row each are one trigger; a limit of one byte makes every file a trigger of its own."""
    log = f"{tmp_path}/log"
    rows = spark.range(10).select(
        F.concat(F.lit("z"), F.col("id") % 5).alias("h3_zone"), F.timestamp_seconds("id").alias("window_start"),
        F.timestamp_seconds(F.col("id") + 15).alias("window_end"), F.timestamp_seconds(F.col("id") + 20).alias("calculated_at"))
    rows.repartition(10, "window_start").write.option("maxRecordsPerFile", 1).parquet(f"{log}/query=a/batch_id=0")
    files = len(data_files(spark, f"{log}/query=a/batch_id=0"))
    assert files >= 10
    for name, limit, merges in (("whole", {}, 1), ("cut", {"max_bytes": 1}, files)):
        table = BucketTable(f"{tmp_path}/{name}", "h3_zone", 2)
        query = live.run_to_end(streams.latest_sink(streams.read_log_stream(spark, log, **limit), table, f"{tmp_path}/{name}-c"))
        assert query.lastProgress.batchId == merges - 1
        assert sorted(r.window_end.second for r in table.read(spark).collect()) == [20, 21, 22, 23, 24]


def test_blocks_hold_sums_and_no_lists(spark, tmp_path):
    put(tmp_path / "in", 0, spread(0, 10))
    prices = live.closed_pricing_stream(decoded(spark, tmp_path / "in"), PARAMS)
    plan = prices._jdf.queryExecution().analyzed().toString()
    assert "collect_list" not in plan and plan.count("Aggregate [") == 2


def test_blocks_keep_one_sum_per_window(spark, tmp_path):
    """Demand and supply share it; a window of busy drivers alone has none of either, and comes out all the same."""
    put(tmp_path / "in", 0, [(1, "a"), (2, "a", "available"), (3, "a", "available"), (4, "b", "busy")])
    put(tmp_path / "in", 1, [(200, "c")])
    prices = live.closed_pricing_stream(decoded(spark, tmp_path / "in"), PARAMS, 4)
    plan = prices._jdf.queryExecution().analyzed().toString()
    blocks = next(line for line in plan.splitlines() if "Aggregate [" in line and "block" in line)
    assert blocks.count("sum(") == 4 and "explode(array(0, 1, 2, 3))" in plan
    live.run_to_end(streams.table_sink(prices, str(tmp_path / "out"), str(tmp_path / "c"), "append"))
    rows = streams.read_log(spark, str(tmp_path / "out")).select("h3_zone", F.second("window_start"), "demand_count", "available_driver_count")
    assert sorted(map(tuple, rows.collect())) == [(z, s, *n) for z, n in (("a", (1, 2)), ("b", (0, 0))) for s in (0, 50, 55)]


def _events(spark, folder, count):
    """A table of events of its own, over ten days; returns its folder."""
    number = F.col("id")
    spark.range(count).select(
        number.alias("event_id"), F.timestamp_seconds(1_704_067_200 + number * (864_000 // count)).cast("timestamp_ntz").alias("ts"),
        (number % 7).alias("user_id"), F.when(number % 3 == 0, "click").otherwise("signup").alias("event_type"),
        number.cast("double").alias("value"), F.lit('{"k": 1}').alias("props")).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_a_trigger_reads_its_file_in_many_tasks(spark, tmp_path, monkeypatch):
    from pyarrow import parquet
    from zoneflow.plans import tables

    monkeypatch.setattr(tables, "ROW_GROUP_BYTES", 4096)
    sf_dir = _events(spark, tmp_path, 40_000)
    folder = tables.ordered_files(spark, sf_dir)
    files = data_files(spark, f"{folder}/ontime")
    assert len(files) == tables.STREAM_FILES and len(data_files(spark, f"{folder}/late")) == 1
    assert all(parquet.read_metadata(name.removeprefix("file:")).num_row_groups >= 4 for name in files)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert sorted(spark.read.parquet(f"{folder}/ontime").collect()) == sorted(events.collect())
    assert sorted(spark.read.parquet(f"{folder}/late").collect()) == sorted(events.where("ts < '2024-01-02'").collect())


def test_logs_of_replays_have_plain_timestamps_and_leave_the_session_alone(spark, tmp_path):
    from pyarrow import parquet
    from zoneflow.plans import tables

    before = {name: spark.conf.get(name, None) for name in tables.REPLAY_SETTINGS}
    log = tables.update_log(spark, _events(spark, tmp_path, 1000))
    assert {name: spark.conf.get(name, None) for name in tables.REPLAY_SETTINGS} == before
    written = [name for name in streams.read_log(spark, log).inputFiles()]
    kinds = {parquet.read_metadata(name.removeprefix("file://")).schema.column(1).physical_type for name in written}
    assert kinds == {"INT64"}
