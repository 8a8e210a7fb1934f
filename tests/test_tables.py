"""Folded price logs and bucketed tables: what is rewritten, what readers see, what a crash leaves."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.operators import pricing, upsert
from zoneflow.sources import buckets, commits, price_log, streams
from zoneflow.sources.buckets import BucketTable
from zoneflow.sources.folders import children, data_files
from zoneflow.sources.price_log import Folding

START = datetime(2026, 4, 24, 8)
UPDATE = "h3_zone string, window_start timestamp, window_end timestamp, demand_count int, calculated_at timestamp"


def batch_of(spark, number, zones=("a", "b", "c"), windows=3):
    """What a stream in update mode emits: the newest windows of some zones, again and again."""
    rows = []
    for k in range(windows):
        end = START + timedelta(seconds=5 * (number + k))
        rows += [(zone, end - timedelta(seconds=15), end, 100 * number + k, START + timedelta(hours=1, seconds=number)) for zone in zones]
    return spark.createDataFrame(rows, UPDATE)


FOLDING = Folding(open_seconds=30, every=2, fanout=3, levels=2)


def states(spark, own, last, folding=FOLDING):
    found = []
    for number in range(last):
        price_log.append(batch_of(spark, number), own, number, folding)
        found.append(commits.newest(spark, own))
    return found


def test_what_a_fold_rewrites_does_not_grow(spark, tmp_path):
    """Each row once when its window closes, at most twice more when closed folders are put together; open rows at each fold."""
    own = f"{tmp_path}/query=q"
    found = states(spark, own, 20)
    whole = None
    for number in range(20):
        rows = batch_of(spark, number)
        whole = rows if whole is None else whole.unionByName(rows)
    assert found[-1]["rows"] == whole.count() == 20 * 9
    rewritten = [b["rewritten"] - a["rewritten"] for a, b in zip(found, found[1:], strict=False)]
    # 3 zones. A fold has nine windows at most and closes two of them; of closed rows, one merge moves what three folds have
    # closed, or nine. Without the levels a fold would move all of them.
    assert max(rewritten) <= 3 * (9 + 3 * 2 + 9 * 2)
    folds = [n for n in rewritten if n]
    assert sorted(folds)[:5] == [3 * n for n in (4, 6, 8, 9, 9)]
    assert len(found[-1]["closed"]) <= 2 * FOLDING.fanout and {level for level, _ in found[-1]["closed"]} >= {1}
    want = sorted(map(tuple, pricing.compact_updates(whole).collect()))
    assert sorted(map(tuple, price_log.read_folded(spark, str(tmp_path)).select(whole.columns).collect())) == want
    assert sorted(map(tuple, pricing.compact_updates(streams.read_log(spark, str(tmp_path))).select(whole.columns).collect())) == want
    kept = {f for s in commits.last_states(spark, own) for f in s["open"] + [r[1] for r in s["closed"]]}
    assert {name for name in children(spark, own) if not name.startswith(("_", "fold="))} <= kept
    assert [tuple(r)[1:3] for r in price_log.log_counts(spark, str(tmp_path)).collect()] == [(20, 20 * 9)]


def test_a_batch_shows_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    """Killed after the files of a fold are written and before the commit; then the batch runs again, twice."""
    own = f"{tmp_path}/query=q"
    states(spark, own, 3)
    before = sorted(map(tuple, price_log.read_folded(spark, str(tmp_path)).collect()))
    with monkeypatch.context() as patched:
        patched.setattr(price_log, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            price_log.append(batch_of(spark, 3), own, 3, FOLDING)
    assert sorted(map(tuple, price_log.read_folded(spark, str(tmp_path)).collect())) == before
    for _ in range(2):
        price_log.append(batch_of(spark, 3), own, 3, FOLDING)
    state = commits.newest(spark, own)
    assert (state["batch"], state["rows"]) == (3, 36)
    whole = batch_of(spark, 0).unionByName(batch_of(spark, 1)).unionByName(batch_of(spark, 2)).unionByName(batch_of(spark, 3))
    assert sorted(map(tuple, price_log.read_folded(spark, str(tmp_path)).select(whole.columns).collect())) == sorted(
        map(tuple, pricing.compact_updates(whole).collect()))


def test_tasks_of_a_fold_follow_its_rows(spark, tmp_path, monkeypatch):
    """Of 8 shuffle partitions none would be written to more than 16 files, whatever the number of rows."""
    own, names = f"{tmp_path}/query=q", [f"z{i}" for i in range(60)]
    monkeypatch.setattr(price_log, "FOLD_ROWS", 10)
    for number in range(4):
        price_log.append(batch_of(spark, number, names), own, number, FOLDING)
    state = commits.newest(spark, own)
    assert len([name for folder in state["open"] for name in data_files(spark, f"{own}/{folder}")]) > 16
    assert state["waiting"] == spark.read.parquet(*[f"{own}/{folder}" for folder in state["open"]]).count() > 0
    whole = reduce(DataFrame.unionByName, [batch_of(spark, number, names) for number in range(4)])
    assert sorted(map(tuple, price_log.read_folded(spark, str(tmp_path)).select(whole.columns).collect())) == sorted(
        map(tuple, pricing.compact_updates(whole).collect()))


def test_a_fold_goes_on_from_commits_that_count_no_waiting_rows(spark, tmp_path):
    own = f"{tmp_path}/query=q"
    price_log.append(batch_of(spark, 0), own, 0, FOLDING)
    state = commits.newest(spark, own)
    price_log.remove(spark, f"{own}/_commits")
    commits.commit(spark, own, 0, {name: value for name, value in state.items() if name != "waiting"})
    price_log.append(batch_of(spark, 1), own, 1, FOLDING)
    assert commits.newest(spark, own)["waiting"] == price_log.read_folded(spark, str(tmp_path)).count() == 12


def test_empty_batches_and_missing_logs(spark, tmp_path):
    own = f"{tmp_path}/query=q"
    for number in range(3):
        price_log.append(batch_of(spark, 0).limit(0), own, number, FOLDING)
    assert price_log.read_folded(spark, str(tmp_path)).count() == 0
    with pytest.raises(RuntimeError):
        price_log.read_folded(spark, str(tmp_path / "nothing"))


def zones(spark, names, value):
    return spark.createDataFrame([(n, value, float(value)) for n in names], "zone string, version int, x double")


def test_an_upsert_touches_its_buckets_alone(spark, tmp_path):
    table = BucketTable(str(tmp_path / "t"), "zone", 50)
    every = [f"z{i:04d}" for i in range(1000)]
    first = table.upsert(zones(spark, every, 1))
    assert (first["upserted"], first["total"], first["touched"]) == (1000, 1000, 50)
    second = table.upsert(zones(spark, ["z0003", "new", None], 2))
    assert (second["matched"], second["modified"], second["upserted"], second["total"]) == (1, 1, 1, 1001)
    assert second["touched"] <= 2 and second["rewritten"] <= 100  # of 1,001 rows
    rows = {r.zone: r.version for r in table.read(spark).collect()}
    assert len(rows) == 1001 and rows["z0003"] == rows["new"] == 2 and sum(rows.values()) == 1003
    want = upsert.upsert(zones(spark, every, 1), zones(spark, ["z0003", "new"], 2), "zone")
    assert sorted(map(tuple, table.read(spark).collect())) == sorted(map(tuple, want.collect()))


def test_the_stored_side_is_not_shuffled(spark, tmp_path):
    table = BucketTable(str(tmp_path / "t"), "zone", 8)
    table.upsert(zones(spark, [f"z{i}" for i in range(200)], 1))
    updates = zones(spark, [f"z{i}" for i in range(150, 250)], 2)
    names = []
    merged = table.merged(spark, commits.newest(spark, table.root), updates, [str(b) for b in range(8)], names)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("FullOuter"):]
    stored, given = side.split("Exchange", 1) if side.index("FileScan") < side.index("Exchange") else side.rsplit("Exchange", 1)[::-1]
    assert plan.count("Exchange") == 1 and "FileScan" in plan and "Bucketed: true" in plan and stored and given
    assert merged.count() == 250
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_repeated_crashed_and_older_upserts(spark, tmp_path, monkeypatch):
    table = BucketTable(str(tmp_path / "t"), "zone", 4)
    table.upsert(zones(spark, ["a", "b"], 5), number=0)
    with monkeypatch.context() as patched:
        patched.setattr(buckets, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            table.upsert(zones(spark, ["a", "c"], 6), number=1)
    assert {r.zone: r.version for r in table.read(spark).collect()} == {"a": 5, "b": 5}
    newer = lambda old, new: new["version"] > old["version"]
    done = table.upsert(zones(spark, ["a", "c"], 4), number=1, newer=newer)
    assert (done["matched"], done["modified"], done["upserted"], done["total"]) == (1, 0, 1, 3)
    assert {r.zone: r.version for r in table.read(spark).collect()} == {"a": 5, "b": 5, "c": 4}
    assert table.upsert(zones(spark, ["a"], 9), number=1)["touched"] == 0
    assert table.upsert(zones(spark, [], 1))["touched"] == 0 and table.read(spark).count() == 3
    with pytest.raises(ValueError):
        BucketTable(table.root, "zone", 5).upsert(zones(spark, ["a"], 9))
    for number in range(3, 3 + 2 * buckets.SWEPT):
        table.upsert(zones(spark, ["a"], number), number=number)
    assert len([name for name in children(spark, table.root) if name.startswith("run=")]) <= 4 + buckets.SWEPT
    kept = zones(spark, ["a"], 7).withColumn("x", F.lit(0.5))
    table.upsert(kept, keep=("version",))
    assert [tuple(r) for r in table.read(spark).where("zone = 'a'").collect()] == [("a", 2 + 2 * buckets.SWEPT, 0.5)]


def test_no_table(spark, tmp_path):
    assert BucketTable(str(tmp_path / "none"), "zone").read(spark) is None
    assert commits.newest(spark, str(tmp_path / "none")) is None
