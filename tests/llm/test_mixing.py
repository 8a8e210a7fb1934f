from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from zoneflow.llm.mixing import BUCKETS, MixParams, exact_shares, mix_sources, order_documents, quotas, schedule

SCHEMA = "doc_id long, source string"


@pytest.mark.parametrize("seed", range(5))
def test_every_block_meets_its_window(seed):
    rng = random.Random(seed)
    share = quotas({g: rng.random() ** 3 + 0.001 for g in range(rng.randrange(1, 60))}, 1000)
    assert sum(share.values()) == 1000 and min(share.values()) >= 1
    done = Counter()
    for now, g in enumerate(schedule(share)):
        k = done[g]
        assert k * 1000 // share[g] <= now < -(-(k + 1) * 1000 // share[g])
        done[g] += 1
        assert all(abs(done[x] - (now + 1) * p / 1000) < 1 for x, p in share.items())


def brute_force(rows, params):
    """Rows in mixed order, by playing the schedule slot by slot."""
    counts = Counter(s for _, s in rows)
    named = sorted(counts, key=lambda s: (-counts[s], s is None, s or ""))[: params.max_groups - 1]
    group = {s: g for g, s in enumerate(named)}
    of = lambda s: group.get(s, len(named))
    sizes = Counter(of(s) for _, s in rows)
    share = quotas({g: n**params.exponent for g, n in sorted(sizes.items())}, params.period)
    bucket = lambda i: BUCKETS if i is None else i % BUCKETS
    queues = {g: sorted((r for r in rows if of(r[1]) == g), key=lambda r: (bucket(r[0]), r[0] or 0)) for g in sizes}
    out, slots = [], schedule(share)
    while any(queues.values()):
        for g in slots:
            out += queues[g][: params.block_rows]
            queues[g] = queues[g][params.block_rows:]
    return out


def test_against_played_schedule(spark):
    rng = random.Random(3)
    ids = rng.sample(range(100_000), 1500)
    rows = [(i, "hot" if rng.random() < 0.4 else f"s{min(int(rng.expovariate(0.3)), 12)}") for i in ids] + [(7_000_000, None)]
    params = MixParams(period=100, block_rows=4, max_groups=8)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("position", F.lit("x")).withColumn("n", F.lit(1))
    got = mix_sources(frame, params).orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(rows)))
    assert [(r.doc_id, r.source) for r in got] == brute_force(rows, params)
    assert all(r.release <= r.slot < r.deadline for r in got)
    seen, quota = Counter(), Counter()
    for r in got[:600]:  # while no group has run out: under a block from its share, and that of the block being dealt
        seen[r.source_group] += 1
    whole = quotas({g: n**0.5 for g, n in sorted(Counter(r.source_group for r in got).items())}, 100)
    for g, p in whole.items():
        assert abs(seen[g] - 600 * p / 100) <= 2 * params.block_rows
    assert not quota


def test_targets_nulls_repeats_and_empty(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, None), (5, "b"), (-3, "b")]
    got = mix_sources(spark.createDataFrame(rows, SCHEMA), MixParams(block_rows=1), {"a": 3.0, "b": 1.0}).collect()
    assert sorted(r.position for r in got) == list(range(6))
    assert Counter((r.doc_id, r.source) for r in got) == Counter(rows)
    assert mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []


def test_order_documents_keeps_rows_and_columns(spark):
    rows = [(i, f"text {i}", f"s{i % 3}", i) for i in range(200)] + [(7, "text 7", "s1", 7)] * 2 + [(None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, position int")
    ordered = order_documents(docs, MixParams(period=30, block_rows=2))
    assert ordered.columns == docs.columns
    got = ordered.collect()
    assert Counter(map(tuple, got)) == Counter(rows)
    want = mix_sources(docs, MixParams(period=30, block_rows=2)).orderBy("position").collect()
    assert [(r.doc_id, r.source) for r in got] == [(r.doc_id, r.source) for r in want]
    assert order_documents(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a")], SCHEMA)
    text = mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_hundreds_of_sources_keep_their_own_targets(spark):
    names = [f"site{i:03}" for i in range(150)]
    targets = {s: 40.0 if i == 149 else 1.0 + i % 3 for i, s in enumerate(names)}
    rows = [(i * 150 + k, s) for k, s in enumerate(names) for i in range(60 if k == 149 else 8 - (k > 100))]
    got = mix_sources(spark.createDataFrame(rows, SCHEMA), MixParams(block_rows=1), targets).orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(rows)))
    assert len({r.source_group for r in got}) == 150 and all(r.release <= r.slot < r.deadline for r in got)
    total, done = sum(targets.values()), Counter()
    last = min(max(r.slot for r in got if r.source == s) for s in names)
    for r in got:  # while no source has run out, each is under a block from its target
        if r.slot <= last:
            assert r.slot == r.position
            done[r.source] += 1
            assert all(abs(done[s] - (r.slot + 1) * w / total) < 1 for s, w in targets.items())


@pytest.mark.parametrize("weights", [
    [1, 2, 3, 4, 5, 6, 7], [0.5, 0.3, 0.1999, 0.0001], [1 / 8, 0.1, 3], [2.5] * 9, [1e-3, 7]], ids=str)
def test_given_targets_are_kept_to_at_every_slot(weights):
    share = exact_shares(dict(enumerate(weights)))
    slots, total = schedule(share), sum(weights)
    for g, w in enumerate(weights):
        assert share[g] / len(slots) == pytest.approx(w / total, rel=1e-12)
    done, now = [0] * len(weights), 0
    while now < 100_000:
        for g in slots:
            done[g] += 1
            now += 1
            assert all(abs(d - now * w / total) < 1 for d, w in zip(done, weights, strict=True))
    assert exact_shares({0: 0.2, 1: 0.1, 2: 0.7}) == {0: 2, 1: 1, 2: 7}
    assert exact_shares({0: 1 / 3, 1: 2 / 3}) == {0: 1, 1: 2}


def test_targets_that_no_period_holds_are_refused():
    for weights in ({0: 3.14159265, 1: 1}, {0: 1, 1: 0}, {0: -1, 1: 2}):
        with pytest.raises(ValueError, match="target weights"):
            exact_shares(weights)


def test_deviation_does_not_grow_with_the_table(spark):
    """Over 1,500 periods of 28 slots, in the table and not in the schedule alone."""
    targets = {f"s{w}": float(w) for w in range(1, 8)}
    rows = spark.range(42_000).select(F.col("id").alias("doc_id"), F.expr(
        "concat('s', 1 + size(filter(array(1, 3, 6, 10, 15, 21), c -> c <= pmod(id, 28))))").alias("source"))
    got = mix_sources(rows, MixParams(block_rows=1), targets).orderBy("position").toPandas()
    assert got["position"].tolist() == list(range(42_000)) and got["slot"].tolist() == list(range(42_000))
    slots = got["slot"] + 1
    for name, w in targets.items():
        assert ((got["source"] == name).cumsum() - slots * w / 28).abs().max() < 1
