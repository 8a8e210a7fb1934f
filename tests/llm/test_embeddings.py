from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.llm.embeddings import PqParams, near_duplicate_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows):
    """Links by all pairs in double precision."""
    usable = [
        label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        for _, v, label in rows]
    links = [set() for _ in rows]
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows[:i]):
            if usable[i] and usable[j] and la == lb and len(a) == len(b):
                x, y = np.float32(a).astype(float), np.float32(b).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    links[i].add(j)
                    links[j].add(i)
    component = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for i, near in enumerate(links):
            low = min([component[i], *(component[j] for j in near)])
            changed |= low != component[i]
            component[i] = low
    return {r[0]: (len(links[i]), component[i], component[i] == r[0]) for i, r in enumerate(rows)}


def made(n: int, seed: int = 1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 16))
    rows = []
    for vector in base:
        label = int(rng.integers(3))
        rows.append((vector, label))
        for _ in range(rng.integers(0, 4)):
            rows.append((vector * rng.choice([1, 3]) + rng.normal(size=16) * rng.choice([0, 0.05, 0.15, 0.2]), label))
    for _ in range(60):  # one crowd of near copies
        rows.append((base[0] + rng.normal(size=16) * 0.12, 1))
    out = [(i, np.float32(v).tolist(), label) for i, (v, label) in enumerate(rows)]
    rng.shuffle(out)
    return [(int(i), v, int(label)) for i, v, label in out]


@pytest.mark.parametrize("params", [PqParams(), PqParams(list_size=15, chunk=16, margin=0.2)])
def test_against_brute_force(spark, params):
    rows = made(150) + [(5000 + i, [1.0, 2.0] + [0.5] * 14, 2) for i in range(5)]
    rows += [(6000, None, 1), (6001, [], 1), (6002, [0.0] * 16, 1), (6003, [float("nan")] * 16, 1), (6004, [float("inf")] + [1.0] * 15, 1),
             (6005, [None] + [1.0] * 15, 1), (6006, rows[0][1], None), (6007, rows[0][1][:7], rows[0][2]), (6008, rows[0][1][:7], rows[0][2])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("n_links", F.lit("x")).withColumn("cls", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(frame, params).collect()}
    want = brute_force(rows)
    assert len(got) == len(rows)
    assert max(n for n, _, _ in want.values()) > 20
    found, there = sum(n for n, _, _ in got.values()), sum(n for n, _, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert found % 2 == 0
    assert found >= 0.99 * there
    if params.margin >= 0.2:  # certain
        assert got == want


def test_empty_unusable_and_repeated_rows(spark):
    assert near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    odd = [(1, None, 1), (None, [0.0], 1), (2, [1.0], None)]
    assert sorted(map(str, map(tuple, near_duplicate_vectors(spark.createDataFrame(odd, SCHEMA)).collect()))) == sorted(map(str, [
        (1, 0, 1, True), (None, 0, None, True), (2, 0, 2, True)]))
    twice = [(7, [1.0, 2.0], 1), (7, [1.0, 2.0], 1), (None, [2.0, 4.0], 1), (9, [-1.0, 2.0], 1)]
    assert sorted(map(str, map(tuple, near_duplicate_vectors(spark.createDataFrame(twice, SCHEMA)).collect()))) == sorted(map(str, [
        (7, 2, 7, True), (7, 2, 7, True), (None, 2, 7, False), (9, 0, 9, True)]))


def circle(n, kind="float"):
    """Points on a circle inside 64 dimensions: every neighbourhood crosses the borders of lists."""
    rng = np.random.default_rng(5)
    plane = np.linalg.qr(rng.normal(size=(64, 2)))[0]
    turn = np.linspace(0, 2 * np.pi, n, endpoint=False)
    points = np.float32(np.stack([np.cos(turn), np.sin(turn)], 1) @ plane.T)
    return [(i, v.tolist(), 1) for i, v in enumerate(points)], f"vec_id long, embedding array<{kind}>, label int"


@pytest.mark.parametrize("kind", ["float", "double"])
def test_links_across_lists_count_at_both_ends(spark, kind):
    rows, schema = circle(2000, kind)
    params = PqParams(list_size=50, chunk=64)
    got = {r.vec_id: r.n_links for r in near_duplicate_vectors(spark.createDataFrame(rows, schema), params).collect()}
    points = np.array([v for _, v, _ in rows])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    assert got == dict(enumerate(((points @ points.T >= 0.98).sum(1) - 1).tolist()))


def test_a_link_that_one_end_visits_counts_twice(spark):
    """With a margin so narrow that some links are met from one side alone, every link found still has two ends."""
    rows, schema = circle(600)
    rows += [(600 + i, rows[i][1], 1) for i in range(0, 600, 7)]  # copies weigh more than one
    for margin in (0.01, 0.05, 0.1):
        got = near_duplicate_vectors(spark.createDataFrame(rows, schema), PqParams(list_size=20, margin=margin)).collect()
        assert sum(r.n_links for r in got) % 2 == 0


def test_one_long_vector_among_short_ones(spark):
    rows = made(40)
    long = np.random.default_rng(2).normal(size=200_000)
    rows += [(9000, long.tolist(), 0), (9001, (2 * long).tolist(), 0)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(
        spark.createDataFrame(rows, SCHEMA), PqParams(margin=0.2)).collect()}
    assert got == brute_force(rows)
