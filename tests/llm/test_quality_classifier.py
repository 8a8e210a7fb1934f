from __future__ import annotations

import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zoneflow.llm import quality_classifier as Q

TEXTS = ["", None, "One two two. Three!\nOne two two. Three!\n", "A", "  \t\n\n ", "größer ñ 日本 | x#y 12,5", "same " * 50, "a\nb\na\n\n", "x" * 5000]


def plain(text):
    """A text's statistics worked out one by one."""
    data = (text or "").encode()
    words = data.split()
    n, size = len(words), max(len(data), 1)
    some = max(n, 1)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / some
    counts = Counter(words)
    lines = [line for line in data.split(b"\n")]
    lines = [line + b"\n" for line in lines[:-1]] + lines[-1:]
    lines = [line for line in lines if len(line) > 1]
    p = np.array(list(Counter(data).values())) / size
    share = {name: sum(chosen[b] for b in data) / size for name, chosen in Q._CLASSES.items()}
    breaks = data.count(b"\n")
    found = {
        "words": np.log(n + 1), "word length": np.log(mean + 1),
        "word length spread": np.log(np.sqrt(max(sum(x * x for x in lengths) / some - mean**2, 0)) + 1),
        "line breaks": np.log(breaks / some + 0.01),
        "same word again": np.log(sum(a == b for a, b in zip(words, words[1:], strict=False)) / some + 0.01),
        "distinct words": np.log(len(counts) / some**0.8 + 0.1), "commonest word": np.log(max(counts.values(), default=0) / some + 0.01),
        "repeated lines": np.log((len(lines) - len(set(lines))) / (breaks + 1) + 0.02), "byte entropy": -(p * np.log(p)).sum(),
    } | {name: np.log(x + 0.002) for name, x in share.items()}
    return [found[name] for name in Q.STATISTICS]


def test_statistics_of_a_slice_equal_those_of_each_text():
    array = pa.array(["before", *TEXTS, "after"]).slice(1, len(TEXTS))
    assert np.allclose(Q.measure(array), [plain(t) for t in TEXTS], atol=1e-7)


def test_density_is_that_of_two_normal_distributions():
    rng = np.random.default_rng(1)
    size = len(Q.STATISTICS)
    rows = [rng.normal(k, 1 + k, (400, size)) @ rng.normal(0, 1, (size, size)) for k in (0, 1)]
    params = Q.QualityParams(shared=0, diagonal=0, floor=1e-9, limit=1e9)
    model = Q.Discriminant.fit(np.array([400.0, 400]), np.array([r.sum(0) for r in rows]), np.array([r.T @ r for r in rows]), params)
    x = rows[0][:20]
    density = []
    for own in rows:
        covariance = np.cov(own.T, bias=True)
        d = x - own.mean(0)
        density.append(-0.5 * np.linalg.slogdet(covariance)[1] - 0.5 * (d * np.linalg.solve(covariance, d.T).T).sum(1))
    want = 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))
    assert np.allclose(model.score(x), want, atol=1e-4)


def test_held_out_rows_are_told_apart(spark):
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    rows = Q.score_quality(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    told = {k: [r.predicted for r in rows if r.held_out and r.quality == k] for k in (0, 1)}
    assert len(told[0]) > 5 and np.mean(told[0]) < 0.1
    assert len(told[1]) > 50 and np.mean(told[1]) > 0.95


def test_only_rows_that_may_be_learned_from(spark):
    """Labels of held-out rows, of both kinds for one id, and unknown ones change nothing."""
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 7 + 1), "x") for i in range(60)], "doc_id long, text string, x string")
    measured = Q.measured_documents(docs)
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 == 2]
    free = [i for i in range(60) if i not in held]
    good = [(i, int(i % 7 > 2)) for i in free[5:]]
    more = [(i, 1 - int(i % 7 > 2)) for i in held] + [(i, k) for i in free[:3] for k in (0, 1)] + [(free[3], 2), (free[4], None), (None, 1)]
    models = [Q.fit(measured, spark.createDataFrame(rows, "doc_id long, quality int")) for rows in (good, good + more)]
    assert np.allclose(models[0].means, models[1].means) and np.allclose(models[0].inverse, models[1].inverse, atol=1e-5)


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(0, 1), (1, 1)], 1.0), ([(0, 0)], 0.0)])
def test_without_labels_of_both_classes(spark, labels, score):
    docs = spark.createDataFrame([(0, "a b"), (1, None), (None, "c"), (1, None)], "doc_id long, text string").withColumn("score", F.lit(9))
    got = Q.score_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.score) for r in got) == [(-1, score), (0, score), (1, score), (1, score)]


def test_empty_table_and_odd_texts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(TEXTS))], "doc_id long, quality int")
    assert Q.score_quality(docs.limit(0), labels).collect() == []
    rows = {r.doc_id: r for r in Q.score_quality(docs, labels).collect()}
    assert len(rows) == len(TEXTS) and rows[0].score == rows[1].score
    assert all(0 <= r.score <= 1 for r in rows.values())
